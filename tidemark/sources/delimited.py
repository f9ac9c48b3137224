"""Delimited source files and their digests."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Types that a profiled column may have, the narrowest first; text fits always.
PROFILE_TYPES = ("int", "bigint", "double", "timestamp_ntz", "boolean")


def scan_declared(
    spark: SparkSession, path: str | list[str], declared: Sequence[str], sep: str = "\t"
) -> DataFrame:
    """All-text scan of the declared columns that the headers name, in declared order.

    No inference.  Every file is read by the names in its own header, so part
    files may order their columns differently.  Undeclared columns are dropped;
    a column that any file lacks is left out, so that the source precondition
    can report it.
    """
    parts = _by_header(spark, path, sep)
    present = [c for c in declared if all(c in p.columns for p in parts)]
    return reduce(DataFrame.unionByName, [p.select(*present) for p in parts])


def scan_profiled(spark: SparkSession, path: str | list[str], sep: str = "\t") -> DataFrame:
    """Scan with inferred types, for profiling checks on raw files only.

    One aggregate over the text profiles all columns; the narrowest type that
    every filled cell has is then cast to.  A column without a filled cell
    stays text.
    """
    parts = _by_header(spark, path, sep)
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    kinds = profile_types(rows)
    return rows.select(*[F.col(f"`{c}`").try_cast(kinds[c]).alias(c) for c in rows.columns])


def profile_types(rows: DataFrame, types: Sequence[str] = PROFILE_TYPES) -> dict[str, str]:
    """The narrowest of ``types`` for every text column, ``string`` if none fits."""

    def misses(column: str, kind: str) -> Column:
        cell = F.col(f"`{column}`")
        return F.count_if(cell.isNotNull() & cell.try_cast(kind).isNull())

    tests = [misses(c, t).alias(f"m{i}_{t}") for i, c in enumerate(rows.columns) for t in types]
    filled = [F.count(f"`{c}`").alias(f"n{i}") for i, c in enumerate(rows.columns)]
    seen = rows.agg(*tests, *filled).first()  # one row
    found = {}
    for i, c in enumerate(rows.columns):
        fits = [t for t in types if seen[f"m{i}_{t}"] == 0] if seen[f"n{i}"] else []
        found[c] = fits[0] if fits else "string"
    return found


def _by_header(spark: SparkSession, path, sep: str) -> list[DataFrame]:
    """One scan for each distinct header line; Spark checks every file against its scan's.

    Only the first line of a file is looked at beforehand, so files are read once.
    """
    groups: dict[str, list[str]] = defaultdict(list)
    for file in spark.read.text(path).inputFiles():  # a listing; URIs, encoded
        header = first_line(spark, file)
        if header is not None:
            groups[header].append(re.sub(r"([{}\[\]*?\\])", r"\\\1", unquote(file)))
    reader = spark.read.option("header", True).option("sep", sep).option("enforceSchema", False)
    return [reader.csv(files) for _, files in sorted(groups.items())] or [reader.csv(path)]


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file given by its URI; None if it is empty."""
    hadoop = spark._jvm.org.apache.hadoop
    conf = spark._jsc.hadoopConfiguration()
    where = hadoop.fs.Path(spark._jvm.java.net.URI(file))
    stream = where.getFileSystem(conf).open(where)
    codec = hadoop.io.compress.CompressionCodecFactory(conf).getCodec(where)
    stream = codec.createInputStream(stream) if codec is not None else stream
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def source_digests(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(path, length, sha256)`` of the raw bytes of every file under ``paths``.

    Files are hashed inside Spark, each as one row; Spark refuses a file of
    2 GB or more, which has to be delivered in parts.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))
