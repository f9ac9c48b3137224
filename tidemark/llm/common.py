"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_folder


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole_text(text: str | Column) -> Column:
    """The text itself; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def texts_of(batch: pa.RecordBatch, column: int) -> Iterator[str | None]:
    """Texts of one column, one at a time, so that a batch is never held twice."""
    return (x.as_py() for x in batch.column(column))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has such a column."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name


def keep_once(docs: DataFrame, kept: DataFrame, id_col: str, mark: Column, label: str) -> DataFrame:
    """The rows of ``docs`` named by ``kept`` (columns id, mark), one row for each.

    ``mark`` is the expression over ``docs`` that ``kept`` was made with; id and
    mark together name a row up to repetition, and of repeated rows one stays.
    """
    key, same, count = (fresh(docs, x) for x in ("_id", "_mark", "_n"))
    names = kept.groupBy(F.col("id").alias(key), F.col("mark").alias(same))
    names = staged(names.agg(F.count(F.lit(1)).alias(count)), label)
    own = [docs[c] for c in docs.columns]
    joined = docs.join(
        names.hint("shuffle_hash"), docs[id_col].eqNullSafe(F.col(key)) & (mark == F.col(same))
    )
    if names.filter(F.col(count) > 1).isEmpty():
        return joined.select(*own)
    repeated = joined.filter(F.col(count) > 1).dropDuplicates([key, same]).select(*own)
    return joined.filter(F.col(count) == 1).select(*own).unionAll(repeated)
