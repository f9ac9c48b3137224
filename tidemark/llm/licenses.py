"""License notices found by MinHash over overlapping text windows, in built-in functions only.

Shingles are five words.  A window is ``WINDOW`` neighbouring shingles and
starts every half window; a template has one at each of its shingles.  Windows
that share a MinHash value in some band bring a template up as a candidate;
exact shingle containment then decides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import whole_text

SHINGLE = 5
#: Least share of a template's distinct shingles that a document must hold.
CONTAINMENT = 0.8
#: Shingles of a window, twice the step between windows.
WINDOW = 4
#: Bands of one MinHash value.  A window that shares three of its four shingles with a
#: template's has a Jaccard similarity of 3/5: it is missed with probability 0.4 ** 8 < 0.001.
BANDS = 8

# Notices as their publishers word them.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at"
    ),
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction"
    ),
    "BSD-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met"
    ),
    "GPL-free-software": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
    "CC-BY-SA-4.0": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License."
    ),
}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Runs of ASCII letters and digits and of anything beyond ASCII, A-Z lower-cased."""
    plain = F.translate(text, UPPER, LOWER)
    return F.filter(F.split(plain, r"[\x00-/:-`{-\x7f]+"), lambda w: w != "")


def shingles(w: Column) -> Column:
    """Shingles of a word list as text; fewer words than a shingle make one, none make none."""
    count = F.greatest(F.size(w) - (SHINGLE - 1), F.lit(1))
    each = F.transform(
        F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(w, i, SHINGLE), " ")
    )
    return F.when(F.size(w) > 0, each).otherwise(F.array().cast("array<string>"))


def shingle_hashes(w: Column) -> Column:
    """One 64-bit hash for each shingle of a word list."""
    count = F.greatest(F.size(w) - (SHINGLE - 1), F.lit(1))
    each = F.transform(
        F.sequence(F.lit(1), count), lambda i: F.xxhash64(F.slice(w, i, SHINGLE))
    )
    return F.when(F.size(w) > 0, each).otherwise(F.array().cast("array<bigint>"))


def _least(hashes: Column, band: int) -> Column:
    """MinHash value of a band; the first band orders shingles by their own hash."""
    if not band:
        return F.array_min(hashes)
    return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band))))


def _least_of_each(lists: Column, band: int) -> Column:
    return F.transform(lists, lambda hashes: _least(hashes, band))


def template_table(spark: SparkSession, templates: dict[str, str]) -> list[dict]:
    """Templates with their distinct shingles and the MinHash values of their windows."""
    frame = spark.createDataFrame(sorted(templates.items()), "license string, text string")
    frame = frame.withColumn("w", words(F.col("text")))
    frame = frame.withColumn("h", shingle_hashes(F.col("w")))
    starts = F.sequence(F.lit(1), F.greatest(F.size("h") - (WINDOW - 1), F.lit(1)))
    windows = F.transform(starts, lambda i: F.slice("h", i, WINDOW))
    bands = [F.array_distinct(_least_of_each(windows, b)).alias(f"band{b}") for b in range(BANDS)]
    return [
        r.asDict()
        for r in frame.select(
            "license",
            F.array_distinct(shingles(F.col("w"))).alias("shingles"),
            F.array_distinct("h").alias("hashes"),
            *bands,
        ).collect()
    ]


def _longs(values) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in sorted(set(values))])


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_licenses, licenses`` (sorted names, comma-joined).

    A template counts when the document holds at least ``CONTAINMENT`` of its
    distinct shingles.  Templates of one or two shingles are looked for in
    windows of one shingle, where a MinHash value is the shingle's own hash.
    Null, empty and wordless texts hold none.
    """
    spark = docs.sparkSession
    known = template_table(spark, {k: v for k, v in templates.items() if v.strip()})
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("w", words(F.col("text"))).drop("text")
    rows = rows.withColumn("h", shingle_hashes(F.col("w")))
    tiny = [t for t in known if len(t["hashes"]) <= 2]
    large = [t for t in known if len(t["hashes"]) > 2]
    # MinHash of half windows; a window is two neighbouring halves
    half = WINDOW // 2
    count = F.ceil(F.size("h") / half).cast("int")
    halves = F.when(
        F.size("h") > 0,
        F.transform(
            F.sequence(F.lit(0), count - 1), lambda i: F.slice("h", i * half + 1, half)
        ),
    ).otherwise(F.array().cast("array<array<bigint>>"))
    rows = rows.withColumn("halves", halves)
    for b in range(BANDS if large else 0):
        rows = rows.withColumn(f"m{b}", _least_of_each(F.col("halves"), b))
    met = F.arrays_overlap("h", _longs(h for t in tiny for h in t["hashes"])) if tiny else None
    bands = []
    for b in range(BANDS if large else 0):
        m = F.col(f"m{b}")
        window = F.zip_with(m, F.slice(m, 2, F.greatest(F.size(m), F.lit(1))), lambda a, c: F.least(a, c))
        bands.append(F.arrays_overlap(window, _longs(v for t in large for v in t[f"band{b}"])))
    candidate = reduce(lambda a, b: a | b, [c for c in (met, *bands) if c is not None], F.lit(False))
    held = F.filter(
        F.array(*[_verified(t) for t in known]) if known else F.array().cast("array<string>"),
        lambda x: x.isNotNull(),
    )
    nothing = F.array().cast("array<string>")
    rows = rows.select("doc_id", F.when(candidate, shingles(F.col("w"))).alias("s"))
    found = F.when(F.col("s").isNotNull(), held).otherwise(nothing)
    rows = rows.select("doc_id", found.alias("found"))
    return rows.select(
        "doc_id",
        F.size("found").cast("long").alias("n_licenses"),
        F.array_join("found", ",").alias("licenses"),
    )


def _verified(template: dict) -> Column:
    """The template's name where enough of its shingles stand among a document's, else null."""
    texts = F.array(*[F.lit(s) for s in template["shingles"]])
    there = F.size(F.array_intersect(texts, F.col("s")))
    enough = there >= CONTAINMENT * len(template["shingles"])
    return F.when(enough, F.lit(template["license"]))
