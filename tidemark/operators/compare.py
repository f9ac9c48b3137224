"""Comparisons of tables and versions: anti-joins, gaps, rerun checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import content_fingerprint
from tidemark.sources.tables import VersionedTable


def missing_from(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected keys that have no actual row: explicit holes, never implied ones."""
    return expected.join(actual.select(*keys), list(keys), "left_anti")


def two_way_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Counts of rows on each side whose ``key`` the other side lacks.

    Both zero means the two versions hold the same set of keys.
    """
    only_left = missing_from(left.select(key), right, [key]).agg(
        F.count(F.lit(1)).alias("only_left")
    )
    only_right = missing_from(right.select(key), left, [key]).agg(
        F.count(F.lit(1)).alias("only_right")
    )
    tagged = only_left.select("only_left", F.lit(0).cast("bigint").alias("only_right")).unionByName(
        only_right.select(F.lit(0).cast("bigint").alias("only_left"), "only_right")
    )
    return tagged.agg(F.sum("only_left").alias("only_left"), F.sum("only_right").alias("only_right"))


def compare_fingerprints(
    before: DataFrame, after: DataFrame, exclude: Sequence[str] = ()
) -> DataFrame:
    """One row: both row counts, both content hashes, and whether they agree."""
    both = (
        content_fingerprint(before, exclude)
        .withColumn("side", F.lit("before"))
        .unionByName(content_fingerprint(after, exclude).withColumn("side", F.lit("after")))
    )
    of = lambda c, side: F.max(F.when(F.col("side") == side, F.col(c)))
    return both.agg(
        of("n_rows", "before").alias("rows_before"),
        of("n_rows", "after").alias("rows_after"),
        of("content_hash", "before").alias("hash_before"),
        of("content_hash", "after").alias("hash_after"),
    ).withColumn(
        "same",
        (F.col("rows_before") == F.col("rows_after"))
        & (F.col("hash_before") == F.col("hash_after")),
    )


@dataclass(frozen=True)
class LakeState:
    """Versions and counts noted before a rerun."""

    silver: int
    gold: int
    bronze_rows: int
    registry_rows: int
    quarantine_rows: int


def note_state(lake) -> LakeState:
    return LakeState(
        silver=lake.silver.latest_version(),
        gold=lake.gold.latest_version(),
        bronze_rows=lake.bronze_facts.row_count(),
        registry_rows=lake.registry.row_count(),
        quarantine_rows=lake.quarantine_rows.row_count(),
    )


def rerun_diff(lake, before: LakeState, rerun_quarantined: int) -> DataFrame:
    """What a rerun of one batch changed, as ``(check, got, want, ok)`` rows.

    Bronze and registry keep their counts, the quarantine lane grows by exactly
    the batch's quarantined rows, silver is unchanged but for its load time,
    gold is unchanged, and the silver merge inserted nothing.
    """
    spark = lake.spark

    def prints(table: VersionedTable, version: int | None, exclude=()) -> tuple[int, str]:
        row = content_fingerprint(table.read(version), exclude).first()
        return row["n_rows"], row["content_hash"]

    s_before, s_after = (
        prints(lake.silver, before.silver, ["_ingest_ts"]),
        prints(lake.silver, None, ["_ingest_ts"]),
    )
    g_before, g_after = prints(lake.gold, before.gold), prints(lake.gold, None)
    rerun_commit = lake.silver.commits().filter(F.col("version") == before.silver + 1).first()
    inserted = rerun_commit["num_inserted"] if rerun_commit else -1
    checks = [
        ("bronze count unchanged", lake.bronze_facts.row_count(), before.bronze_rows),
        ("registry count unchanged", lake.registry.row_count(), before.registry_rows),
        (
            "quarantine grew by the rerun's quarantined rows",
            lake.quarantine_rows.row_count(),
            before.quarantine_rows + rerun_quarantined,
        ),
        ("silver count unchanged", s_after[0], s_before[0]),
        ("silver content unchanged", s_after[1], s_before[1]),
        ("gold count unchanged", g_after[0], g_before[0]),
        ("gold content unchanged", g_after[1], g_before[1]),
        ("silver merge inserted rows", inserted, 0),
    ]
    rows = [(name, str(got), str(want), got == want) for name, got, want in checks]
    return spark.createDataFrame(rows, "check string, got string, want string, ok boolean")
