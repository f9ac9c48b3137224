"""Known-bad copies of a table: a check proves something only if it can fail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.periods import shift_years
from tidemark.model import FactModel


class TwinRefused(ValueError):
    """The request would not give a usable known-bad copy (exit code 3)."""

    exit_code = 3


def require_twin_destination(path: str) -> None:
    """Only a path marked as a twin may be written with planted defects."""
    if "twin" not in path.lower():
        raise TwinRefused(f"{path} does not look like a twin copy (no 'twin' in path)")


def lookahead_twin(
    gold: DataFrame, model: FactModel, subset: Column, years: int = 5
) -> DataFrame:
    """Copy in which the rows of ``subset`` were known ``years`` × 365 days later.

    ``valid_from`` stays, so the lookahead check must report exactly the
    planted rows and every other check must stay as it was.
    """
    moved = F.when(subset, shift_years(F.col(model.known_at), years))
    return gold.withColumn(model.known_at, moved.otherwise(F.col(model.known_at)))


def seeded_sample(df: DataFrame, n: int, seed: int, key: Sequence[str] | None = None) -> DataFrame:
    """Exactly ``n`` rows picked by a seeded hash, however the data is partitioned."""
    names = list(key or df.columns)
    rank = F.xxhash64(*[F.col(c) for c in names], F.lit(seed))
    return df.orderBy(rank, *[F.col(c) for c in names]).limit(n)


def null_twin(
    df: DataFrame, column: str, n: int, seed: int, key: Sequence[str] | None = None
) -> DataFrame:
    """Copy in which ``column`` is NULL on exactly ``n`` seeded rows.

    With a unique ``key`` the picked keys are joined back.  Without one the
    picked rows are taken out as a multiset, so equal rows count one by one.
    """
    if column not in df.columns:
        raise TwinRefused(f"column '{column}' not found")
    rows = df.count()
    if rows == 0:
        raise TwinRefused("zero data rows -- nothing to mutate")
    if n < 1:
        raise TwinRefused(f"count {n} must be >= 1")
    if n > rows:
        raise TwinRefused(f"count {n} exceeds {rows} available rows")
    if key:
        picked = seeded_sample(df.select(*key), n, seed).withColumn("_picked", F.lit(True))
        marked = df.join(picked, list(key), "left")
        planted = F.when(F.col("_picked"), F.lit(None)).otherwise(F.col(column))
        return marked.withColumn(column, planted).select(*df.columns)
    picked = seeded_sample(df, n, seed)
    blank = picked.withColumn(column, F.lit(None).cast(df.schema[column].dataType))
    return df.exceptAll(picked).unionByName(blank)


def dropped_column_twin(df: DataFrame, column: str) -> DataFrame:
    """Copy without one source column; the batch must be refused as unevaluable."""
    if column not in df.columns:
        raise TwinRefused(f"column '{column}' not found")
    return df.drop(column)
