"""Keyed merge of a batch into a table, as DataFrame branches.

NULL keys never match (plain equality), so such source rows insert and such
target rows stay.  All joins put the possibly repeated side on the left, where
adaptive execution can split a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.model import INGEST_TS

INSERT, UPDATE, NOOP = "insert", "update", "noop"


class AmbiguousSource(ValueError):
    """More than one source row matches one target row."""


def newer(column: str = INGEST_TS) -> Column:
    """Update condition "the source row is strictly later" for merge joins."""
    return F.col(f"s.{column}") > F.col(f"t.{column}")


def insert_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus the source rows whose key it lacks; matches change nothing.

    Equal rows inside the source all land: the merge compares source with
    target, not source with itself.
    """
    return target.unionByName(unmatched(source, target, keys))


def unmatched(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key no target row has."""
    known = target.select(*keys).distinct()
    return source.join(known, list(keys), "left_anti")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_when: Column | None = None,
) -> DataFrame:
    """Full new state: matched rows replaced (when the condition holds), rest inserted.

    ``update_when`` compares ``s.<col>`` with ``t.<col>``; None updates every
    match.  The source must hold one row per matched key
    (:func:`ambiguous_keys`).
    """
    names = target.columns
    s = source.select(*names, F.lit(True).alias("_hit")).alias("s")
    t = target.alias("t")
    replaced = F.coalesce(F.col("s._hit") & _condition(update_when), F.lit(False))
    kept = t.join(s, _same_key(keys), "left").select(
        *[F.when(replaced, F.col(f"s.{n}")).otherwise(F.col(f"t.{n}")).alias(n) for n in names]
    )
    return kept.unionByName(unmatched(source.select(*names), target, keys))


def classify(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    update_when: Column | None = None,
    compare: Sequence[str] = (),
) -> DataFrame:
    """Source rows with ``op``: insert, update or noop.

    Reads only the key and compare columns of the target, so a table merge
    costs a scan of those plus the batch, not a rewrite.  The target is
    expected to hold one row per key.
    """
    t = target.select(*keys, *compare, F.lit(True).alias("_hit")).alias("t")
    op = (
        F.when(F.col("t._hit").isNull(), INSERT)
        .when(_condition(update_when), UPDATE)
        .otherwise(NOOP)
    )
    s = source.alias("s")
    return s.join(t, _same_key(keys), "left").select("s.*", op.alias("op"))


def classify_in_place(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    update_when: Column | None = None,
    compare: Sequence[str] = (),
    nth: str | None = None,
) -> DataFrame:
    """:func:`classify` for sides dealt alike by some of the keys: no row moves.

    A join would deal both sides again by the whole key; a window over the key does not.
    ``nth`` names a column that numbers the source rows of a key, by the same sort.
    """
    names, met = source.columns, F.struct(*compare, F.lit(True).alias("_hit"))
    known = {f.name: F.col(f.name) if f.name in keys else F.lit(None).cast(f.dataType) for f in source.schema}
    blank = F.lit(None).cast(target.select(met.alias("_t")).schema["_t"].dataType)
    both = source.select(*names, blank.alias("_t")).union(
        target.select(*[c.alias(n) for n, c in known.items()], met.alias("_t"))
    )
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    of_key = Window.partitionBy(*keys).orderBy(F.col("_t").isNotNull())  # source rows first
    every = of_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = {"t": F.when(whole, F.max("_t").over(every))}
    if nth:
        found[nth] = F.row_number().over(of_key)
    rows = both.withColumns(found).filter(F.col("_t").isNull())
    op = F.when(F.col("t").isNull(), INSERT).when(_condition(update_when), UPDATE).otherwise(NOOP)
    return rows.withColumn("s", F.struct(*names)).select(*names, *([nth] if nth else []), op.alias("op"))


def merge_metrics(classified: DataFrame) -> DataFrame:
    """``num_source, num_inserted, num_updated, dedupe`` of classified source rows."""
    inserted, updated = F.count_if(F.col("op") == INSERT), F.count_if(F.col("op") == UPDATE)
    return classified.agg(
        F.count(F.lit(1)).alias("num_source"),
        inserted.alias("num_inserted"),
        updated.alias("num_updated"),
        (F.count(F.lit(1)) - inserted - updated).alias("dedupe"),
    )


def ambiguous_keys(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that several source rows share and the target also holds, with the count."""
    repeated = (
        source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_source")).filter("n_source > 1")
    )
    return repeated.join(target.select(*keys), list(keys), "left_semi")


def require_unambiguous(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> None:
    head = ambiguous_keys(source, target, keys).limit(5).collect()
    if head:
        raise AmbiguousSource(f"several source rows match one target row, e.g. {head}")


def require_unique(rows: DataFrame, keys: Sequence[str]) -> None:
    head = rows.groupBy(*keys).count().filter("count > 1").limit(5).collect()
    if head:
        raise AmbiguousSource(f"rows are not unique on {tuple(keys)}, e.g. {head}")


def _same_key(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"s.{k}") == F.col(f"t.{k}") for k in keys])


def _condition(update_when: Column | None) -> Column:
    return F.lit(True) if update_when is None else update_when
