"""Ordered windows that stay balanced when one key holds most of the rows.

``Window.partitionBy(key)`` sends every row of a key to one task.  When a few
keys are far larger than a task should be, their rows are cut into *slices*
along the window order: slice numbers grow with the order, so a window over
``(key, slice)`` plus one small lookup of "first row of the next slice" gives
exactly what the window over ``key`` would.  Where to cut is planned from a
sample of key and order columns; the sample decides balance only, the windows
run over every row.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import columns

SMALL_TABLE_ROWS = 10_000_000  # below this no key can hurt a task
SLICE_ROWS = (2_000_000, 50_000_000)  # least and most rows aimed at per slice
PLAN_SAMPLE_ROWS = 400_000
HITS_PER_SLICE = 40  # sampled rows wanted between two cuts

_HASH, _SLICE, _NEXT = "_key_hash", "_slice", "_next_first"
_HEADS, _GROUPS, _STRIDE = "_heads", "_groups", "_stride"


@dataclass(frozen=True)
class SlicePlan:
    """Cut points of the large keys, one row per key.

    They are driver values, so every task and every retry sees the same cuts.
    Cuts lie about ``rows_per_slice`` rows apart, so over all keys there are at
    most ``total rows / rows_per_slice`` of them (about one per shuffle task);
    that bound is what makes broadcasting them safe.  Two keys with equal
    hashes share cuts; slices still follow the order inside each of them.

    The sorted cuts of a key are kept as about sqrt(n) groups with their heads,
    so placing a row looks at 2 * sqrt(n) cuts, not at all of them.
    """

    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: DataFrame


def plan_slices(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    derive: Callable[[DataFrame], DataFrame] | None = None,
    at_most: int | None = None,
    rows_per_slice: int | None = None,
    small_table: int = SMALL_TABLE_ROWS,
    sample_rows: int = PLAN_SAMPLE_ROWS,
    hits_per_slice: int = HITS_PER_SLICE,
) -> SlicePlan | None:
    """Find keys too large for one task; None when there are none.

    ``derive`` builds the frame to be windowed from (sampled) ``rows``, for
    example a join with an index that has at most one match per row.
    ``at_most`` is a known bound of the row count, such as a table's commit
    log gives; without it the rows are counted.
    """
    total = rows.count() if at_most is None else at_most
    if total < small_table:
        return None
    if rows_per_slice is None:
        least, most = SLICE_ROWS
        rows_per_slice = min(max(least, total // _shuffle_tasks(rows)), most)
    fraction = min(1.0, max(sample_rows, hits_per_slice * total // rows_per_slice) / total)
    sampled = rows.sample(fraction, seed=17) if fraction < 1.0 else rows
    seen = (derive(sampled) if derive else sampled).select(
        F.xxhash64(*columns(keys)).alias(_HASH), F.struct(*columns(order)).alias("_o")
    )
    step = max(1, int(rows_per_slice * fraction))  # sampled rows between two cuts
    large = seen.groupBy(_HASH).agg(F.count("*").alias("_n")).filter(F.col("_n") > 2 * step)
    found = large.select(_HASH).collect()  # fewer keys than there may be cuts
    if not found:
        return None

    spark = rows.sparkSession
    wanted = F.broadcast(spark.createDataFrame(found, f"{_HASH} bigint"))
    cuts = (
        seen.join(wanted, _HASH)
        .groupBy(_HASH)
        .agg(F.sort_array(F.collect_list("_o")).alias("_all"))  # of the sample only
        .select(_HASH, F.expr(f"filter(_all, (o, i) -> i > 0 AND i % {step} = 0)").alias("_cuts"))
    )
    point = cuts.schema["_cuts"].dataType.elementType
    schema = (
        T.StructType()
        .add(_HASH, T.LongType())
        .add(_STRIDE, T.IntegerType())
        .add(_HEADS, T.ArrayType(point))
        .add(_GROUPS, T.ArrayType(T.ArrayType(point)))
    )
    grouped = [_grouped(r[_HASH], r["_cuts"]) for r in cuts.collect() if r["_cuts"]]
    if not grouped:
        return None
    return SlicePlan(tuple(keys), tuple(order), spark.createDataFrame(grouped, schema))


def _shuffle_tasks(df: DataFrame) -> int:
    conf = df.sparkSession.conf
    first = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(int(conf.get("spark.sql.shuffle.partitions", "200")), int(first or 1))


def _grouped(key_hash: int, cuts: list) -> tuple:
    stride = math.isqrt(len(cuts) - 1) + 1
    groups = [cuts[i : i + stride] for i in range(0, len(cuts), stride)]
    return key_hash, stride, [g[0] for g in groups], groups


def with_slice(df: DataFrame, plan: SlicePlan) -> DataFrame:
    """Add ``_slice``: 0 for ordinary keys, else the number of cuts at or below the row."""
    here = F.struct(*columns(plan.order))
    passed = lambda cuts: F.size(F.filter(cuts, lambda cut: cut <= here))
    heads = passed(F.col(_HEADS))
    inside = passed(F.element_at(_GROUPS, heads))
    placed = F.when(heads == 0, 0).otherwise((heads - 1) * F.col(_STRIDE) + inside)
    return (
        df.withColumn(_HASH, F.xxhash64(*columns(plan.keys)))
        .join(F.broadcast(plan.cuts), _HASH, "left")
        .withColumn(_SLICE, F.when(F.col(_HEADS).isNotNull(), placed).otherwise(F.lit(0)))
        .drop(_GROUPS)
    )


def next_in_order(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    plan: SlicePlan | None = None,
    alias: str = "_next",
) -> DataFrame:
    """Add the ``value`` of the following row of the same key, NULL on the last.

    Without a plan this is ``lead`` over one window.  With a plan the window
    runs per slice, and the last row of a slice takes the first value of the
    key's next non-empty slice.
    """
    if plan is None:
        by_key = Window.partitionBy(*keys).orderBy(*columns(order))
        return df.withColumn(alias, F.lead(value).over(by_key))

    sliced = with_slice(df, plan)
    if value == order[0]:  # a plain minimum; NULLs sort first, so any NULL is the first value
        has_null = F.count_if(F.col(value).isNull()) > 0
        first = F.when(~has_null, F.min(value))
    else:
        first = F.min(F.struct(*columns(order), F.col(value).alias("_v"))).getField("_v")
    across = Window.partitionBy(*keys).orderBy(_SLICE)
    # One row per slice of a large key: bounded by the plan's cuts.
    following = (
        sliced.filter(F.col(_HEADS).isNotNull())
        .groupBy(*keys, _SLICE)
        .agg(first.alias("_first"))
        .select(
            *[F.col(k).alias(f"_k_{k}") for k in keys],
            F.col(_SLICE).alias("_s"),
            F.lead("_first").over(across).alias(_NEXT),
        )
        .filter(F.col(_NEXT).isNotNull())
    )
    in_slice = Window.partitionBy(*keys, _SLICE).orderBy(*columns(order))
    same = F.col(_SLICE) == F.col("_s")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    has_next: Column = F.lead(F.lit(True)).over(in_slice).isNotNull()
    return (
        sliced.withColumn("_has_next", has_next)
        .withColumn("_in_slice", F.lead(value).over(in_slice))
        .join(F.broadcast(following), same, "left")
        .withColumn(alias, F.when(F.col("_has_next"), F.col("_in_slice")).otherwise(F.col(_NEXT)))
        .select(*df.columns, alias)
    )
