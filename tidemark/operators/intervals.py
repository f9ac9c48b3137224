"""Validity intervals and as-of reads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.model import OPEN_END, FactModel, instant
from tidemark.operators.skew import SlicePlan, next_in_order, plan_slices
from tidemark.sources.tables import VersionedTable


def attach_filings(facts: DataFrame, filings: DataFrame, model: FactModel) -> DataFrame:
    """Facts with the filing's entity and acceptance time; orphan facts drop out.

    The filing index is one row per link value, so the join never fans out.
    Spark picks the join from measured sizes; a filing with very many facts is
    split by adaptive execution.
    """
    index = filings.select(*model.filing_types)
    from_filing = [c for c in model.natural_key + (model.known_at,) if c in model.filing_types]
    from_fact = [
        c
        for c in dict.fromkeys((*model.natural_key, model.value, *model.tiebreak))
        if c not in from_filing and c != model.link
    ]
    joined = facts.select(model.link, *from_fact).join(index, model.link, "inner")
    wanted = dict.fromkeys((*model.natural_key, model.value, *model.order))
    return joined.select(*wanted)


def orphan_facts(facts: DataFrame, filings: DataFrame, model: FactModel) -> DataFrame:
    """Facts whose filing is in no index row; they explain fact minus gold counts."""
    return facts.join(filings.select(model.link), model.link, "left_anti")


def validity_intervals(
    rows: DataFrame, model: FactModel, plan: SlicePlan | None = None
) -> DataFrame:
    """``[valid_from, valid_to)`` per row: from known until the next restatement.

    The last restatement of a key stays open.  Of rows known at the same
    instant only the greatest in restatement order gets a non-empty interval.
    """
    ahead = next_in_order(rows, model.natural_key, model.order, model.known_at, plan, "_until")
    return ahead.select(
        *rows.columns,
        F.col(model.known_at).alias("valid_from"),
        F.coalesce("_until", instant(OPEN_END)).alias("valid_to"),
    )


def build_intervals(
    facts: DataFrame,
    filings: DataFrame,
    model: FactModel,
    plan: SlicePlan | None = None,
) -> DataFrame:
    """Join facts to the filing index and derive validity intervals."""
    return validity_intervals(attach_filings(facts, filings, model), model, plan)


def plan_interval_slices(
    facts: DataFrame,
    filings: DataFrame,
    model: FactModel,
    keys: Sequence[str] | None = None,
    **options,
) -> SlicePlan | None:
    """Slice plan for :func:`build_intervals`; for windows over ``keys`` if others are given.

    Joins only the planning sample, whose size the planner fixes, so it can be
    broadcast to the filing index instead of shuffling the index for a plan.
    """
    return plan_slices(
        facts,
        keys or model.natural_key,
        model.order,
        derive=lambda sampled: attach_filings(F.broadcast(sampled), filings, model),
        **options,
    )


def as_of_ranked(
    rows: DataFrame,
    at: str | Column,
    model: FactModel,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Latest row per key among those known at ``at`` (inclusive).

    Ranked form; needs no stored intervals.  Spark limits each map task to one
    row per key before the shuffle, so a large key does not pile up.  Passing
    another ``order`` (arrival time, say) is how the negative control shows
    that a wrong order gives wrong answers.
    """
    at = instant(at) if isinstance(at, str) else at
    newest = Window.partitionBy(*model.natural_key).orderBy(
        *[F.col(c).desc() for c in (order or model.order)]
    )
    return (
        rows.filter(F.col(model.known_at) <= at)
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def as_of(
    gold: DataFrame | VersionedTable, at: str | Column, mask_future: bool = False, **key_values
) -> DataFrame:
    """Rows valid at ``at``: a plain filter on stored intervals, no shuffle.

    ``key_values`` narrow the read to given key columns; all predicates reach
    the file scan.  Given the stored table instead of a frame, a wanted entity
    also narrows the scan to the one folder that can hold it.  ``mask_future`` reports intervals that close after ``at``
    as open, so the answer carries nothing learned later.
    """
    at = instant(at) if isinstance(at, str) else at
    if isinstance(gold, VersionedTable):
        gold = gold.read(near=key_values)
    visible = gold.filter((F.col("valid_from") <= at) & (F.col("valid_to") > at))
    for name, wanted in key_values.items():
        visible = visible.filter(F.col(name) == F.lit(wanted))
    if mask_future:
        visible = visible.withColumn("valid_to", instant(OPEN_END))
    return visible


def as_of_disagreements(gold: DataFrame, at: str, model: FactModel) -> DataFrame:
    """Rows that only one of the two as-of forms returns (none when intervals are right)."""
    names = list(dict.fromkeys((*model.natural_key, *model.order)))
    ranked = as_of_ranked(gold, at, model).select(*names)
    stored = as_of(gold, at).select(*names)
    only_ranked = _minus(ranked, stored, names).withColumn("side", F.lit("ranked"))
    only_stored = _minus(stored, ranked, names).withColumn("side", F.lit("interval"))
    return only_ranked.unionByName(only_stored)


def _minus(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    other = right.select(*[F.col(n).alias(f"_r_{n}") for n in names])
    same = F.lit(True)
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_r_{n}"))
    return left.join(other, same, "left_anti")


def gold_profile(gold: DataFrame, model: FactModel, entity: str) -> DataFrame:
    """Row count, exact entity count and the time span of a gold table."""
    return gold.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(entity).alias("n_entities"),
        F.min(model.known_at).alias("first_known"),
        F.max(model.known_at).alias("last_known"),
    )
