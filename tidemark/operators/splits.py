"""Row routing: scope, validity, and the counters that go with them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casting import cast_declared
from tidemark.model import BATCH_ID, INGEST_TS, FactModel

IN_SCOPE = "_in_scope"
LANE = "_lane"


def in_scope(scope: Sequence[str]) -> Column:
    """True when every scope column is NULL or blank; never NULL itself."""
    return _all(F.coalesce(F.col(c), F.lit("")) == "" for c in scope)


def split_scope(df: DataFrame, scope: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(in scope, scoped out)``: disjoint and total."""
    keep = in_scope(scope)
    return df.filter(keep), df.filter(~keep)


def all_present(required: Sequence[str]) -> Column:
    return _all(F.col(c).isNotNull() for c in required)


def all_filled(required: Sequence[str]) -> Column:
    """Raw-text form of :func:`all_present`: neither NULL nor empty.

    Differs from the typed form on text that is filled but does not cast.
    """
    return _all(F.col(c).isNotNull() & (F.col(c) != "") for c in required)


def split_valid(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(usable rows, rows missing a required value)``: disjoint and total."""
    usable = all_present(required)
    return df.filter(usable), df.filter(~usable)


def route(raw: DataFrame, model: FactModel) -> DataFrame:
    """Typed facts tagged with the lane each row belongs to.

    One projection replaces separate scope, cast and validity passes: lanes
    are ``scoped_out``, ``quarantined`` and ``valid``.
    """
    flagged = raw.withColumn(IN_SCOPE, in_scope(model.scope))
    typed = cast_declared(flagged, model.fact_types, keep=(INGEST_TS, BATCH_ID, IN_SCOPE))
    lane = (
        F.when(~F.col(IN_SCOPE), "scoped_out")
        .when(~all_present(model.row_required), "quarantined")
        .otherwise("valid")
    )
    return typed.withColumn(LANE, lane).drop(IN_SCOPE)


def lane_counters() -> list[Column]:
    """Aggregates over a routed frame, for ``agg`` or ``observe``."""
    return [
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col(LANE) == "scoped_out").alias("scoped_out"),
        F.count_if(F.col(LANE) == "quarantined").alias("quarantined"),
        F.count_if(F.col(LANE) == "valid").alias("valid"),
    ]


def _all(predicates) -> Column:
    return reduce(lambda a, b: a & b, predicates, F.lit(True))
