"""Silver stage: route, gate, merge, count."""

from __future__ import annotations

import time
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.frames import one_row
from tidemark.model import BATCH_ID, INGEST_TS, Contract, instant
from tidemark.operators.merge import newer
from tidemark.operators.quality import (
    FAIL,
    PASS,
    UNEVALUABLE,
    Outcome,
    QualityHalt,
    Violation,
    counters,
    missing_source_columns,
    outcome_of,
    type_mismatches,
)
from tidemark.operators.splits import LANE, lane_counters, route, split_valid
from tidemark.plans.lake import UNEVALUABLE_SCHEMA, Lake
from tidemark.sources.logs import RUN_LINE_FIELDS, run_line


@dataclass(frozen=True)
class RunMetrics:
    batch_id: str
    rows_in: int
    rows_out: int
    scoped_out: int
    rejected: int
    quarantined: int
    gate: str
    delta_version: int
    wall_clock_ms: int = 0

    def frame(self, spark: SparkSession) -> DataFrame:
        ddl = ", ".join(f"{n} {t}" for n, t in RUN_LINE_FIELDS)
        return one_row(spark, tuple(asdict(self).values()), ddl)

    def line(self, spark: SparkSession) -> str:
        return self.frame(spark).select(run_line()).first()[0]


def run_silver(
    lake: Lake, facts: DataFrame, filings: DataFrame, batch_id: str, ingest_ts: str
) -> RunMetrics:
    """Bring one batch into silver, or refuse it whole.

    The batch is read twice.  Rows are counted while the quarantined ones are
    written; the gate's counts are observed while the valid ones are written,
    and only a version that passes is published.  A refused batch leaves rows
    in its lane and raises :class:`QualityHalt`; nothing of it can be read from
    silver.  Filings without a link, an entity or a time
    are quarantined in a lane of their own; their facts stay in silver and out
    of gold, as those of any unknown filing.  Repeated filings refuse the batch.
    """
    started = time.monotonic()
    model, contract = lake.model, lake.model.contract

    reason = missing_source_columns(facts, (*contract.types, *model.scope))
    reason = reason or missing_source_columns(filings, tuple(model.filing_types))
    if reason:
        _refuse(lake, batch_id, Outcome(UNEVALUABLE, reason))

    stamps = {BATCH_ID: F.lit(batch_id), INGEST_TS: instant(ingest_ts)}
    unstamped = {c: v for c, v in stamps.items() if c not in facts.columns}
    routed = route(facts.withColumns(unstamped) if unstamped else facts, model)
    seen = Observation()
    links = F.approx_count_distinct(F.when(F.col(LANE) == "valid", F.col(model.link)))
    counted = routed.observe(seen, *lane_counters(), links.alias("links"))
    lane = lake.quarantine_rows
    before = lane.row_count()
    lane.append(counted.filter(F.col(LANE) == "quarantined").drop(LANE), label=batch_id)
    seen = seen.get

    valid = routed.filter(F.col(LANE) == "valid").drop(LANE)
    reason = type_mismatches(valid.schema, contract.types)
    if not reason and not seen["valid"]:
        reason = "empty batch where rows expected"
    if reason:
        _refuse(lake, batch_id, Outcome(UNEVALUABLE, reason))

    filings, unusable = split_valid(filings, tuple(model.filing_types))
    per_link = filings.groupBy(model.link).agg(F.count(F.lit(1)).alias("n"))
    repeated, n_filings = per_link.agg(F.count_if(F.col("n") > 1), F.count(F.lit(1))).first()
    if repeated:  # a repeated filing would fan out the gold join
        broken = Outcome(FAIL, violations=(Violation("uniqueness", model.link, repeated),))
        _refuse(lake, batch_id, broken, Contract(name=f"filings-{model.name}"))
    unusable = unusable.withColumn(BATCH_ID, F.lit(batch_id))

    def accept(counts: dict) -> None:
        outcome = outcome_of(counts, contract)
        if outcome.label != PASS:
            _refuse(lake, batch_id, outcome)

    for table in (lake.silver, lake.filing_index):  # alike, so that their joins move nothing
        table.size_for(seen["valid"])
    version = lake.silver.merge(
        valid,
        model.fact_key,
        newer(),
        compare=[INGEST_TS],
        source_unique=True,  # or the gate refuses it
        prune_by=model.link,
        prune_values=seen["links"],
        label=batch_id,
        watch=lambda nth: counters(contract, nth),
        accept=accept,
    )
    lake.quarantine_filings.append(unusable, label=batch_id)
    stamped = filings.withColumn(INGEST_TS, instant(ingest_ts))
    lake.filing_index.merge(
        stamped,
        [model.link],
        newer(),
        compare=[INGEST_TS],
        source_unique=True,
        prune_by=model.link,
        prune_values=n_filings,
        label=batch_id,
    )

    return RunMetrics(
        batch_id=batch_id,
        rows_in=seen["rows_in"],
        rows_out=seen["valid"],
        scoped_out=seen["scoped_out"],
        rejected=seen["rows_in"] - seen["scoped_out"] - seen["valid"],
        quarantined=lane.row_count() - before,
        gate=PASS,
        delta_version=version,
        wall_clock_ms=int((time.monotonic() - started) * 1000),
    )


def _refuse(
    lake: Lake, batch_id: str, outcome: Outcome, contract: Contract | None = None
) -> None:
    """Write the outcome to its lane, then stop the batch."""
    spark = lake.spark
    if outcome.label == FAIL:
        detail = outcome.detail(spark, contract or lake.model.contract)
        lake.quarantine_detail.append(detail, label=batch_id)
    else:
        row = one_row(spark, (batch_id, outcome.reason), UNEVALUABLE_SCHEMA)
        lake.quarantine_unevaluable.append(row, label=batch_id)
    raise QualityHalt(outcome)
