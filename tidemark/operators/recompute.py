"""Per-batch metrics re-derived from tables, and checks against what was logged."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import json_field
from tidemark.model import BATCH_ID, INGEST_TS, FactModel
from tidemark.operators.splits import all_filled, in_scope

METRIC_COLUMNS = (
    "rows_in",
    "scoped_out",
    "rows_to_silver",
    "q_rows",
    "q_detail",
    "q_uneval",
    "dedupe",
    "key_collisions",
)


def batch_counts(
    df: DataFrame, batch: str = BATCH_ID, conditions: Mapping[str, Column] | None = None
) -> DataFrame:
    """Rows per batch plus one conditional count per entry of ``conditions``."""
    extra = [F.count_if(p).alias(name) for name, p in (conditions or {}).items()]
    return df.groupBy(batch).agg(F.count(F.lit(1)).alias("n"), *extra)


def bronze_counts(bronze: DataFrame, model: FactModel) -> DataFrame:
    """``rows_in`` and ``scoped_out`` per batch, from raw text."""
    out = {"scoped_out": ~in_scope(model.scope)}
    return batch_counts(bronze, BATCH_ID, out).withColumnRenamed("n", "rows_in")


def key_collisions(bronze: DataFrame, model: FactModel) -> DataFrame:
    """Excess in-scope, filled rows per batch that share a fact key."""
    usable = bronze.filter(in_scope(model.scope) & all_filled(model.row_required))
    groups = usable.groupBy(BATCH_ID, *model.fact_key).agg(F.count(F.lit(1)).alias("_c"))
    return (
        groups.filter("_c > 1")
        .groupBy(BATCH_ID)
        .agg(F.sum(F.col("_c") - 1).alias("key_collisions"))
    )


def bronze_metrics(bronze: DataFrame, model: FactModel) -> DataFrame:
    """``rows_in``, ``scoped_out`` and ``key_collisions`` per batch from one scan.

    Rows are folded by batch and fact key, the other counters carried along,
    and the keys by batch; a batch's rows are never in one place.
    """
    usable = in_scope(model.scope) & all_filled(model.row_required)
    per_key = bronze.groupBy(BATCH_ID, *model.fact_key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(~in_scope(model.scope)).alias("_out"),
        F.count_if(usable).alias("_usable"),
    )
    return per_key.groupBy(BATCH_ID).agg(
        F.sum("_n").alias("rows_in"),
        F.sum("_out").alias("scoped_out"),
        F.sum(F.greatest(F.col("_usable") - 1, F.lit(0))).alias("key_collisions"),
    )


def run_slices(lane: DataFrame) -> DataFrame:
    """Rows per batch and run of an append lane; a rerun adds an equal slice."""
    return lane.groupBy(BATCH_ID, INGEST_TS).agg(F.count(F.lit(1)).alias("n"))


def first_slice(slices: DataFrame) -> DataFrame:
    """One batch's size (its first run), and whether later runs differ."""
    return slices.groupBy(BATCH_ID).agg(
        F.min_by("n", INGEST_TS).alias("q_rows"),
        F.count(F.lit(1)).alias("n_slices"),
        (F.min("n") != F.max("n")).alias("unequal_slices"),
    )


def registry_spine(registry: DataFrame) -> DataFrame:
    """``batch_id`` and the quarter its manifest names."""
    return registry.select(
        "batch_id", json_field(F.col("manifest_json"), "param.quarter").alias("quarter")
    )


def metrics_table(
    registry: DataFrame,
    bronze: DataFrame,
    quarantine_rows: DataFrame,
    unevaluable: DataFrame,
    silver_commits: DataFrame,
    model: FactModel,
    logs: DataFrame | None = None,
) -> DataFrame:
    """One row per registered quarter, every number counted from the tables.

    ``silver_commits`` are commit rows whose ``label`` is the batch id;
    batches without a row somewhere count as zero there.  ``logs`` holds the
    last run line of each quarter; it adds ``wall_clock_s``, which no table
    knows (zero without a line).
    """
    commits = (
        silver_commits.filter(F.col("operation").isin("WRITE", "MERGE"))
        .groupBy(F.col("label").alias("batch_id"))
        .agg(
            F.min_by("num_source", "version").alias("rows_to_silver"),
            F.min_by(
                F.col("num_source") - F.col("num_inserted") - F.col("num_updated"), "version"
            ).alias("dedupe"),
        )
    )
    uneval = unevaluable.groupBy("batch_id").agg(F.count(F.lit(1)).alias("q_uneval"))
    by_batch = {BATCH_ID: "batch_id"}
    spine = registry_spine(registry)
    for part in (
        bronze_metrics(bronze, model).withColumnsRenamed(by_batch),
        first_slice(run_slices(quarantine_rows)).withColumnsRenamed(by_batch),
        commits,
        uneval,
    ):
        spine = spine.join(part, "batch_id", "left")
    zero = F.lit(0).cast("bigint")
    counted = [
        (zero if c == "q_detail" else F.coalesce(F.col(c), zero)).alias(c) for c in METRIC_COLUMNS
    ]
    clock = []
    if logs is not None:
        spine = spine.join(logs.select("quarter", "wall_clock_ms"), "quarter", "left")
        seconds = F.round(F.coalesce("wall_clock_ms", zero) / 1000).cast("bigint")
        clock = [seconds.alias("wall_clock_s")]
    return spine.select(
        "quarter",
        "batch_id",
        *counted,
        F.coalesce("unequal_slices", F.lit(False)).alias("unequal_slices"),
        *clock,
    )


def with_totals(metrics: DataFrame, key: str = "quarter", columns: Sequence[str] = METRIC_COLUMNS) -> DataFrame:
    """The table with a ``total`` row, ready for a sorted report; no rows give no total.

    A rollup over whole rows, so the table is evaluated once.
    """
    row = F.struct(key, *[c for c in metrics.columns if c != key])
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in columns]
    rolled = metrics.withColumn("_row", row).rollup("_row").agg(F.grouping("_row").alias("_all"), *sums)
    label = F.when(F.col("_all") == 1, "total").otherwise(F.col(f"_row.{key}"))
    return rolled.select(label.alias(key), *columns)


def conservation_findings(metrics: DataFrame, statuses: DataFrame) -> DataFrame:
    """Quarters whose numbers do not add up, one row per finding.

    Ingested: rows in minus scoped out minus quarantined must reach silver,
    with no colliding keys.  Halted: nothing may have reached silver.  Any:
    reruns must quarantine the same rows.  ``statuses`` holds
    ``quarter, status`` with ``halted`` for refused quarters.
    """
    m = metrics.join(statuses.select("quarter", "status"), "quarter", "left")
    halted = F.coalesce(F.col("status") == "halted", F.lit(False))
    expected = F.col("rows_in") - F.col("scoped_out") - F.col("q_rows")
    tests = {
        "gate leaked": halted & (F.col("rows_to_silver") != 0),
        "conservation": ~halted & (expected != F.col("rows_to_silver")),
        "key collisions": ~halted & (F.col("key_collisions") != 0),
        "unequal run slices": F.col("unequal_slices"),
    }
    findings = F.array(*[F.when(p, F.lit(name)) for name, p in tests.items()])
    return m.select(
        "quarter",
        F.explode(F.filter(findings, lambda x: x.isNotNull())).alias("finding"),
        expected.alias("expected"),
        "rows_to_silver",
        "key_collisions",
    )


def logged_mismatches(metrics: DataFrame, logged: DataFrame) -> DataFrame:
    """Fields whose logged value differs from the recomputed one.

    ``logged`` holds ``quarter`` and the parsed run-line fields.
    """
    mine = metrics.select(
        "quarter",
        F.col("batch_id").alias("m_batch_id"),
        F.col("rows_in").alias("m_rows_in"),
        F.col("scoped_out").alias("m_scoped_out"),
        F.col("q_rows").alias("m_quarantined"),
    )
    both = mine.join(logged, "quarter")
    fields = ("batch_id", "rows_in", "scoped_out", "quarantined")
    rows = F.array(
        *[
            F.struct(
                F.lit(f).alias("field"),
                F.col(f"m_{f}").cast("string").alias("recomputed"),
                F.col(f).cast("string").alias("logged"),
            )
            for f in fields
        ]
    )
    return (
        both.select("quarter", F.inline(rows))
        .filter(~F.col("recomputed").eqNullSafe(F.col("logged")))
        .select("quarter", "field", "recomputed", "logged")
    )
