"""What must not pass: incomplete filings, unreadable batches and tables, unusable twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalogue.base import (
    FILED,
    ORDERS,
    SQL_ORDERS_GOLD,
    SQL_SILVER,
    query,
    raw_facts,
    raw_filings,
    sql_audit,
)
from tidemark.catalogue.intervals import orders_gold
from tidemark.functions.casting import cast_filings
from tidemark.model import BATCH_ID, INGEST_TS, instant
from tidemark.operators.audit import interval_report, orphan_empty_rows, run_audit
from tidemark.operators.quality import QualityHalt, judge
from tidemark.operators.splits import route
from tidemark.operators.twins import TwinRefused, dropped_column_twin, null_twin, require_twin_destination
from tidemark.plans.gold import rebuild_gold
from tidemark.plans.ingest import ingest_quarter
from tidemark.plans.lake import Lake
from tidemark.plans.silver import run_silver
from tidemark.session import scratch_folder

_NOW = "2024-01-01 00:00:00"


@query(
    """SELECT 'Unevaluable' AS outcome, 'missing source column(s): accepted' AS reason,
       CAST(1 AS BIGINT) AS lane_rows, FALSE AS silver_exists, count(*) AS bronze_filings,
       CAST(1 AS BIGINT) AS registered FROM orders"""
)
def filings_unevaluable(spark, sf):
    """Filings without an acceptance time: bronze and registry stay, nothing goes further."""
    lake, source = Lake(spark, scratch_folder(spark, "lake")), scratch_folder(spark, "source")
    for df, name in ((raw_facts(spark, sf), "num"), (raw_filings(spark, sf).drop("accepted"), "sub")):
        writer = df.write.option("header", True).option("sep", "\t")
        writer.csv(f"{source}/2001q4/{name}.txt")
    got = ingest_quarter(lake, source, "2001q4", "c0ffee", _NOW)
    try:
        run_silver(lake, got.facts, got.filings, got.batch_id, _NOW)
        outcome = "Pass"
    except QualityHalt as halt:
        outcome = halt.outcome.label
    lane = lake.quarantine_unevaluable.read().groupBy("reason").agg(F.count("*").alias("lane_rows"))
    return lane.select(
        F.lit(outcome).alias("outcome"),
        "reason",
        "lane_rows",
        F.lit(lake.silver.exists()).alias("silver_exists"),
        lake.bronze_filings.read().agg(F.count("*")).scalar().alias("bronze_filings"),
        lake.registry.read().agg(F.count("*")).scalar().alias("registered"),
    )


@query(
    f"""WITH {SQL_SILVER}, good AS (SELECT CAST(o_orderkey AS VARCHAR) AS adsh FROM orders
          WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH'))
        SELECT (SELECT count(*) FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))
            AS quarantined, (SELECT count(*) FROM good) AS indexed,
          (SELECT count(*) FROM silver) AS silver_rows,
          (SELECT count(*) FROM silver JOIN good USING (adsh)) AS gold_rows,
          CAST(0 AS BIGINT) AS unknown_instants"""
)
def filings_quarantined(spark, sf):
    """Filings whose time is blank or unreadable are set aside; gold goes without their facts."""
    lake = Lake(spark, scratch_folder(spark, "lake"))
    stamp = {INGEST_TS: instant(_NOW), BATCH_ID: F.lit("b1")}
    spoilt = F.when(F.col("form") == "1-URGENT", "").when(F.col("form") == "2-HIGH", "soon")
    raw = raw_filings(spark, sf).withColumn("accepted", F.coalesce(spoilt, "accepted"))
    run_silver(lake, raw_facts(spark, sf).withColumns(stamp), cast_filings(raw, FILED), "b1", _NOW)
    rebuild_gold(lake)
    counted = lambda t: t.read().agg(F.count("*")).scalar()
    unknown = F.col("valid_from").isNull() | F.col("accepted").isNull()
    return lake.quarantine_filings.read().agg(F.count("*").alias("quarantined")).select(
        "quarantined",
        counted(lake.filing_index).alias("indexed"),
        counted(lake.silver).alias("silver_rows"),
        counted(lake.gold).alias("gold_rows"),
        lake.gold.read().agg(F.count_if(unknown)).scalar().alias("unknown_instants"),
    )


@query(
    f"""WITH {SQL_SILVER} SELECT 'Unevaluable' AS outcome, TRUE AS names_the_error,
        count(*) AS rows_in FROM silver"""
)
def gate_fails_closed(spark, sf):
    """A batch whose evaluation breaks off is unevaluable, never passed."""
    stamp = {INGEST_TS: instant(_NOW), BATCH_ID: F.lit("b1")}
    routed = route(raw_facts(spark, sf).withColumns(stamp), FILED).filter("_lane = 'valid'")
    broken = F.when(F.col("qtrs") == 0, F.raise_error(F.lit("unreadable page")).cast("int"))
    outcome = judge(routed.withColumn("qtrs", F.coalesce(broken, "qtrs")), FILED.contract).outcome
    return routed.agg(F.count("*").alias("rows_in")).select(
        F.lit(outcome.label).alias("outcome"),
        F.lit("unreadable page" in outcome.reason).alias("names_the_error"),
        "rows_in",
    )


@query(
    """SELECT c AS "case", 'UNEVALUABLE' AS verdict, CAST(2 AS INTEGER) AS exit_code,
       CAST(1 AS BIGINT) AS n_checks, n_rows FROM (VALUES ('unopened'), ('no valid_to'), ('empty'),
       ('unreadable')) v(c), (SELECT count(*) AS n_rows FROM orders)"""
)
def audit_preconditions(spark, sf):
    """A table that cannot be audited gives one unevaluable row and no check results."""
    gold = orders_gold(spark, sf)
    bad = F.raise_error(F.lit("unreadable page")).cast("timestamp_ntz")
    cases = {
        "unopened": RuntimeError("no such table"),
        "no valid_to": gold.drop("valid_to"),
        "empty": gold.filter("1 = 0"),
        "unreadable": gold.withColumn("valid_to", F.coalesce(F.when(F.col("o_orderkey") > 0, bad), "valid_to")),
    }
    rows = []
    for name, frame in cases.items():
        found = run_audit(frame, ORDERS)
        rows.append((name, found.verdict, found.exit_code, len(found.results)))
    out = spark.createDataFrame(rows, "case string, verdict string, exit_code int, n_checks bigint")
    return out.withColumn("n_rows", gold.agg(F.count("*")).scalar())


@query(
    f"""WITH {SQL_ORDERS_GOLD}, audit AS ({sql_audit("o_custkey, o_orderpriority", "o_orderkey", "o_orderdate")})
        SELECT "check", 'PASS' AS verdict, violations, 'UNEVALUABLE' AS outcome,
          CAST(2 AS BIGINT) AS "exit" FROM audit WHERE violations = 0
        UNION ALL SELECT 'precondition', 'PASS', NULL, 'UNEVALUABLE', 2
        UNION ALL SELECT 'A6 registry-sane', 'UNEVALUABLE', NULL, 'UNEVALUABLE', 2"""
)
def audit_report_file(spark, sf):
    """The written report of an audit without a registry, read back."""
    path = scratch_folder(spark, "report")
    run_audit(orders_gold(spark, sf), ORDERS).write_json(spark, path)
    schema = "check string, verdict string, violations bigint, outcome string, exit bigint"
    return spark.read.schema(schema).json(path)


@query(
    """SELECT * FROM (SELECT 'destination' AS "case", '/lake/gold does not look like a twin copy (no ''twin'' in path)' AS why
       UNION ALL SELECT 'column', 'column ''nothing'' not found'
       UNION ALL SELECT 'dropped', 'column ''nothing'' not found'
       UNION ALL SELECT 'empty', 'zero data rows -- nothing to mutate'
       UNION ALL SELECT 'none', 'count 0 must be >= 1'
       UNION ALL SELECT 'many', 'count ' || (count(*) + 1) || ' exceeds ' || count(*) || ' available rows'
         FROM orders)"""
)
def twin_refusals(spark, sf):
    """Requests that would give no usable known-bad copy are refused with their reason."""
    filings = raw_filings(spark, sf)
    n = filings.count()
    asked = {
        "destination": lambda: require_twin_destination("/lake/gold"),
        "column": lambda: null_twin(filings, "nothing", 1, 7),
        "dropped": lambda: dropped_column_twin(filings, "nothing"),
        "empty": lambda: null_twin(filings.filter("1 = 0"), "cik", 1, 7),
        "none": lambda: null_twin(filings, "cik", 0, 7),
        "many": lambda: null_twin(filings, "cik", n + 1, 7),
    }
    rows = []
    for name, ask in asked.items():
        try:
            ask()
        except TwinRefused as refused:
            rows.append((name, str(refused)))
    return spark.createDataFrame(rows, "case string, why string")


_TIES = """bad AS (
  SELECT o_orderpriority AS k, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderkey END AS f,
    o_orderdate AS valid_from, o_orderdate + CASE WHEN o_totalprice > 200000 THEN INTERVAL 1 DAY
      ELSE INTERVAL 0 DAY END AS valid_to FROM orders)"""


@query(
    f"""WITH {_TIES}, orphan AS (
          SELECT * FROM bad e WHERE valid_to = valid_from AND NOT EXISTS (SELECT 1 FROM bad w
            WHERE w.k = e.k AND w.valid_from = e.valid_from AND w.valid_to > w.valid_from
              AND w.f <> e.f))
        SELECT (SELECT count(*) FROM orphan) AS violations,
          (SELECT count(*) FROM orphan) AS n_rows,
          (SELECT count(*) FROM orphan WHERE f IS NULL) AS without_filing"""
)
def audit_missing_filings(spark, sf):
    """A missing filing is never another filing: such empty rows are orphans, in count and in rows."""
    rows = spark.read.parquet(f"{sf}/orders.parquet")
    day = F.make_dt_interval(F.lit(1))
    start = F.col("o_orderdate")
    gold = rows.select(
        F.lit(1).cast("bigint").alias("o_custkey"),
        "o_orderpriority",
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderkey")).alias("o_orderkey"),
        start.alias("o_orderdate"),
        "o_totalprice",
        start.alias("valid_from"),
        F.when(F.col("o_totalprice") > 200000, start + day).otherwise(start).alias("valid_to"),
    )
    counted = interval_report(gold, ORDERS).filter("check = 'A2b empty-superseded'")
    listed = orphan_empty_rows(gold, ORDERS)
    return counted.select(
        "violations",
        listed.agg(F.count("*")).scalar().alias("n_rows"),
        listed.agg(F.count_if(F.col("o_orderkey").isNull())).scalar().alias("without_filing"),
    )
