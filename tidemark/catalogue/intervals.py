"""Interval, as-of and audit queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.catalogue.base import (
    AS_OF,
    EVENTS,
    FILED,
    FILED_KEY,
    ORDERS,
    SQL_FILINGS,
    SQL_GOLD,
    SQL_ORDERS_GOLD,
    SQL_REGISTRY,
    SQL_SILVER,
    event_rows,
    filings,
    order_rows,
    quarter_registry,
    query,
    silver,
    sql_audit,
    table,
    text,
)
from tidemark.model import FactModel
from tidemark.operators.audit import (
    interval_report,
    orphan_empty_rows,
    plan_audit_slices,
    registry_report,
)
from tidemark.operators.intervals import (
    as_of,
    as_of_disagreements,
    as_of_ranked,
    attach_filings,
    build_intervals,
    gold_profile,
    orphan_facts,
    plan_interval_slices,
    validity_intervals,
)
from tidemark.operators.probe import probe_all
from tidemark.operators.skew import plan_slices
from tidemark.operators.twins import lookahead_twin


def orders_gold(spark: SparkSession, sf: str) -> DataFrame:
    rows = order_rows(spark, sf)
    plan = plan_slices(rows, ORDERS.natural_key, ORDERS.order)
    return validity_intervals(rows, ORDERS, plan)


def filed_gold(spark: SparkSession, sf: str) -> DataFrame:
    facts, index = silver(spark, sf), filings(spark, sf)
    plan = plan_interval_slices(facts, index, FILED, at_most=_n_lines(spark, sf))
    return build_intervals(facts, index, FILED, plan)


def _n_lines(spark: SparkSession, sf: str) -> int:
    return table(spark, sf, "lineitem").count()  # from the file footer


#: The mapping of line items onto filed facts has one value here.
_ONE_VALUE = ("qtrs",)


def _audit(gold: DataFrame, model: FactModel, at_most: int) -> DataFrame:
    constant = _ONE_VALUE if model is FILED else ()
    return interval_report(gold, model, plan_audit_slices(gold, model, at_most=at_most), constant)


def _show_orders(df: DataFrame) -> DataFrame:
    return df.select(
        "o_custkey",
        "o_orderpriority",
        "o_orderkey",
        "o_totalprice",
        text("valid_from").alias("valid_from"),
        text("valid_to").alias("valid_to"),
    )


def _show_filed(df: DataFrame) -> DataFrame:
    return df.select(
        "cik",
        "tag",
        "ddate",
        "qtrs",
        "uom",
        F.col("value").cast("double").alias("value"),
        "adsh",
        "version",
        text("valid_from").alias("valid_from"),
        text("valid_to").alias("valid_to"),
    )


_ORDERS_OUT = """SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice,
  CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM """
_FILED_OUT = """SELECT cik, tag, ddate, qtrs, uom, CAST(value AS DOUBLE) AS value, adsh, version,
  CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM """


@query(f"WITH {SQL_ORDERS_GOLD} {_ORDERS_OUT} gold")
def intervals_orders(spark, sf):
    return _show_orders(orders_gold(spark, sf))


@query(f"WITH {SQL_GOLD} {_FILED_OUT} gold")
def intervals_filed(spark, sf):
    return _show_filed(filed_gold(spark, sf))


_BY_STATUS = FactModel(
    name="orders-by-status",
    fact_types={**ORDERS.fact_types, "o_orderstatus": "string"},
    filing_types={},
    link="o_orderkey",
    fact_key=("o_orderkey",),
    natural_key=("o_orderstatus",),
    known_at="o_orderdate",
    tiebreak=("o_orderkey",),
    value="o_totalprice",
)


@query(
    """SELECT o_orderstatus, o_orderkey, CAST(o_orderdate AS VARCHAR) AS valid_from,
       CAST(coalesce(lead(o_orderdate) OVER (PARTITION BY o_orderstatus
            ORDER BY o_orderdate, o_orderkey), TIMESTAMP '9999-12-31') AS VARCHAR) AS valid_to
       FROM orders"""
)
def intervals_hot_keys(spark, sf):
    """Three keys hold all rows: the sliced plan keeps every task small."""
    rows = table(spark, sf, "orders").select(*_BY_STATUS.fact_types)
    size = max(1, rows.count() // 48)
    plan = plan_slices(
        rows, _BY_STATUS.natural_key, _BY_STATUS.order, rows_per_slice=size, small_table=0
    )
    return validity_intervals(rows, _BY_STATUS, plan).select(
        "o_orderstatus",
        "o_orderkey",
        text("valid_from").alias("valid_from"),
        text("valid_to").alias("valid_to"),
    )


_ORDERS_AS_OF = f"""SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                               ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderdate <= TIMESTAMP '{AS_OF}') WHERE rn = 1"""


def _answer(df: DataFrame) -> DataFrame:
    return df.select("o_custkey", "o_orderpriority", "o_orderkey", "o_totalprice")


@query(_ORDERS_AS_OF)
def as_of_rank(spark, sf):
    return _answer(as_of_ranked(order_rows(spark, sf), AS_OF, ORDERS))


@query(_ORDERS_AS_OF)
def as_of_interval(spark, sf):
    return _answer(as_of(orders_gold(spark, sf), AS_OF))


@query("SELECT CAST(0 AS BIGINT) AS differing, count(*) AS n_orders FROM orders")
def as_of_diff(spark, sf):
    gold = orders_gold(spark, sf)
    differing = as_of_disagreements(gold, AS_OF, ORDERS).agg(F.count("*"))
    return gold.agg(F.count("*").alias("n_orders")).select(
        differing.scalar().alias("differing"), "n_orders"
    )


@query(
    f"""WITH {SQL_ORDERS_GOLD} SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice,
        CAST(valid_from AS VARCHAR) AS valid_from, '9999-12-31 00:00:00' AS valid_to
        FROM gold WHERE valid_from <= TIMESTAMP '{AS_OF}' AND valid_to > TIMESTAMP '{AS_OF}'"""
)
def as_of_masked(spark, sf):
    return _show_orders(as_of(orders_gold(spark, sf), AS_OF, mask_future=True))


@query(
    f"""WITH {SQL_ORDERS_GOLD} {_ORDERS_OUT} gold WHERE o_custkey = 7
        AND valid_from <= TIMESTAMP '{AS_OF}' AND valid_to > TIMESTAMP '{AS_OF}'"""
)
def as_of_point_filter(spark, sf):
    """The consumer read of one customer: key equality plus interval filter."""
    return _show_orders(as_of(orders_gold(spark, sf), AS_OF, o_custkey=7))


_EVENT_AT = "2024-01-15 12:00:00"


@query(
    f"""SELECT user_id, event_type, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                     ORDER BY ts DESC, event_id DESC) AS rn
        FROM events WHERE ts <= TIMESTAMP '{_EVENT_AT}') WHERE rn = 1"""
)
def as_of_events(spark, sf):
    rows = event_rows(spark, sf)
    plan = plan_slices(rows, EVENTS.natural_key, EVENTS.order)
    gold = validity_intervals(rows, EVENTS, plan)
    return as_of(gold, _EVENT_AT).select("user_id", "event_type", "event_id", "value")


@query(
    f"""WITH {SQL_GOLD} {_FILED_OUT} gold
        WHERE valid_from <= TIMESTAMP '{AS_OF}' AND valid_to > TIMESTAMP '{AS_OF}'"""
)
def as_of_filed(spark, sf):
    return _show_filed(as_of(filed_gold(spark, sf), AS_OF))


# Arrival runs against order date, as when old filings are loaded last.
_ARRIVAL = "TIMESTAMP '2002-01-01' + (TIMESTAMP '2002-01-01' - o_orderdate)"


@query(
    f"""WITH late AS (SELECT *, {_ARRIVAL} AS _ingest_ts FROM orders
                     WHERE o_orderdate <= TIMESTAMP '{AS_OF}'),
    wrong AS (SELECT o_custkey, o_orderpriority, o_orderkey FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
                                   ORDER BY _ingest_ts DESC, o_orderkey DESC) AS rn FROM late)
      WHERE rn = 1),
    truth AS ({_ORDERS_AS_OF})
    SELECT w.o_custkey, w.o_orderpriority, w.o_orderkey AS arrival_answer,
           t.o_orderkey AS right_answer, w.o_orderkey <> t.o_orderkey AS stale
    FROM wrong w JOIN truth t USING (o_custkey, o_orderpriority)"""
)
def as_of_arrival_control(spark, sf):
    """Negative control: ordering by arrival must give stale answers."""
    epoch = F.lit("2002-01-01 00:00:00").cast("timestamp_ntz")
    rows = order_rows(spark, sf).withColumn(
        "_ingest_ts", epoch + (epoch - F.col("o_orderdate"))
    )
    wrong = as_of_ranked(rows, AS_OF, ORDERS, order=("_ingest_ts", "o_orderkey")).select(
        *ORDERS.natural_key, F.col("o_orderkey").alias("arrival_answer")
    )
    right = as_of_ranked(rows, AS_OF, ORDERS).select(
        *ORDERS.natural_key, F.col("o_orderkey").alias("right_answer")
    )
    return wrong.join(right, list(ORDERS.natural_key)).withColumn(
        "stale", F.col("arrival_answer") != F.col("right_answer")
    )


@query(
    f"""WITH {SQL_SILVER}, {SQL_FILINGS}
        SELECT s.adsh, s.tag, s.version, CAST(s.value AS DOUBLE) AS value FROM silver s
        WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE CAST(o.o_orderkey AS VARCHAR) = s.adsh
                          AND o.o_orderstatus <> 'P')"""
)
def orphan_filed_facts(spark, sf):
    """Facts left without a filing when pending orders are not in the index."""
    index = (
        table(spark, sf, "orders")
        .filter("o_orderstatus <> 'P'")
        .select(text("o_orderkey").alias("adsh"))
    )
    return orphan_facts(silver(spark, sf), index, FILED).select(
        "adsh", "tag", "version", F.col("value").cast("double").alias("value")
    )


@query(
    f"""WITH {SQL_GOLD} SELECT count(*) AS n_rows, count(DISTINCT cik) AS n_entities,
        CAST(min(accepted) AS VARCHAR) AS first_known, CAST(max(accepted) AS VARCHAR) AS last_known
        FROM gold"""
)
def gold_summary(spark, sf):
    gold = attach_filings(silver(spark, sf), filings(spark, sf), FILED)
    return gold_profile(gold, FILED, "cik").select(
        "n_rows",
        "n_entities",
        text("first_known").alias("first_known"),
        text("last_known").alias("last_known"),
    )


# -- audits -------------------------------------------------------------------

_VERDICT = """SELECT "check", CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict,
  violations FROM audit"""
_ORDERS_AUDIT = sql_audit("o_custkey, o_orderpriority", "o_orderkey", "o_orderdate")
_FILED_AUDIT = sql_audit(FILED_KEY, "adsh", "accepted")


@query(f"WITH {SQL_ORDERS_GOLD}, audit AS ({_ORDERS_AUDIT}) {_VERDICT}")
def audit_orders(spark, sf):
    """A right table: every check passes."""
    return _audit(orders_gold(spark, sf), ORDERS, order_rows(spark, sf).count())


@query(f"WITH {SQL_GOLD}, audit AS ({_FILED_AUDIT}) {_VERDICT}")
def audit_filed(spark, sf):
    """Several versions of one fact per filing trip A2b and A5, and nothing else."""
    return _audit(filed_gold(spark, sf), FILED, _n_lines(spark, sf))


@query(
    f"""WITH {SQL_ORDERS_GOLD}, bad AS (
      SELECT * REPLACE (CASE WHEN o_orderpriority = '1-URGENT' THEN valid_to + INTERVAL 400 DAY
                             ELSE valid_to END AS valid_to)
      FROM gold WHERE valid_to < TIMESTAMP '9999-01-01' OR o_orderpriority <> '5-LOW'),
    audit AS ({_ORDERS_AUDIT.replace("gold", "bad")}) {_VERDICT}"""
)
def audit_overlaps(spark, sf):
    """Stretched intervals overlap, and keys robbed of their open row lack one."""
    gold = orders_gold(spark, sf)
    longer = F.col("valid_to") + F.make_dt_interval(F.lit(400))
    is_open = F.col("valid_to") >= F.lit("9999-01-01 00:00:00").cast("timestamp_ntz")
    bad = gold.filter(~is_open | (F.col("o_orderpriority") != "5-LOW")).withColumn(
        "valid_to",
        F.when(F.col("o_orderpriority") == "1-URGENT", longer).otherwise(F.col("valid_to")),
    )
    return _audit(bad, ORDERS, order_rows(spark, sf).count())


@query(
    f"""WITH gold AS (SELECT o_orderstatus, o_orderkey, o_orderdate, o_orderdate AS valid_from,
          coalesce(lead(o_orderdate) OVER (PARTITION BY o_orderstatus
                   ORDER BY o_orderdate, o_orderkey), TIMESTAMP '9999-12-31')
            + CASE WHEN o_totalprice > 400000 THEN INTERVAL 3 DAY ELSE INTERVAL 0 DAY END
            AS valid_to FROM orders),
    audit AS ({sql_audit("o_orderstatus", "o_orderkey", "o_orderdate")}) {_VERDICT}"""
)
def audit_hot_keys(spark, sf):
    """The audit of three keys that hold all rows, run slice by slice."""
    rows = table(spark, sf, "orders").select(*_BY_STATUS.fact_types)
    size = max(1, rows.count() // 48)
    plan = plan_slices(
        rows, _BY_STATUS.natural_key, _BY_STATUS.order, rows_per_slice=size, small_table=0
    )
    gold = validity_intervals(rows, _BY_STATUS, plan)
    longer = F.col("valid_to") + F.make_dt_interval(F.lit(3))
    bad = gold.withColumn(
        "valid_to", F.when(F.col("o_totalprice") > 400000, longer).otherwise(F.col("valid_to"))
    )
    slices = plan_audit_slices(
        bad, _BY_STATUS, at_most=48 * size, rows_per_slice=size, small_table=0
    )
    return interval_report(bad, _BY_STATUS, slices)


@query(
    f"""WITH {SQL_GOLD}, winners AS (
          SELECT {FILED_KEY}, valid_from, list_distinct(list(adsh)) AS filings
          FROM gold WHERE valid_to > valid_from GROUP BY {FILED_KEY}, valid_from)
        SELECT cik, tag, ddate, uom, adsh, version
        FROM gold LEFT JOIN winners USING ({FILED_KEY}, valid_from)
        WHERE valid_to = valid_from AND coalesce(
          len(filings) - CAST(list_contains(filings, adsh) AS INT), 0) = 0"""
)
def audit_orphan_empty_rows(spark, sf):
    return orphan_empty_rows(filed_gold(spark, sf), FILED).select(
        "cik", "tag", "ddate", "uom", "adsh", "version"
    )


@query(
    f"""WITH {SQL_REGISTRY},
        entry AS (SELECT batch_id AS id, CAST(CAST(manifest_json AS JSON) AS MAP(VARCHAR, VARCHAR)) AS m
          FROM registry),
        ids AS (SELECT id, count(*) AS n FROM entry GROUP BY id),
        quarters AS (SELECT m['param.quarter'] AS q, count(*) AS n FROM entry GROUP BY q),
        shared AS (SELECT id AS x FROM ids WHERE n > 1
          UNION ALL SELECT q FROM quarters WHERE n > 1 OR q IS NULL)
        SELECT 'A6 registry-sane' AS "check",
          CASE WHEN EXISTS (FROM shared) OR NOT EXISTS (FROM entry) THEN 'FAIL' ELSE 'PASS' END AS verdict,
          (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM ids) AS batches,
          (SELECT count(*) FROM ids) AS distinct_ids,
          (SELECT count(*) FROM quarters WHERE q IS NOT NULL) AS distinct_quarters"""
)
def audit_registry(spark, sf):
    """The registry's own check: no id and no quarter stands for two batches."""
    return registry_report(quarter_registry(spark, sf))


_TWIN = """twin AS (SELECT * REPLACE (
    CASE WHEN tag = 'R' THEN accepted + INTERVAL 1825 DAY ELSE accepted END AS accepted)
  FROM gold)"""


@query(
    f"""WITH {SQL_GOLD}, {_TWIN}, audit AS ({_FILED_AUDIT.replace("gold", "twin")})
        SELECT "check", violations, (SELECT count(*) FROM gold WHERE tag = 'R') AS planted
        FROM audit"""
)
def twin_lookahead_audit(spark, sf):
    """Rows of one tag known five years later: A1 must equal the planted count."""
    gold = filed_gold(spark, sf)
    planted_rows = F.col("tag") == "R"
    twin = lookahead_twin(gold, FILED, planted_rows, years=5)
    report = _audit(twin, FILED, _n_lines(spark, sf))
    planted = gold.filter(planted_rows).agg(F.count("*"))
    return report.select("check", "violations", planted.scalar().alias("planted"))


@query(
    f"""WITH truth AS ({_ORDERS_AS_OF})
        SELECT o_custkey, o_orderpriority, o_totalprice AS expect,
               CAST(1 AS BIGINT) AS n_found, TRUE AS passed FROM truth"""
)
def consumer_probe(spark, sf):
    """Every key's answer through the interval path equals the ranked answer."""
    expected = as_of_ranked(order_rows(spark, sf), AS_OF, ORDERS).select(
        *ORDERS.natural_key, F.col("o_totalprice").alias("expect")
    )
    return probe_all(orders_gold(spark, sf), expected, ORDERS, AS_OF)
