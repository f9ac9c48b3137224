"""Routing, casting, gate and row-check queries."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.catalogue.base import (
    FILED,
    SQL_RAW,
    SQL_SILVER,
    query,
    raw_facts,
    raw_filings,
    silver,
    table,
    text,
)
from tidemark.functions.casting import cast_declared, cast_facts, cast_filings
from tidemark.model import Contract
from tidemark.operators.quality import (
    duplicate_group_count,
    duplicate_groups,
    excess_row_count,
    gate,
    violation_frame,
)
from tidemark.operators.rowchecks import (
    RowCheck,
    check_table,
    overall_verdict,
    run_row_checks,
    split_by_check,
    worst,
)
from tidemark.operators.splits import (
    LANE,
    all_filled,
    all_present,
    lane_counters,
    route,
    split_scope,
    split_valid,
)
from tidemark.operators.twins import null_twin

_SCOPED = "segments IS NULL AND coreg IS NULL"


@query(
    f"""WITH {SQL_RAW} SELECT adsh, tag, version,
        CASE WHEN {_SCOPED} THEN 'in' ELSE 'out' END AS side FROM raw"""
)
def scope_split(spark, sf):
    inside, outside = split_scope(raw_facts(spark, sf), FILED.scope)
    tagged = inside.withColumn("side", F.lit("in")).unionByName(
        outside.withColumn("side", F.lit("out"))
    )
    return tagged.select("adsh", "tag", "version", "side")


@query(
    f"""WITH {SQL_RAW} SELECT count(*) AS rows_in,
        count(*) FILTER (WHERE NOT ({_SCOPED})) AS scoped_out,
        count(*) FILTER (WHERE {_SCOPED} AND value IS NULL) AS quarantined,
        count(*) FILTER (WHERE {_SCOPED} AND value IS NOT NULL) AS valid FROM raw"""
)
def scope_counts(spark, sf):
    return route(raw_facts(spark, sf), FILED).agg(*lane_counters())


@query(
    f"""WITH {SQL_SILVER} SELECT adsh, tag, version, ddate, qtrs, uom,
        CAST(value AS DOUBLE) AS value FROM silver"""
)
def silver_rows(spark, sf):
    return silver(spark, sf).withColumn("value", F.col("value").cast("double"))


_WORDS = "CASE WHEN lang = 'en' THEN n_chars || '.55555' ELSE lang || n_chars END"


@query(
    f"""SELECT doc_id, TRY_CAST(lang AS INTEGER) AS lang_int,
        TRY_CAST({_WORDS} AS DECIMAL(28,4))::VARCHAR AS mixed_dec,
        CASE WHEN lang = 'en' THEN n_chars END AS mixed_int,
        TRY_CAST(n_chars || repeat('0', 30) AS DECIMAL(28,4))::VARCHAR AS too_big,
        CAST(NULL AS DOUBLE) AS absent FROM documents"""
)
def typed_cast(spark, sf):
    """Text that casts, text that does not, overflow, and a column not there."""
    docs = table(spark, sf, "documents")
    number = F.concat(text("n_chars"), F.lit(".55555"))
    mixed = F.when(F.col("lang") == "en", number).otherwise(F.concat("lang", text("n_chars")))
    raw = docs.select(
        "doc_id",
        F.col("lang").alias("lang_int"),
        mixed.alias("mixed_dec"),
        mixed.alias("mixed_int"),
        F.concat(text("n_chars"), F.repeat(F.lit("0"), F.lit(30))).alias("too_big"),
    )
    types = {
        "doc_id": "bigint",
        "lang_int": "int",
        "mixed_dec": "decimal(28,4)",
        "mixed_int": "bigint",
        "too_big": "decimal(28,4)",
        "absent": "double",
    }
    cast = cast_declared(raw, types)
    return cast.withColumns({c: text(c) for c in ("mixed_dec", "too_big")})


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS adsh, o_custkey AS cik,
       CAST(o_orderdate AS VARCHAR) AS accepted FROM orders"""
)
def typed_filing(spark, sf):
    return cast_filings(raw_filings(spark, sf), FILED).withColumn("accepted", text("accepted"))


@query(
    f"""WITH {SQL_RAW} SELECT adsh, tag, version, CAST(ddate AS INTEGER) AS ddate,
        CAST(qtrs AS INTEGER) AS qtrs, uom, CAST(NULL AS DOUBLE) AS value FROM raw"""
)
def missing_column_cast(spark, sf):
    no_value = raw_facts(spark, sf).drop("value")
    return cast_facts(no_value, FILED).withColumn("value", F.col("value").cast("double"))


@query(
    f"""WITH {SQL_RAW} SELECT adsh, version, CASE WHEN value IS NULL THEN 'quarantine'
        ELSE 'valid' END AS lane FROM raw WHERE {_SCOPED}"""
)
def valid_quarantine_split(spark, sf):
    entity, _ = split_scope(raw_facts(spark, sf), FILED.scope)
    valid, rest = split_valid(cast_facts(entity, FILED), FILED.row_required)
    tagged = valid.withColumn("lane", F.lit("valid")).unionByName(
        rest.withColumn("lane", F.lit("quarantine"))
    )
    return tagged.select("adsh", "version", "lane")


_BAD_VALUE = "CASE WHEN uom = 'F' AND tag = 'A' THEN 'n/a' ELSE value END"


@query(
    f"""WITH {SQL_RAW}, dirty AS (SELECT * REPLACE ({_BAD_VALUE} AS value) FROM raw)
        SELECT count(*) AS n_rows,
          count(*) FILTER (WHERE value IS NOT NULL AND value <> '') AS filled,
          count(*) FILTER (WHERE TRY_CAST(value AS DECIMAL(28,4)) IS NOT NULL) AS usable
        FROM dirty"""
)
def raw_versus_typed_filter(spark, sf):
    """Filled text that does not cast: raw and typed predicates differ by it."""
    bad = (F.col("uom") == "F") & (F.col("tag") == "A")
    dirty = raw_facts(spark, sf).withColumn(
        "value", F.when(bad, F.lit("n/a")).otherwise(F.col("value"))
    )
    filled = all_filled(FILED.row_required).cast("int").alias("_filled")
    both = dirty.withColumn("_filled", filled)
    typed = cast_declared(both, {**FILED.fact_types, "_filled": "int"})
    return typed.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("_filled") == 1).alias("filled"),
        F.count_if(all_present(FILED.row_required)).alias("usable"),
    )


# -- gate ---------------------------------------------------------------------

_LINE_CONTRACT = Contract(
    name="lineitem",
    complete=("l_discount", "l_shipdate"),
    unique=("l_orderkey", "l_partkey"),
    non_negative=("l_linenumber", "signed_price"),
)
_LINE_COLUMNS = ("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_discount")


def _line_batch(spark, sf):
    """Line items with zero discounts blanked and returns signed negative."""
    line = table(spark, sf, "lineitem")
    signed = F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice"))
    return line.withColumn(
        "signed_price", signed.otherwise(F.col("l_extendedprice"))
    ).withColumn("l_discount", F.when(F.col("l_discount") != 0, F.col("l_discount")))


_LINE_DETAIL = """
  SELECT 'lineitem' AS "check", 'completeness' AS "constraint", 'l_discount' AS target,
         count(*) AS violations FROM lineitem WHERE l_discount = 0
  UNION ALL SELECT 'lineitem', 'completeness', 'l_shipdate', count(*)
    FROM lineitem WHERE l_shipdate IS NULL
  UNION ALL SELECT 'lineitem', 'uniqueness', 'l_orderkey,l_partkey', count(*) FROM (
    SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1)
  UNION ALL SELECT 'lineitem', 'non-negative', 'l_linenumber', count(*)
    FROM lineitem WHERE l_linenumber < 0
  UNION ALL SELECT 'lineitem', 'non-negative', 'signed_price', count(*)
    FROM lineitem WHERE l_returnflag = 'R' AND l_extendedprice > 0"""


@query(f"""SELECT * FROM ({_LINE_DETAIL}) WHERE violations > 0""")
def dq_detail(spark, sf):
    return violation_frame(_line_batch(spark, sf), _LINE_CONTRACT)


@query(
    f"""WITH {SQL_SILVER}, twice AS (SELECT 1 FROM silver
          GROUP BY adsh, tag, version, ddate, qtrs, uom HAVING count(*) > 1)
        SELECT 'silver' AS batch, CASE WHEN (SELECT count(*) FROM twice) = 0
          THEN 'Pass' ELSE 'Fail' END AS outcome, count(*) AS n_rows FROM silver
        UNION ALL SELECT 'no version', 'Fail', count(*) FROM silver
        UNION ALL SELECT 'text value', 'Unevaluable', count(*) FROM silver
        UNION ALL SELECT 'empty', 'Unevaluable', count(*) FROM silver"""
)
def gate_outcomes(spark, sf):
    """The gate on real silver rows and on three damaged forms of them."""
    good = silver(spark, sf)
    batches = {
        "silver": good,
        "no version": good.withColumn("version", F.lit("v1")),
        "text value": good.withColumn("value", text("value")),
        "empty": good.filter("value IS NULL"),
    }
    labels = [(name, gate(df, FILED.contract).label) for name, df in batches.items()]
    n_rows = good.agg(F.count("*")).scalar()
    return spark.createDataFrame(labels, "batch string, outcome string").withColumn(
        "n_rows", n_rows
    )


@query(
    """SELECT (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber
                                     HAVING count(*) > 1)) AS duplicate_groups,
       (SELECT CAST(sum(c - 1) AS BIGINT) FROM (SELECT count(*) AS c FROM lineitem
          GROUP BY l_orderkey, l_linenumber)) AS excess_rows"""
)
def dq_uniqueness(spark, sf):
    """Duplicate groups and excess rows are two different numbers."""
    line = table(spark, sf, "lineitem")
    key = ("l_orderkey", "l_linenumber")
    groups = duplicate_group_count(line, key).withColumnRenamed("violations", "duplicate_groups")
    return groups.select(
        "duplicate_groups", excess_row_count(line, key).scalar().alias("excess_rows")
    )


@query(
    """SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem
       GROUP BY l_orderkey, l_partkey HAVING count(*) > 1"""
)
def dq_duplicate_keys(spark, sf):
    return duplicate_groups(table(spark, sf, "lineitem"), ("l_orderkey", "l_partkey"))


@query(
    f"""SELECT * FROM ({_LINE_DETAIL}) WHERE violations > 0
        ORDER BY "constraint", target LIMIT 2"""
)
def dq_fail_head(spark, sf):
    """The first details an error message would carry."""
    return dq_detail(spark, sf).orderBy("constraint", "target").limit(2)


@query(
    f"""WITH {SQL_RAW}, lanes AS (SELECT tag, CASE WHEN NOT ({_SCOPED}) THEN 'scoped_out'
          WHEN value IS NULL THEN 'quarantined' ELSE 'valid' END AS lane FROM raw)
        SELECT lane, tag, count(*) AS n FROM lanes GROUP BY lane, tag"""
)
def dq_lanes(spark, sf):
    return (
        route(raw_facts(spark, sf), FILED)
        .groupBy(F.col(LANE).alias("lane"), "tag")
        .agg(F.count("*").alias("n"))
    )


# -- row checks ---------------------------------------------------------------

_CHECKS = (
    RowCheck("order_price_positive_filled", "orders", "priced"),
    RowCheck("order_status_filled", "orders", "o_orderstatus", "is_not_null_and_not_empty"),
    RowCheck("order_note_filled", "orders", "note", "is_not_null_and_not_empty", "warn"),
    RowCheck("order_clerk_filled", "orders", "o_clerk"),
)


def _checked_orders(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.withColumn(
        "priced", F.when(F.col("o_totalprice") >= 5000, F.col("o_totalprice"))
    ).withColumn("note", F.when(F.col("o_orderstatus") == "P", "").otherwise("ok"))


_CHECK_ROWS = """
  SELECT 'order_price_positive_filled' AS name, 'priced' AS "column",
    'is_not_null' AS check_func, 'fail' AS on_bad,
    count(*) FILTER (WHERE o_totalprice < 5000) AS bad, count(*) AS total FROM orders
  UNION ALL SELECT 'order_status_filled', 'o_orderstatus', 'is_not_null_and_not_empty', 'fail',
    count(*) FILTER (WHERE o_orderstatus IS NULL OR o_orderstatus = ''), count(*) FROM orders
  UNION ALL SELECT 'order_note_filled', 'note', 'is_not_null_and_not_empty', 'warn',
    count(*) FILTER (WHERE o_orderstatus = 'P'), count(*) FROM orders"""


@query(
    f"""SELECT name, 'orders' AS "table", "column", check_func,
        CASE WHEN bad > 0 THEN on_bad ELSE 'pass' END AS outcome,
        total, total - bad AS good, bad, bad || ' bad rows out of ' || total AS detail
        FROM ({_CHECK_ROWS})"""
)
def row_checks_criticality(spark, sf):
    return check_table(_checked_orders(spark, sf), "orders", _CHECKS[:3])


@query(
    f"""SELECT name, CASE WHEN bad > 0 THEN on_bad ELSE 'pass' END AS outcome, bad
        FROM ({_CHECK_ROWS})
        UNION ALL SELECT 'order_clerk_filled', 'unevaluable', NULL"""
)
def row_checks_skip(spark, sf):
    """A check on an absent column is unevaluable, not passed and not failed."""
    results = check_table(_checked_orders(spark, sf), "orders", _CHECKS)
    return results.select("name", "outcome", "bad")


@query(
    f"""SELECT CASE WHEN sum(CASE WHEN bad > 0 AND on_bad = 'fail' THEN 1 ELSE 0 END) > 0
               THEN 'fail' WHEN sum(bad) > 0 THEN 'warn' ELSE 'pass' END AS verdict,
        CASE WHEN sum(CASE WHEN bad > 0 AND on_bad = 'fail' THEN 1 ELSE 0 END) > 0
             THEN 1 ELSE 0 END AS exit_code FROM ({_CHECK_ROWS})"""
)
def verdict_lattice(spark, sf):
    return overall_verdict(check_table(_checked_orders(spark, sf), "orders", _CHECKS[:3]))


@query("""SELECT o_orderkey, CASE WHEN o_totalprice < 5000 THEN 'bad' ELSE 'good' END AS side
          FROM orders""")
def row_check_split(spark, sf):
    good, bad = split_by_check(_checked_orders(spark, sf), _CHECKS[0])
    both = good.withColumn("side", F.lit("good")).unionByName(bad.withColumn("side", F.lit("bad")))
    return both.select("o_orderkey", "side")


_PLANTED = 25
_CUSTOMER_CHECKS = (
    RowCheck("customer_name_filled", "customer", "c_name"),
    RowCheck("customer_segment_filled", "customer", "c_mktsegment", "is_not_null_and_not_empty"),
)


@query(
    f"""WITH n AS (SELECT count(*) AS total, count(c_name) - {_PLANTED} AS names,
          count(*) FILTER (WHERE c_mktsegment <> '') AS segments FROM customer)
        SELECT 'customer_name_filled' AS name, CASE WHEN names < total THEN 'fail' ELSE 'pass' END AS outcome,
          total, names AS good, total - names AS bad FROM n
        UNION ALL SELECT 'customer_segment_filled', CASE WHEN segments < total THEN 'fail' ELSE 'pass' END,
          total, segments, total - segments FROM n"""
)
def twin_null_count(spark, sf):
    """Seeded rows lose a value: the matching check must report them, and no other check."""
    twin = null_twin(table(spark, sf, "customer"), "c_name", _PLANTED, seed=11, key=["c_custkey"])
    return check_table(twin, "customer", _CUSTOMER_CHECKS).select("name", "outcome", "total", "good", "bad")


@query(
    f"""WITH {SQL_RAW}, n AS (SELECT (SELECT count(*) FROM raw) AS num, (SELECT count(*) FROM orders) AS sub)
        SELECT kind, outcome, detail, CASE outcome WHEN 'pass' THEN 1 ELSE 2 END AS exit_code FROM n, (
          SELECT 'whole' AS kind, 'pass' AS outcome,
            'sub readable (' || sub || ' rows), num readable (' || num || ' rows)' AS detail FROM n
          UNION ALL VALUES ('absent', 'unevaluable', 'missing data: [''num'']'),
            ('unreadable', 'unevaluable', 'num unreadable'),
            ('narrow', 'unevaluable', 'sub missing columns: [''form'']'))
        UNION ALL SELECT 'empty', 'unevaluable', 'num has zero rows -- nothing to gate', 2 FROM n
          WHERE num > 0"""
)
def bronze_gate_preconditions(spark, sf):
    """The raw-file gate on sources that are whole, absent, unreadable, too narrow or empty.

    The whole ones pass the precondition and fail a check: their filings of low
    priority lost the form.
    """
    form = F.when(F.col("form") != "5-LOW", F.col("form")).otherwise(F.lit(""))
    sub, num = raw_filings(spark, sf).withColumn("form", form), raw_facts(spark, sf)
    try:
        gone = spark.read.parquet(f"{sf}/no-such-table.parquet")
    except AnalysisException as e:
        gone = e
    cases = {
        "whole": {"sub": sub, "num": num},
        "absent": {"sub": sub},
        "unreadable": {"sub": sub, "num": gone},
        "narrow": {"sub": sub.drop("form"), "num": num},
        "empty": {"sub": sub, "num": num.filter("adsh is null")},
    }
    rows = []
    for kind, sources in cases.items():
        results = run_row_checks(sources)
        detail = results[0]["detail"]
        detail = detail.split(":")[0] if kind == "unreadable" else detail
        code = worst([r["outcome"] for r in results])[1]
        rows.append((kind, results[0]["outcome"], detail, code))
    return spark.createDataFrame(rows, "kind string, outcome string, detail string, exit_code int")


@query(
    f"""WITH {SQL_RAW} SELECT 'precondition' AS name, 'pass' AS outcome, NULL::BIGINT AS bad,
          NULL::BIGINT AS total
        UNION ALL SELECT 'sub_cik_not_null', 'pass', count(*) FILTER (WHERE o_custkey IS NULL),
          count(*) FROM orders
        UNION ALL SELECT 'sub_adsh_not_null', 'pass', 0, count(*) FROM orders
        UNION ALL SELECT 'sub_form_not_null_not_empty', 'fail',
          count(*) FILTER (WHERE o_orderpriority = '5-LOW'), count(*) FROM orders
        UNION ALL SELECT 'num_value_not_null', 'warn', count(*) FILTER (WHERE value IS NULL),
          count(*) FROM raw
        UNION ALL SELECT 'num_tag_not_null', 'pass', 0, count(*) FROM raw"""
)
def bronze_row_gate(spark, sf):
    """The raw-file gate over both sources; low-priority filings lost their form."""
    form = F.when(F.col("form") != "5-LOW", F.col("form")).otherwise(F.lit(""))
    sources = {"sub": raw_filings(spark, sf).withColumn("form", form), "num": raw_facts(spark, sf)}
    results = [
        tuple(r[c] for c in ("name", "outcome", "bad", "total")) for r in run_row_checks(sources)
    ]
    return spark.createDataFrame(results, "name string, outcome string, bad bigint, total bigint")
