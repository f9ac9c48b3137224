"""Registration, table access and the mappings of given tables onto fact models."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.casting import cast_facts
from tidemark.functions.hashing import canonical_json
from tidemark.functions.periods import quarter_of
from tidemark.model import BATCH_ID, FILED_FACTS, INGEST_TS, FactModel, instant
from tidemark.operators.splits import all_present, in_scope
from tidemark.session import scratch_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "1998-06-30 00:00:00"
#: Line items that a task joins with their orders at most: so many are sorted without a spill.
JOIN_ROWS = 250_000


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function name, with its SQL twin if it has one."""

    def keep(fn):
        key = name or fn.__name__
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return keep


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text(c: str | Column) -> Column:
    """Text form of a value; year-9999 instants do not fit pandas timestamps."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# -- orders as facts: restatements of a customer's newest order per priority --

ORDERS = FactModel(
    name="orders",
    fact_types={
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderpriority": "string",
        "o_orderdate": "timestamp_ntz",
        "o_totalprice": "double",
    },
    filing_types={},
    link="o_orderkey",
    fact_key=("o_orderkey",),
    natural_key=("o_custkey", "o_orderpriority"),
    known_at="o_orderdate",
    tiebreak=("o_orderkey",),
    value="o_totalprice",
)

EVENTS = FactModel(
    name="events",
    fact_types={
        "event_id": "bigint",
        "user_id": "bigint",
        "event_type": "string",
        "ts": "timestamp_ntz",
        "value": "double",
    },
    filing_types={},
    link="event_id",
    fact_key=("event_id",),
    natural_key=("user_id", "event_type"),
    known_at="ts",
    tiebreak=("event_id",),
    value="value",
)


def order_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(*ORDERS.fact_types)


def event_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(*EVENTS.fact_types)


# -- lineitem and orders as filed facts: one order is one filing --------------

FILED = FILED_FACTS


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """What facts take from a line item, as numbers: they are narrower to move than text."""
    line = table(spark, sf, "lineitem")
    return line.select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_returnflag",
        "l_linestatus",
        F.year("l_shipdate").alias("_year"),
        (F.col("l_tax") == 0.08).alias("_taxed"),
        F.when(F.col("l_discount") != 0, F.col("l_extendedprice")).alias("_price"),
    )


def _facts_of(lines: DataFrame, *also: str) -> DataFrame:
    return lines.select(
        text("l_orderkey").alias("adsh"),
        F.col("l_returnflag").alias("tag"),
        F.concat_ws(".", text("l_partkey"), text("l_suppkey"), text("l_linenumber")).alias(
            "version"
        ),
        text(F.col("_year") * 10000 + 1231).alias("ddate"),
        F.lit("0").alias("qtrs"),
        F.col("l_linestatus").alias("uom"),
        F.when(F.col("l_linenumber") >= 6, F.concat(F.lit("Line="), text("l_linenumber"))).alias(
            "segments"
        ),
        F.when(F.col("_taxed"), F.concat(F.lit("S"), text("l_suppkey"))).alias("coreg"),
        text(F.col("_price").cast("decimal(28,4)")).alias("value"),
        *also,
    )


def raw_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Line items in the shape of the fact source: nine text columns."""
    return _facts_of(_lines(spark, sf))


def filed_facts(spark: SparkSession, sf: str, filings: DataFrame, how: str = "inner") -> DataFrame:
    """Raw facts with the other columns of ``filings``, joined by ``adsh`` before they become text."""
    also = [c for c in filings.columns if c != "adsh"]
    placed = filings.select(F.col("adsh").cast("bigint").alias("l_orderkey"), *also)
    lines = _lines(spark, sf)
    tasks = -(-table(spark, sf, "lineitem").count() // JOIN_ROWS)  # counted from file footers
    if tasks > int(spark.conf.get("spark.sql.shuffle.partitions", "200")):
        lines, placed = lines.repartition(tasks, "l_orderkey"), placed.repartition(tasks, "l_orderkey")
    return _facts_of(lines.join(placed, "l_orderkey", how), *also)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows as written to a scratch table, so what reads them twice computes them once."""
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def raw_filings(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in the shape of the filing source, all text."""
    o = table(spark, sf, "orders")
    day = F.date_format(F.to_date("o_orderdate"), "yyyyMMdd")
    return o.select(
        text("o_orderkey").alias("adsh"),
        text("o_custkey").alias("cik"),
        F.concat(F.lit("Customer "), text("o_custkey")).alias("name"),
        F.col("o_orderpriority").alias("form"),
        day.alias("period"),
        text(F.year("o_orderdate")).alias("fy"),
        F.concat(F.lit("Q"), text(F.quarter("o_orderdate"))).alias("fp"),
        day.alias("filed"),
        text("o_orderdate").alias("accepted"),
    )


def filings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        text("o_orderkey").alias("adsh"),
        F.col("o_custkey").alias("cik"),
        F.col("o_orderdate").alias("accepted"),
    )


def silver(spark: SparkSession, sf: str) -> DataFrame:
    """In-scope, usable, typed facts."""
    typed = cast_facts(raw_facts(spark, sf).filter(in_scope(FILED.scope)), FILED)
    return typed.filter(all_present(FILED.row_required))


def batched_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Raw facts with the quarter of their filing as batch, loaded once."""
    when_filed = filings(spark, sf).select("adsh", quarter_of(F.col("accepted")).alias("_q"))
    return (
        filed_facts(spark, sf, when_filed)
        .withColumn(BATCH_ID, F.concat(F.lit("b-"), F.col("_q")))
        .withColumn(INGEST_TS, instant("2024-01-01 00:00:00"))
        .drop("_q")
    )


def quarter_registry(spark: SparkSession, sf: str) -> DataFrame:
    """One registered batch per quarter that has orders."""
    manifest = F.create_map(
        F.lit("param.quarter"),
        F.col("quarter"),
        F.lit("code_sha"),
        F.lit("c0ffee"),
        F.lit("source_sha256"),
        F.sha2("quarter", 256),
    )
    return (
        table(spark, sf, "orders")
        .groupBy(quarter_of(F.col("o_orderdate")).alias("quarter"))
        .agg(F.count("*").alias("delta_version"))
        .select(
            F.concat(F.lit("b-"), F.col("quarter")).alias("batch_id"),
            canonical_json(manifest).alias("manifest_json"),
            "delta_version",
        )
    )


# -- SQL of the same mappings -------------------------------------------------

SQL_RAW = """raw AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS adsh, l_returnflag AS tag,
         concat_ws('.', l_partkey, l_suppkey, l_linenumber) AS version,
         CAST(year(l_shipdate) * 10000 + 1231 AS VARCHAR) AS ddate, '0' AS qtrs,
         l_linestatus AS uom,
         CASE WHEN l_linenumber >= 6 THEN 'Line=' || l_linenumber END AS segments,
         CASE WHEN l_tax = 0.08 THEN 'S' || l_suppkey END AS coreg,
         CASE WHEN l_discount <> 0
              THEN CAST(CAST(l_extendedprice AS DECIMAL(28,4)) AS VARCHAR) END AS value
  FROM lineitem)"""

SQL_FILINGS = """filings AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS adsh, o_custkey AS cik, o_orderdate AS accepted
  FROM orders)"""

SQL_SILVER = (
    SQL_RAW
    + """, silver AS (
  SELECT adsh, tag, version, CAST(ddate AS INTEGER) AS ddate, CAST(qtrs AS INTEGER) AS qtrs,
         uom, CAST(value AS DECIMAL(28,4)) AS value
  FROM raw WHERE segments IS NULL AND coreg IS NULL AND value IS NOT NULL)"""
)

SQL_GOLD = (
    SQL_SILVER
    + ", "
    + SQL_FILINGS
    + """, gold AS (
  SELECT cik, tag, ddate, qtrs, uom, value, accepted, s.adsh, version,
         accepted AS valid_from,
         coalesce(lead(accepted) OVER (PARTITION BY cik, tag, ddate, qtrs, uom
                                       ORDER BY accepted, s.adsh, version),
                  TIMESTAMP '9999-12-31 00:00:00') AS valid_to
  FROM silver s JOIN filings f ON s.adsh = f.adsh)"""
)

SQL_ORDERS_GOLD = """gold AS (
  SELECT o_custkey, o_orderpriority, o_totalprice, o_orderdate, o_orderkey,
         o_orderdate AS valid_from,
         coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey, o_orderpriority
                                          ORDER BY o_orderdate, o_orderkey),
                  TIMESTAMP '9999-12-31 00:00:00') AS valid_to
  FROM orders)"""

SQL_QUARTER = "year({0}) || 'q' || quarter({0})"

SQL_BATCHED = (
    SQL_RAW
    + """, batched AS (
  SELECT raw.*, 'b-' || year(o_orderdate) || 'q' || quarter(o_orderdate) AS _batch_id
  FROM raw JOIN orders ON raw.adsh = CAST(o_orderkey AS VARCHAR))"""
)

SQL_REGISTRY = """registry AS (
  SELECT 'b-' || quarter AS batch_id,
         '{"code_sha":"c0ffee","param.quarter":"' || quarter || '","source_sha256":"'
           || sha256(quarter) || '"}' AS manifest_json,
         n AS delta_version
  FROM (SELECT year(o_orderdate) || 'q' || quarter(o_orderdate) AS quarter, count(*) AS n
        FROM orders GROUP BY 1))"""


def sql_audit(key: str, filing: str, known_at: str) -> str:
    """The six table checks over a ``gold`` CTE, each counted from its definition."""
    k = key.split(", ")
    on = " AND ".join(f"{x} IS NOT DISTINCT FROM {x}_" for x in k)
    keys_ = ", ".join(f"{x} AS {x}_" for x in k)
    full, never = "valid_to > valid_from", "TIMESTAMP '9999-01-01'"
    return f"""
  SELECT 'A1 no-lookahead' AS "check",
    CAST(sum(CASE WHEN {known_at} > valid_from THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM gold
  UNION ALL SELECT 'A2 interval-shape',
    CAST(sum(CASE WHEN valid_from > valid_to THEN 1 ELSE 0 END) AS BIGINT) FROM gold
  UNION ALL SELECT 'A2b empty-superseded', (
    SELECT count(*) FROM (SELECT * FROM gold WHERE valid_from = valid_to) LEFT JOIN (
        SELECT {keys_}, valid_from AS start_, min({filing}) AS low_, max({filing}) AS high_
        FROM gold WHERE {full} GROUP BY {key}, valid_from)
      ON {on} AND valid_from = start_
    WHERE low_ IS NULL OR (low_ = high_ AND low_ = {filing}))
  UNION ALL SELECT 'A3 no-overlap', (
    SELECT count(*) FROM (
      SELECT valid_from, lag(valid_to) OVER (PARTITION BY {key} ORDER BY valid_from, valid_to)
        AS reached FROM gold WHERE {full}) WHERE reached > valid_from)
  UNION ALL SELECT 'A4 one-open-interval', (
    SELECT count(*) FROM (SELECT DISTINCT {key} FROM gold) LEFT JOIN (
        SELECT {keys_}, count(*) AS open_ FROM gold WHERE valid_to >= {never} GROUP BY {key})
      ON {on}
    WHERE coalesce(open_, 0) <> 1)
  UNION ALL SELECT 'A5 no-dup-fact', (
    SELECT (SELECT count(*) FROM gold) - count(*)
    FROM (SELECT DISTINCT {key}, valid_from, {filing} FROM gold))"""


FILED_KEY = "cik, tag, ddate, qtrs, uom"
