"""Hash, identity, source and log queries."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tidemark.catalogue.base import (
    SQL_REGISTRY,
    quarter_registry,
    query,
    raw_filings,
    table,
    text,
)
from tidemark.functions.hashing import (
    canonical_json,
    content_fingerprint,
    json_field,
    row_hash,
)
from tidemark.functions.identity import (
    manifest_entries,
    schema_fingerprint,
    with_batch_identity,
)
from tidemark.functions.periods import is_quarter_name, listed_quarters, quarter_of
from tidemark.operators.compare import missing_from
from tidemark.plans.ingest import with_audit_columns
from tidemark.session import scratch_folder
from tidemark.sources.delimited import scan_declared, scan_profiled, source_digests
from tidemark.sources.logs import (
    attempt_status,
    latest_attempts,
    parse_run_lines,
    remaining,
    run_line,
)

_ORDER_TEXT = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
)
_PRICED = "(SELECT * REPLACE (CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice) FROM orders)"


def _priced(spark, sf):
    """Orders with an exact price, which has one text form."""
    return table(spark, sf, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))


def _sql_row_hash(columns) -> str:
    one = "coalesce(length(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), 'N')"
    return "sha256(concat(" + ", ".join(one.format(c) for c in columns) + "))"


_PLAIN = "sha256(concat(" + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), ' ')" for c in ("o_orderkey", "o_orderstatus", "maybe")
) + "))"


@query(f"SELECT o_orderkey, {_sql_row_hash(_ORDER_TEXT)} AS row_hash FROM {_PRICED}")
def row_hash_orders(spark, sf):
    return _priced(spark, sf).select("o_orderkey", row_hash(_ORDER_TEXT).alias("row_hash"))


@query(
    f"""SELECT o_orderkey, {_PLAIN} AS row_hash FROM (
        SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS maybe FROM orders)"""
)
def row_hash_plain(spark, sf):
    maybe = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    rows = table(spark, sf, "orders").withColumn("maybe", maybe)
    plain = row_hash(("o_orderkey", "o_orderstatus", "maybe"), injective=False)
    return rows.select("o_orderkey", plain.alias("row_hash"))


@query(
    f"""SELECT o_orderkey, '2024-01-01 00:00:00' AS _ingest_ts, 'orders' AS _source_file,
        'b-' || year(o_orderdate) AS _batch_id, {_sql_row_hash(_ORDER_TEXT)} AS _src_row_hash
        FROM {_PRICED}"""
)
def audit_columns(spark, sf):
    rows = _priced(spark, sf).select(*_ORDER_TEXT)
    batch = F.concat(F.lit("b-"), text(F.year("o_orderdate")))
    stamped = with_audit_columns(rows, batch, "orders", "2024-01-01 00:00:00")
    return stamped.select(
        "o_orderkey", text("_ingest_ts").alias("_ingest_ts"), "_source_file", "_batch_id",
        "_src_row_hash",
    )


@query(
    """SELECT c_custkey, '{"a.seg":"' || c_mktsegment || '","b":"' || c_name || '","z":"'
       || c_nationkey || '"}' AS json FROM customer"""
)
def canonical_json_rows(spark, sf):
    entries = F.create_map(
        F.lit("z"), text("c_nationkey"), F.lit("b"), F.col("c_name"),
        F.lit("a.seg"), F.col("c_mktsegment"),
    )
    return table(spark, sf, "customer").select("c_custkey", canonical_json(entries).alias("json"))


_QUARTER = "year(o_orderdate) || 'q' || quarter(o_orderdate)"


@query(
    f"""WITH shas AS (SELECT {_QUARTER} AS quarter, o_orderpriority,
            sha256(CAST(count(*) AS VARCHAR) || o_orderpriority) AS sha FROM orders GROUP BY 1, 2),
      manifests AS (SELECT quarter, '{{"code_sha":"c0ffee","param.quarter":"' || quarter
          || '","schema_version":"s1","source_sha256":"' || string_agg(sha, ',' ORDER BY sha)
          || '"}}' AS manifest_json FROM shas GROUP BY quarter)
      SELECT quarter, manifest_json, sha256(manifest_json) AS batch_id FROM manifests"""
)
def batch_id(spark, sf):
    """Content-addressed ids of batches with several sources each."""
    sources = (
        table(spark, sf, "orders")
        .groupBy(quarter_of(F.col("o_orderdate")).alias("quarter"), "o_orderpriority")
        .agg(F.count("*").alias("n"))
        .withColumn("sha", F.sha2(F.concat(text("n"), F.col("o_orderpriority")), 256))
    )
    # At most five sources per quarter here; a batch lists its files.
    batches = sources.groupBy("quarter").agg(F.collect_list("sha").alias("shas"))
    entries = manifest_entries(
        F.col("shas"), F.lit("s1"), F.lit("c0ffee"), {"quarter": F.col("quarter")}
    )
    return with_batch_identity(batches, entries).select("quarter", "manifest_json", "batch_id")


@query(
    f"""WITH {SQL_REGISTRY} SELECT batch_id,
        json_extract_string(manifest_json, '$."param.quarter"') AS quarter FROM registry"""
)
def manifest_field(spark, sf):
    quarter = json_field(F.col("manifest_json"), "param.quarter")
    return quarter_registry(spark, sf).select("batch_id", quarter.alias("quarter"))


@query(
    """SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT)
       AS k_sum FROM events GROUP BY event_type"""
)
def event_props_field(spark, sf):
    k = json_field(F.col("props"), "k").try_cast("bigint")
    return table(spark, sf, "events").groupBy("event_type").agg(F.sum(k).alias("k_sum"))


_TABLES = tuple(
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations".split()
)
_SQL_TYPE = """CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string'
  WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' END"""


@query(
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, (SELECT sha256(string_agg(column_name || ':' || {_SQL_TYPE}
            || ':true', '|' ORDER BY column_index)) FROM duckdb_columns()
            WHERE table_name = '{t}') AS fingerprint, count(*) AS n_rows FROM {t}"""
        for t in _TABLES
    )
)
def schema_fingerprints(spark, sf):
    """Schema identity per table with its row count; column order matters."""
    out = None
    for name in _TABLES:
        df = table(spark, sf, name)
        row = df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table_name"),
            F.lit(schema_fingerprint(df.schema)).alias("fingerprint"),
            "n_rows",
        )
        out = row if out is None else out.unionByName(row)
    return out


_LINE = "concat_ws(chr(9), o_orderkey, o_custkey, o_orderstatus, o_orderpriority) || chr(10)"


@query(
    f"""SELECT strftime(o_orderdate, '%Y-%m-%d') AS day,
          CAST(sum(strlen({_LINE})) AS BIGINT) AS length,
          sha256(string_agg({_LINE}, '' ORDER BY o_orderkey)) AS sha256
        FROM orders GROUP BY 1"""
)
def source_digest(spark, sf):
    """SHA-256 of the bytes of text files that hold one day's orders each, in order."""
    folder = scratch_folder(spark, "days")
    cells = [text(c) for c in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")]
    rows = table(spark, sf, "orders").select(
        F.concat_ws("\t", *cells).alias("value"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        "o_orderkey",
    )
    dealt = rows.repartition("day").sortWithinPartitions("day", "o_orderkey")
    dealt.drop("o_orderkey").write.partitionBy("day").text(folder)
    day = F.regexp_extract("path", r"day=([^/]+)/", 1)
    return source_digests(spark, folder).select(day.alias("day"), "length", "sha256")


@query(
    """SELECT count(*) AS n_rows, CAST(sum(h) AS VARCHAR) AS content_hash FROM (
       SELECT CAST(('0x' || substr("""
    + _sql_row_hash(_ORDER_TEXT)
    + f""", 1, 15))::BIGINT AS HUGEINT) AS h FROM {_PRICED})"""
)
def table_fingerprint(spark, sf):
    return content_fingerprint(_priced(spark, sf).select(*_ORDER_TEXT))


# -- sources ------------------------------------------------------------------


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS adsh, CAST(o_custkey AS VARCHAR) AS cik,
       o_orderpriority AS form, CAST(o_orderdate AS VARCHAR) AS accepted FROM orders"""
)
def tsv_scan(spark, sf):
    """Orders written tab-separated, read back by declared names, all text.

    The files have more columns than declared, in different orders, and one
    declared column is absent.
    """
    folder, rows = scratch_folder(spark, "tsv parts [50%]"), raw_filings(spark, sf)
    urgent = F.col("form") == "1-URGENT"
    for part in (rows.filter(urgent), rows.filter(~urgent).select(*reversed(rows.columns))):
        part.write.mode("append").option("header", True).option("sep", "\t").csv(folder)
    return scan_declared(spark, re.sub(r"([\[\]])", r"\\\1", folder), ("adsh", "cik", "form", "accepted", "instance"))


@query(
    """SELECT count(*) AS n_rows, CAST(sum(o_custkey) AS BIGINT) AS cik_sum,
       'int,bigint,string,string,int,int,string,int,timestamp_ntz' AS types FROM orders"""
)
def tsv_profiled_scan(spark, sf):
    """Types from one pass over the text: ``fy`` reads as a number, not as text."""
    folder = scratch_folder(spark, "tsv")
    wide = raw_filings(spark, sf).withColumn("cik", F.concat(F.lit("1000000000000"), "cik"))
    wide.write.option("header", True).option("sep", "\t").csv(folder)
    got = scan_profiled(spark, folder)
    kinds = ",".join(f.dataType.simpleString() for f in got.schema)
    back = F.substring(text("cik"), 14, 20).cast("bigint")
    return got.agg(
        F.count("*").alias("n_rows"), F.sum(back).alias("cik_sum")
    ).withColumn("types", F.lit(kinds))


# -- ledger, run lines, listing ------------------------------------------------


def _attempts(spark, sf):
    """Each order as one attempt at loading its quarter."""
    code = F.when(F.col("o_orderstatus") == "P", 0).otherwise(1)
    log = (
        F.when(F.col("o_orderstatus") == "O", "halted: DQ gate failed: uniqueness")
        .when(F.col("o_orderstatus") == "F", "java.lang.OutOfMemoryError")
        .otherwise("done")
    )
    orders = table(spark, sf, "orders").withColumn("exit", code).withColumn("log_text", log)
    return orders.select(
        quarter_of(F.col("o_orderdate")).alias("quarter"),
        F.col("o_orderkey").alias("attempt"),
        attempt_status(F.col("exit"), F.col("log_text")).alias("status"),
        F.col("o_orderdate").alias("ts"),
    )


_ATTEMPTS = f"""attempts AS (SELECT {_QUARTER} AS quarter, o_orderkey AS attempt,
  CASE o_orderstatus WHEN 'P' THEN 'ok' WHEN 'O' THEN 'halted' ELSE 'error' END AS status,
  o_orderdate AS ts FROM orders)"""
_LATEST = f"""{_ATTEMPTS}, latest AS (SELECT quarter, attempt, status FROM (
  SELECT *, row_number() OVER (PARTITION BY quarter ORDER BY ts DESC, attempt DESC) AS rn
  FROM attempts) WHERE rn = 1)"""


@query(f"WITH {_ATTEMPTS} SELECT quarter, status, count(*) AS n FROM attempts GROUP BY 1, 2")
def attempt_classify(spark, sf):
    return _attempts(spark, sf).groupBy("quarter", "status").agg(F.count("*").alias("n"))


@query(f"WITH {_LATEST} SELECT quarter, attempt, status FROM latest")
def ledger_latest(spark, sf):
    return latest_attempts(_attempts(spark, sf), order=("ts", "attempt")).select(
        "quarter", "attempt", "status"
    )


@query(
    f"""WITH {_LATEST} SELECT DISTINCT e.quarter FROM attempts e WHERE NOT EXISTS (
        SELECT 1 FROM latest l WHERE l.quarter = e.quarter AND l.status = 'ok')"""
)
def ledger_todo(spark, sf):
    attempts = _attempts(spark, sf)
    one_clock = latest_attempts(attempts, order=("ts", "attempt"))
    return remaining(attempts.select("quarter").distinct(), one_clock)


_PER_CUSTOMER = """SELECT o_custkey, count(*) AS rows_in,
    count(*) FILTER (WHERE o_orderstatus = 'P') AS rows_out,
    count(*) FILTER (WHERE o_orderstatus = 'O') AS scoped_out,
    count(*) FILTER (WHERE o_orderstatus = 'F') AS rejected FROM orders GROUP BY o_custkey"""


def _runs(spark, sf):
    """One run per customer: counts by status become the run's metrics."""
    status = F.col("o_orderstatus")
    return (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count("*").alias("rows_in"),
            F.count_if(status == "P").alias("rows_out"),
            F.count_if(status == "O").alias("scoped_out"),
            F.count_if(status == "F").alias("rejected"),
        )
        .withColumns(
            {
                "batch_id": F.sha2(text("o_custkey"), 256),
                "quarantined": F.col("rejected"),
                "gate": F.lit("Pass"),
                "delta_version": F.col("o_custkey"),
                "wall_clock_ms": F.col("rows_in") * 3,
            }
        )
    )


@query(
    f"""SELECT o_custkey, 'run batch_id=' || sha256(CAST(o_custkey AS VARCHAR)) || ' rows_in='
        || rows_in || ' rows_out=' || rows_out || ' scoped_out=' || scoped_out || ' rejected='
        || rejected || ' quarantined=' || rejected || ' gate=Pass delta_version=' || o_custkey
        || ' wall_clock_ms=' || rows_in * 3 AS line FROM ({_PER_CUSTOMER})"""
)
def run_metrics_line(spark, sf):
    return _runs(spark, sf).select("o_custkey", run_line().alias("line"))


@query(
    f"""SELECT sha256(CAST(o_custkey AS VARCHAR)) AS batch_id, rows_in, rows_out, scoped_out,
        rejected, rejected AS quarantined, 'Pass' AS gate, o_custkey AS delta_version,
        CASE WHEN scoped_out > 0 THEN rows_in * 3 END AS wall_clock_ms FROM ({_PER_CUSTOMER})"""
)
def run_log_fields(spark, sf):
    """Run lines among other output, some without a wall clock, read back as fields."""
    line = F.concat(F.lit("[info] "), run_line())
    bare = F.regexp_replace(line, r" wall_clock_ms=\d+", "")
    shown = F.when(F.col("scoped_out") > 0, line).otherwise(bare)
    runs = _runs(spark, sf)
    lines = runs.select(shown.alias("value"))
    noise = runs.select(F.concat(F.lit("[info] compiling "), text("o_custkey")).alias("value"))
    return parse_run_lines(lines.unionByName(noise))


def _listing(spark, sf):
    """One line of listing markup per order, some links not to quarters."""
    link = F.concat(
        F.lit('<a href="/files/'), quarter_of(F.col("o_orderdate")), F.lit('.zip">get</a> '),
        F.lit('<a href="/files/'), text(F.year("o_orderdate")), F.lit('q7.zip">bad</a>'),
    )
    return table(spark, sf, "orders").select(link.alias("html"))


@query(f"SELECT DISTINCT {_QUARTER} AS quarter FROM orders")
def quarter_listing(spark, sf):
    found = listed_quarters(_listing(spark, sf), "html")
    return found.filter(is_quarter_name(F.col("quarter")))


@query(
    f"""SELECT DISTINCT {_QUARTER} AS quarter FROM orders EXCEPT
        SELECT DISTINCT {_QUARTER} FROM orders
        WHERE o_orderdate < TIMESTAMP '1997-01-01' OR o_orderdate >= TIMESTAMP '1999-01-01'"""
)
def quarter_gaps(spark, sf):
    """Listed quarters that nothing was loaded for."""
    listed = listed_quarters(_listing(spark, sf), "html")
    day = F.col("o_orderdate")
    early = day < F.lit("1997-01-01").cast("timestamp_ntz")
    late = day >= F.lit("1999-01-01").cast("timestamp_ntz")
    loaded = table(spark, sf, "orders").filter(early | late)
    return missing_from(listed, loaded.select(quarter_of(day).alias("quarter")), ["quarter"])
