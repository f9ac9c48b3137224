"""Recomputation and comparison queries over batches of filed facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalogue.base import (
    FILED,
    SQL_BATCHED,
    batched_facts,
    quarter_registry,
    query,
    stored,
    table,
)
from tidemark.catalogue.hashes import _PRICED, _priced, _sql_row_hash
from tidemark.functions.casting import cast_facts
from tidemark.functions.hashing import content_fingerprint, row_hash
from tidemark.model import BATCH_ID, INGEST_TS, ROW_HASH, instant
from tidemark.operators.compare import compare_fingerprints, two_way_difference
from tidemark.operators.probe import credit
from tidemark.operators.recompute import (
    METRIC_COLUMNS,
    batch_counts,
    bronze_counts,
    conservation_findings,
    first_slice,
    key_collisions,
    logged_mismatches,
    metrics_table,
    run_slices,
    with_totals,
)
from tidemark.operators.splits import all_present, in_scope, split_scope, split_valid
from tidemark.session import scratch_folder
from tidemark.sources.logs import last_run_lines, run_line, scan_run_logs

_SCOPED = "segments IS NULL AND coreg IS NULL"


@query(
    """WITH a AS (SELECT o_orderkey AS h FROM orders WHERE o_orderstatus <> 'P'),
       b AS (SELECT o_orderkey AS h FROM orders WHERE o_orderstatus <> 'F')
       SELECT count(*) FILTER (WHERE h NOT IN (SELECT h FROM b)) AS only_left,
         (SELECT count(*) FROM b WHERE h NOT IN (SELECT h FROM a)) AS only_right FROM a"""
)
def two_way_anti(spark, sf):
    """Two versions of a table by row hash: what each side lacks."""
    names = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    hashed = _priced(spark, sf).withColumn(ROW_HASH, row_hash(names))
    return two_way_difference(
        hashed.filter("o_orderstatus <> 'P'"), hashed.filter("o_orderstatus <> 'F'"), ROW_HASH
    )


@query(
    f"""WITH {SQL_BATCHED} SELECT _batch_id, count(*) AS n,
        count(*) FILTER (WHERE NOT ({_SCOPED})) AS scoped_out,
        count(*) FILTER (WHERE {_SCOPED} AND value IS NULL) AS no_value
        FROM batched GROUP BY _batch_id"""
)
def batch_count_conditions(spark, sf):
    inside = in_scope(FILED.scope)
    conditions = {"scoped_out": ~inside, "no_value": inside & F.col("value").isNull()}
    return batch_counts(batched_facts(spark, sf), BATCH_ID, conditions)


def _loose(spark, sf, facts=None):
    """Batched facts whose version is dropped to one text, so keys collide."""
    facts = facts or batched_facts(spark, sf)
    return facts.withColumn("version", F.lit("v1"))


@query(
    f"""WITH {SQL_BATCHED}, g AS (
        SELECT _batch_id, count(*) AS c FROM batched WHERE {_SCOPED} AND value IS NOT NULL
        GROUP BY _batch_id, adsh, tag, ddate, qtrs, uom)
        SELECT _batch_id, CAST(sum(c - 1) AS BIGINT) AS key_collisions FROM g WHERE c > 1
        GROUP BY _batch_id"""
)
def batch_key_collisions(spark, sf):
    return key_collisions(_loose(spark, sf), FILED)


def _quarantined(facts):
    entity, _ = split_scope(facts, FILED.scope)
    return split_valid(cast_facts(entity, FILED), FILED.row_required)[1]


def _lane_with_reruns(spark, sf, facts=None):
    """Quarantine lane after a full rerun; late batches lost a tag in between."""
    first = _quarantined(facts or batched_facts(spark, sf))
    again = first.withColumn(INGEST_TS, instant("2024-06-01 00:00:00"))
    kept = (F.col(BATCH_ID) < "b-2000") | (F.col("tag") != "R")
    return first.unionByName(again.filter(kept))


_SQL_Q = f"""q AS (SELECT _batch_id, tag FROM batched WHERE {_SCOPED} AND value IS NULL),
  slices AS (
    SELECT _batch_id, 1 AS run, count(*) AS n FROM q GROUP BY _batch_id
    UNION ALL SELECT _batch_id, 2, count(*) FROM q
      WHERE _batch_id < 'b-2000' OR tag <> 'R' GROUP BY _batch_id)"""


@query(
    f"""WITH {SQL_BATCHED}, {_SQL_Q} SELECT _batch_id,
        max(CASE WHEN run = 1 THEN n END) AS q_rows, count(*) AS n_slices,
        min(n) <> max(n) AS unequal_slices FROM slices GROUP BY _batch_id"""
)
def quarantine_run_slices(spark, sf):
    return first_slice(run_slices(_lane_with_reruns(spark, sf)))


def _commits(spark, sf, facts=None):
    """Commit rows as the silver table would hold them, one per batch."""
    facts = facts or batched_facts(spark, sf)
    usable = in_scope(FILED.scope) & all_present(FILED.row_required)
    counted = batch_counts(facts, BATCH_ID, {"good": usable})
    n = F.col("good")
    return counted.select(
        F.hash(BATCH_ID).cast("bigint").alias("version"),
        F.lit("MERGE").alias("operation"),
        n.alias("num_source"),
        (n - F.when(F.col(BATCH_ID) < "b-1996", 1).otherwise(0)).alias("num_inserted"),
        F.lit(0).cast("bigint").alias("num_updated"),
        F.col(BATCH_ID).alias("label"),
    )


def _unevaluable(spark, sf):
    early = quarter_registry(spark, sf).filter("batch_id < 'b-1995q3'")
    return early.select("batch_id", F.lit("empty batch where rows expected").alias("reason"))


def _attempts(spark, sf):
    """Two attempts per quarter on record; those of 1993 end refused."""
    quarters = quarter_registry(spark, sf).select(F.substring("batch_id", 3, 9).alias("quarter"))
    both = quarters.select("quarter", F.explode(F.array(F.lit(1), F.lit(2))).alias("attempt"))
    refused = (F.col("attempt") == 2) & F.col("quarter").startswith("1993")
    return both.select(
        "quarter",
        F.when(refused, "halted").otherwise("ok").alias("status"),
        F.make_timestamp_ntz(F.lit(2024), "attempt", F.lit(1), F.lit(0), F.lit(0), F.lit(0)).alias("ts"),
    )


def _run_logs(spark, sf, facts=None):
    """Log files of both attempts, scanned: the first logged other numbers, the second
    a row too many in 1998, nothing quarantined in 1999 and another batch in 2000."""
    facts = facts or batched_facts(spark, sf)
    inside = in_scope(FILED.scope)
    counts = {"scoped_out": ~inside, "quarantined": inside & F.col("value").isNull()}
    counted = batch_counts(facts, BATCH_ID, counts)
    named = quarter_registry(spark, sf).select(F.col("batch_id").alias(BATCH_ID), "delta_version")
    year = F.substring(BATCH_ID, 3, 4)
    runs = named.join(counted, BATCH_ID).select(
        F.substring(BATCH_ID, 3, 9).alias("quarter"),
        F.when(year == "2000", "b-other").otherwise(F.col(BATCH_ID)).alias("batch_id"),
        (F.col("n") + F.when(year == "1998", 1).otherwise(0)).alias("rows_in"),
        F.col("n").alias("rows_out"),
        "scoped_out",
        F.lit(0).cast("bigint").alias("rejected"),
        F.when(year == "1999", 0).otherwise(F.col("quarantined")).alias("quarantined"),
        F.lit("Pass").alias("gate"),
        "delta_version",
        (F.col("delta_version") * 100).alias("wall_clock_ms"),
    )
    worse = runs.withColumns({"rows_in": F.lit(7).cast("bigint"), "wall_clock_ms": F.lit(1).cast("bigint")})
    lines = worse.withColumn("attempt", F.lit(1)).unionByName(runs.withColumn("attempt", F.lit(2)))
    folder = scratch_folder(spark, "run-logs")
    lines.select(
        F.concat(F.lit("[info] "), run_line()).alias("value"),
        "attempt",
        F.concat(F.lit("backfill-"), "quarter", F.lit(".log")).alias("log"),
    ).write.partitionBy("attempt", "log").text(folder)
    return last_run_lines(scan_run_logs(spark, folder), _attempts(spark, sf))


def _metrics_and_logs(spark, sf):
    """Metrics counted from stored tables, and the logs; the facts meet their filings once."""
    facts = stored(batched_facts(spark, sf), "facts")
    logs = _run_logs(spark, sf, facts)
    metrics = metrics_table(
        quarter_registry(spark, sf),
        stored(_loose(spark, sf, facts), "bronze"),
        stored(_lane_with_reruns(spark, sf, facts), "lane"),
        _unevaluable(spark, sf),
        stored(_commits(spark, sf, facts), "commits"),
        FILED,
        logs,
    )
    return metrics, logs


def _metrics(spark, sf):
    return _metrics_and_logs(spark, sf)[0]


_SQL_METRICS = f"""{SQL_BATCHED}, {_SQL_Q},
  coll AS (SELECT _batch_id, CAST(sum(c - 1) AS BIGINT) AS k FROM (
    SELECT _batch_id, count(*) AS c FROM batched WHERE {_SCOPED} AND value IS NOT NULL
    GROUP BY _batch_id, adsh, tag, ddate, qtrs, uom) GROUP BY _batch_id),
  per AS (SELECT _batch_id, count(*) AS rows_in,
      count(*) FILTER (WHERE NOT ({_SCOPED})) AS scoped_out,
      count(*) FILTER (WHERE {_SCOPED} AND value IS NOT NULL) AS rows_to_silver,
      count(*) FILTER (WHERE {_SCOPED} AND value IS NULL) AS q_rows
    FROM batched GROUP BY _batch_id),
  uneq AS (SELECT _batch_id, min(n) <> max(n) AS unequal_slices FROM slices GROUP BY _batch_id),
  metrics AS (SELECT substr(b.batch_id, 3) AS quarter, b.batch_id,
      coalesce(rows_in, 0) AS rows_in, coalesce(scoped_out, 0) AS scoped_out,
      coalesce(rows_to_silver, 0) AS rows_to_silver, coalesce(q_rows, 0) AS q_rows,
      CAST(0 AS BIGINT) AS q_detail,
      CAST(CASE WHEN b.batch_id < 'b-1995q3' THEN 1 ELSE 0 END AS BIGINT) AS q_uneval,
      CAST(CASE WHEN rows_in IS NOT NULL AND b.batch_id < 'b-1996' THEN 1 ELSE 0 END AS BIGINT)
        AS dedupe,
      coalesce(k, 0) AS key_collisions, coalesce(unequal_slices, FALSE) AS unequal_slices,
      CASE WHEN rows_in IS NULL OR b.batch_id LIKE 'b-1993%' THEN 0
        ELSE CAST(round(n * 100 / 1000) AS BIGINT) END AS wall_clock_s
    FROM (SELECT 'b-' || year(o_orderdate) || 'q' || quarter(o_orderdate) AS batch_id, count(*) AS n
          FROM orders GROUP BY 1) b
    LEFT JOIN per ON per._batch_id = b.batch_id LEFT JOIN coll ON coll._batch_id = b.batch_id
    LEFT JOIN uneq ON uneq._batch_id = b.batch_id)"""


@query(f"WITH {_SQL_METRICS} SELECT * FROM metrics")
def metrics_recomputed(spark, sf):
    return _metrics(spark, sf)


_COLS = ", ".join(METRIC_COLUMNS)
_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT)" for c in METRIC_COLUMNS)


@query(
    f"""WITH {_SQL_METRICS} SELECT quarter, {_COLS} FROM metrics
        UNION ALL SELECT 'total', {_SUMS} FROM metrics"""
)
def metrics_totals(spark, sf):
    return with_totals(_metrics(spark, sf)).orderBy("quarter")


@query(
    f"""WITH {_SQL_METRICS}, m AS (SELECT *, quarter LIKE '1997%' AS halted FROM metrics),
      f AS (SELECT quarter, 'gate leaked' AS finding FROM m WHERE halted AND rows_to_silver <> 0
        UNION ALL SELECT quarter, 'conservation' FROM m
          WHERE NOT halted AND rows_in - scoped_out - q_rows <> rows_to_silver
        UNION ALL SELECT quarter, 'key collisions' FROM m WHERE NOT halted AND key_collisions <> 0
        UNION ALL SELECT quarter, 'unequal run slices' FROM m WHERE unequal_slices)
      SELECT f.quarter, f.finding, m.rows_in - m.scoped_out - m.q_rows AS expected,
             m.rows_to_silver, m.key_collisions FROM f JOIN m USING (quarter)"""
)
def conservation(spark, sf):
    """Findings when 1997 is said to be halted, keys collide and reruns differ."""
    quarters = quarter_registry(spark, sf).select(F.substring("batch_id", 3, 9).alias("quarter"))
    halted = F.when(F.col("quarter").startswith("1997"), "halted").otherwise("ok")
    return conservation_findings(_metrics(spark, sf), quarters.withColumn("status", halted))


@query(
    f"""WITH {_SQL_METRICS}
      SELECT quarter, 'rows_in' AS field, CAST(rows_in AS VARCHAR) AS recomputed,
             CAST(rows_in + 1 AS VARCHAR) AS logged FROM metrics WHERE quarter LIKE '1998%'
      UNION ALL SELECT quarter, 'quarantined', CAST(q_rows AS VARCHAR), CAST(0 AS VARCHAR)
        FROM metrics WHERE quarter LIKE '1999%' AND q_rows <> 0
      UNION ALL SELECT quarter, 'batch_id', batch_id, 'b-other' FROM metrics
        WHERE quarter LIKE '2000%'"""
)
def logged_vs_recomputed(spark, sf):
    """What the last log file of a quarter says otherwise than the tables."""
    return logged_mismatches(*_metrics_and_logs(spark, sf))


@query(
    f"""WITH {SQL_BATCHED} SELECT _batch_id, count(*) AS rows_in,
        count(*) FILTER (WHERE NOT ({_SCOPED})) AS scoped_out FROM batched GROUP BY _batch_id"""
)
def bronze_batch_counts(spark, sf):
    return bronze_counts(batched_facts(spark, sf), FILED)


_PRINTED = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@query(
    f"""WITH one AS (SELECT CAST(('0x' || substr({_sql_row_hash(_PRINTED)}, 1, 15))::BIGINT AS HUGEINT) AS h
          FROM {_PRICED}),
        loaded AS (SELECT CAST(('0x' || substr({_sql_row_hash((*_PRINTED, "loaded_at"))}, 1, 15))::BIGINT AS HUGEINT) AS h
          FROM (SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS loaded_at FROM {_PRICED})),
        again AS (SELECT CAST(('0x' || substr({_sql_row_hash((*_PRINTED, "loaded_at"))}, 1, 15))::BIGINT AS HUGEINT) AS h
          FROM (SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at FROM {_PRICED}))
        SELECT (SELECT count(*) FROM one) AS rows_before, (SELECT count(*) FROM again) AS rows_after,
          (SELECT CAST(sum(h) AS VARCHAR) FROM one) AS content,
          (SELECT CAST(sum(h) AS VARCHAR) FROM loaded) AS before_with_load_time,
          (SELECT CAST(sum(h) AS VARCHAR) FROM again) AS after_with_load_time"""
)
def rerun_fingerprints(spark, sf):
    """A rerun changes the load time and nothing else; the price counts as a decimal."""
    before = _priced(spark, sf).select(*_PRINTED, instant("2024-01-01 00:00:00").alias(INGEST_TS))
    after = before.repartition(5).withColumn(INGEST_TS, instant("2024-02-01 00:00:00"))
    content = compare_fingerprints(before, after, exclude=[INGEST_TS]).filter("same")
    with_time = lambda df: content_fingerprint(df).select("content_hash").scalar()
    return content.select(
        "rows_before",
        "rows_after",
        content_fingerprint(before, [INGEST_TS]).select("content_hash").scalar().alias("content"),
        with_time(before).alias("before_with_load_time"),
        with_time(after).alias("after_with_load_time"),
    )


@query(
    """SELECT o_custkey AS claim, bool_and(o_orderstatus <> 'F') FILTER (WHERE o_orderstatus <> 'O')
         AS probe_passed,
       count(*) FILTER (WHERE o_orderstatus = 'O') > 0 AS control_ran,
       bool_or(o_totalprice > 400000) FILTER (WHERE o_orderstatus = 'O') AS control_passed,
       coalesce(bool_and(o_orderstatus <> 'F') FILTER (WHERE o_orderstatus <> 'O'), FALSE)
         AND count(*) FILTER (WHERE o_orderstatus = 'O') > 0
         AND NOT coalesce(bool_or(o_totalprice > 400000) FILTER (WHERE o_orderstatus = 'O'), TRUE)
         AS credited
       FROM orders GROUP BY o_custkey"""
)
def probe_credit(spark, sf):
    """Orders as probe records per customer: O are controls, P and F are probes."""
    is_control = F.col("o_orderstatus") == "O"
    passed = F.when(is_control, F.col("o_totalprice") > 400000).otherwise(
        F.col("o_orderstatus") == "P"
    )
    records = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("claim"),
        F.when(is_control, "control").otherwise("probe").alias("role"),
        passed.alias("passed"),
    )
    return credit(records)
