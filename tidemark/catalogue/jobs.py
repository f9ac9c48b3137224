"""The batch jobs run on filed facts; each returns rows of the tables it wrote."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.catalogue.base import (
    AS_OF,
    FILED,
    ORDERS,
    SQL_FILINGS,
    SQL_GOLD,
    SQL_ORDERS_GOLD,
    SQL_RAW,
    SQL_REGISTRY,
    SQL_SILVER,
    filed_facts,
    order_rows,
    quarter_registry,
    query,
    raw_facts,
    raw_filings,
    stored,
    text,
)
from tidemark.functions.casting import cast_filings
from tidemark.model import BATCH_ID, INGEST_TS, instant
from tidemark.operators.compare import note_state, rerun_diff
from tidemark.operators.intervals import as_of, validity_intervals
from tidemark.operators.quality import QualityHalt
from tidemark.operators.recompute import METRIC_COLUMNS
from tidemark.operators.twins import dropped_column_twin
from tidemark.plans.backfill import Ledger, backfill, lake_metrics
from tidemark.plans.gold import rebuild_gold, run_batch
from tidemark.plans.ingest import ingest_quarter
from tidemark.plans.lake import Lake
from tidemark.plans.publish import Published, write_audit_publish
from tidemark.plans.silver import run_silver
from tidemark.session import scratch_folder, unsorted_writes
from tidemark.sources.tables import move_folder

_NOW = "2024-01-01 00:00:00"
_SCOPED = "segments IS NULL AND coreg IS NULL"


def _write_sources(spark, sf, folder, quarter_of_row=None, shape=lambda facts: facts):
    """Fact and filing TSVs; one quarter folder per value of ``quarter_of_row``.

    Facts meet their filings once, and all quarters are written by one job.
    """
    filings = raw_filings(spark, sf)
    filings = filings.withColumn("_q", quarter_of_row if quarter_of_row is not None else F.lit("2001q4"))
    facts = shape(filed_facts(spark, sf, filings.select("adsh", "_q")))
    quarters = [r["_q"] for r in filings.select("_q").distinct().orderBy("_q").collect()]
    for df, name in ((facts, "num.txt"), (filings, "sub.txt")):
        with unsorted_writes(spark):  # there are few quarters
            _tsv(df.write.partitionBy("_q"), f"{folder}/{name}")
        for q in quarters:
            place = f"{folder}/{q.replace('-', '/')}/{name}"
            if not move_folder(spark, f"{folder}/{name}/_q={q}", place):
                _tsv(df.drop("_q").limit(0).write, place)  # no row, but the header
    return quarters


def _tsv(writer, path):
    packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    writer.option("header", True).option("sep", "\t").options(**packed).csv(path)


def _frames(spark, sf, batch_id="b1"):
    stamp = {INGEST_TS: instant(_NOW), BATCH_ID: F.lit(batch_id)}
    return raw_facts(spark, sf).withColumns(stamp), cast_filings(raw_filings(spark, sf), FILED)


def _lake(spark) -> Lake:
    return Lake(spark, scratch_folder(spark, "lake"))


def _loaded_lake(spark, sf) -> Lake:
    """A lake that holds all of the data as one ingested quarter, gold built."""
    lake, source = _lake(spark), scratch_folder(spark, "source")
    for quarter in _write_sources(spark, sf, source):
        got = ingest_quarter(lake, source, quarter, "c0ffee", _NOW)
        run_silver(lake, got.facts, got.filings, got.batch_id, _NOW)
    rebuild_gold(lake)
    return lake


@query(
    f"""WITH {SQL_RAW} SELECT 'facts' AS bronze, count(*) AS n_rows,
        count(DISTINCT adsh) AS n_filings FROM raw
        UNION ALL SELECT 'filings', count(*), count(*) FROM orders"""
)
def ingest_job(spark, sf):
    """Two loads of the same files leave each source row once in bronze."""
    lake, source = _lake(spark), scratch_folder(spark, "source")
    for quarter in _write_sources(spark, sf, source):
        ingest_quarter(lake, source, quarter, "c0ffee", _NOW)
        ingest_quarter(lake, source, quarter, "c0ffee", "2024-02-01 00:00:00")

    def counted(t, name):
        return t.read().agg(
            F.lit(name).alias("bronze"),
            F.count("*").alias("n_rows"),
            F.countDistinct("adsh").alias("n_filings"),
        )

    return counted(lake.bronze_facts, "facts").unionByName(
        counted(lake.bronze_filings, "filings")
    )


@query(
    f"""WITH {SQL_RAW} SELECT 'b1' AS batch_id, count(*) AS rows_in,
        count(*) FILTER (WHERE {_SCOPED} AND value IS NOT NULL) AS rows_out,
        count(*) FILTER (WHERE NOT ({_SCOPED})) AS scoped_out,
        count(*) FILTER (WHERE {_SCOPED} AND value IS NULL) AS rejected,
        count(*) FILTER (WHERE {_SCOPED} AND value IS NULL) AS quarantined,
        'Pass' AS gate, CAST(0 AS BIGINT) AS delta_version FROM raw"""
)
def silver_stage(spark, sf):
    facts, filings = _frames(spark, sf)
    run = run_silver(_lake(spark), facts, filings, "b1", _NOW)
    return run.frame(spark).drop("wall_clock_ms")


@query(
    f"""WITH {SQL_RAW} SELECT 'Unevaluable' AS outcome,
        'missing source column(s): value' AS reason, CAST(1 AS BIGINT) AS lane_rows,
        FALSE AS silver_exists, count(*) AS rows_in FROM raw"""
)
def silver_stage_unevaluable(spark, sf):
    """A batch without ``value`` halts, leaves one lane row, and reaches no table."""
    lake = _lake(spark)
    facts, filings = _frames(spark, sf)
    try:
        run_silver(lake, facts.drop("value"), filings, "b1", _NOW)
        outcome = "Pass"
    except QualityHalt as halt:
        outcome = halt.outcome.label
    rows_in = facts.agg(F.count("*"))
    return (
        lake.quarantine_unevaluable.read()
        .groupBy("reason")
        .agg(F.count("*").alias("lane_rows"))
        .select(
            F.lit(outcome).alias("outcome"),
            "reason",
            "lane_rows",
            F.lit(lake.silver.exists()).alias("silver_exists"),
            rows_in.scalar().alias("rows_in"),
        )
    )


@query(
    f"""WITH {SQL_SILVER}, d AS (SELECT 1 FROM silver GROUP BY adsh, tag, ddate, qtrs, uom
          HAVING count(*) > 1)
        SELECT 'silver-num' AS "check", 'uniqueness' AS "constraint",
          'adsh,tag,version,ddate,qtrs,uom' AS target, count(*) AS violations FROM d"""
)
def silver_stage_refused(spark, sf):
    """Colliding keys refuse the batch whole; the detail lane says how many."""
    lake = _lake(spark)
    facts, filings = _frames(spark, sf)
    try:
        run_silver(lake, facts.withColumn("version", F.lit("v1")), filings, "b1", _NOW)
    except QualityHalt:
        assert not lake.silver.exists()
    return lake.quarantine_detail.read()


@query(
    f"""WITH {SQL_RAW}, n AS (SELECT count(*) AS facts FROM raw), o AS (SELECT count(*) AS filings FROM orders)
        SELECT 'missing source column(s): value' AS reason, facts AS bronze_facts,
          filings AS bronze_filings, 1::BIGINT AS registered, 0::BIGINT AS silver_rows FROM n, o"""
)
def twin_dropped_column(spark, sf):
    """Source files without ``value`` reach bronze and the registry, and nothing beyond."""
    lake, source = _lake(spark), scratch_folder(spark, "source")
    for quarter in _write_sources(spark, sf, source, shape=lambda f: dropped_column_twin(f, "value")):
        got = ingest_quarter(lake, source, quarter, "c0ffee", _NOW)
        try:
            run_silver(lake, got.facts, got.filings, got.batch_id, _NOW)
        except QualityHalt as halt:
            assert halt.outcome.label == "Unevaluable"
    count = lambda t: t.read().agg(F.count("*")).scalar()
    return lake.quarantine_unevaluable.read().select(
        "reason",
        count(lake.bronze_facts).alias("bronze_facts"),
        count(lake.bronze_filings).alias("bronze_filings"),
        count(lake.registry).alias("registered"),
        F.lit(lake.silver.row_count()).cast("bigint").alias("silver_rows"),
    )


_FILED_OUT = """SELECT cik, tag, ddate, qtrs, uom, CAST(value AS DOUBLE) AS value, adsh, version,
  CAST(valid_from AS VARCHAR) AS valid_from, CAST(valid_to AS VARCHAR) AS valid_to FROM gold"""


def _show(gold):
    return gold.withColumns(
        {
            "value": F.col("value").cast("double"),
            "valid_from": text("valid_from"),
            "valid_to": text("valid_to"),
        }
    ).drop("accepted")


@query(f"WITH {SQL_GOLD} {_FILED_OUT}")
def gold_rebuild(spark, sf):
    """Source files through bronze and silver to a stored gold table, read back."""
    return _show(_loaded_lake(spark, sf).gold.read())


#: A second delivery: filings of customers divisible by three from 1998 on are new to
#: it, it corrects their facts tagged A from before, and it moves one customer's filings.
_LATER = "accepted >= TIMESTAMP_NTZ '1998-01-01 00:00:00' AND cast(cik as bigint) % 3 = 0"


@query(
    f"""WITH {SQL_SILVER}, {SQL_FILINGS}, sent AS (
          SELECT s.* REPLACE (CASE WHEN tag = 'A' AND cik % 3 = 0
              AND NOT (accepted >= TIMESTAMP '1998-01-01' AND cik % 3 = 0)
            THEN value + 1 ELSE value END AS value) FROM silver s JOIN filings USING (adsh)),
        moved AS (SELECT adsh, CASE WHEN cik % 30 = 0 THEN cik + 1000000 ELSE cik END AS cik, accepted
          FROM filings),
        gold AS (SELECT cik, tag, ddate, qtrs, uom, CAST(value AS DECIMAL(28,4)) AS value, accepted,
            s.adsh, version, accepted AS valid_from,
            coalesce(lead(accepted) OVER (PARTITION BY cik, tag, ddate, qtrs, uom
              ORDER BY accepted, s.adsh, version), TIMESTAMP '9999-12-31 00:00:00') AS valid_to
          FROM sent s JOIN moved f ON s.adsh = f.adsh)
        {_FILED_OUT}"""
)
def gold_increment(spark, sf):
    """Gold after a second delivery: only the changed keys are computed again."""
    return _show(_second_delivery(spark, sf).gold.read())


def _second_delivery(spark, sf) -> Lake:
    """New filings, corrected facts and moved filings on top of a built gold."""
    lake = _lake(spark)
    filings = cast_filings(raw_filings(spark, sf), FILED)
    later = filings.filter(_LATER).select("adsh")
    early = stored(filings.join(later, "adsh", "left_anti"), "filings")
    third = filings.filter(F.col("cik") % 3 == 0)
    marks = {"_later": F.expr(_LATER), "_third": F.col("cik") % 3 == 0}
    marked = filings.groupBy("adsh").agg(*[F.bool_or(v).alias(k) for k, v in marks.items()])
    facts = filed_facts(spark, sf, marked, "left").fillna(False, list(marks))
    facts = stored(facts, "facts")  # a batch is read more than once
    new, old = facts.filter("_later").drop(*marks), facts.filter("NOT _later")
    first = old.drop(*marks).withColumns({BATCH_ID: F.lit("b1"), INGEST_TS: instant(_NOW)})
    run_batch(lake, first, early, "b1", _NOW)
    moved = F.when(F.col("cik") % 30 == 0, F.col("cik") + 1_000_000).otherwise(F.col("cik"))
    corrected = old.filter("tag = 'A' AND _third").drop(*marks)
    raised = (F.col("value").cast("decimal(28,4)") + 1).cast("decimal(28,4)").cast("string")
    batch = new.unionByName(corrected.withColumn("value", raised))
    at = "2024-02-01 00:00:00"
    batch = batch.withColumns({BATCH_ID: F.lit("b2"), INGEST_TS: instant(at)})
    run_batch(lake, batch, third.withColumn("cik", moved), "b2", at, share=1.0)
    return lake


@query(
    f"""WITH {SQL_GOLD} {_FILED_OUT}
        WHERE valid_from <= TIMESTAMP '{AS_OF}' AND valid_to > TIMESTAMP '{AS_OF}'"""
)
def end_to_end_as_of(spark, sf):
    """Two batches, the later filings first, then what was known on the date."""
    lake = _lake(spark)
    filings = cast_filings(raw_filings(spark, sf), FILED)
    is_late = F.col("accepted") >= instant("1998-01-01 00:00:00")
    halves = filings.groupBy("adsh").agg(F.bool_or(is_late).alias("_late"), F.bool_or(~is_late).alias("_early"))
    placed = stored(filed_facts(spark, sf, halves), "facts")  # a batch is read more than once
    for half, filed, at in (("late", is_late, _NOW), ("early", ~is_late, "2024-02-01 00:00:00")):
        stamps = {BATCH_ID: F.lit(f"b-{half}"), INGEST_TS: instant(at)}
        rows = placed.filter(f"_{half}").drop("_late", "_early").withColumns(stamps)
        run_batch(lake, rows, filings.filter(filed), f"b-{half}", at)
    return _show(as_of(lake.gold, AS_OF))


@query(
    """SELECT DISTINCT CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN '1996q4'
         WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN '1998q4' ELSE '2001q4' END AS quarter,
       'ok' AS status FROM orders"""
)
def backfill_ledger(spark, sf):
    """Three batches in time order, run twice: the second run finds nothing to do."""
    lake, source = _lake(spark), scratch_folder(spark, "source")
    quarter = (
        F.when(F.col("accepted") < "1997", "1996q4")
        .when(F.col("accepted") < "1999", "1998q4")
        .otherwise("2001q4")
    )
    quarters = _write_sources(spark, sf, source, quarter)
    backfill(lake, source, quarters, "c0ffee")
    return backfill(lake, source, quarters, "c0ffee").select("quarter", "status")


_QUARTER_OF = (
    "CASE WHEN accepted < '1997' THEN '1996q4' WHEN accepted < '1999' THEN '1998q4' ELSE '2001q4' END"
)
_SQL_BACKFILL = f"""{SQL_RAW}, placed AS (
    SELECT raw.*, CASE WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN '1996q4'
      WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN '1998q4' ELSE '2001q4' END AS quarter
    FROM raw JOIN orders ON adsh = CAST(o_orderkey AS VARCHAR))"""


def _resumed(spark, sf) -> Lake:
    """A backfill whose middle quarter is refused and whose gold fails, then run again.

    The middle quarter comes with colliding keys first and is delivered anew, alone.
    """
    lake, first = _lake(spark), scratch_folder(spark, "source")
    second = f"{first}/again"
    quarter = F.expr(_QUARTER_OF)
    sent = F.explode(F.when(quarter == "1998q4", F.array(quarter, F.lit("again-1998q4"))).otherwise(F.array(quarter)))
    broken = F.when(F.col("_q") == "1998q4", "v1").otherwise(F.col("version"))
    quarters = _write_sources(spark, sf, first, sent, lambda f: f.withColumn("version", broken))
    quarters = [q for q in quarters if not q.startswith("again")]

    def no_gold(lake):
        raise OSError("no space left")

    backfill(lake, first, quarters, "c0ffee", no_gold)
    backfill(lake, second, quarters, "c0ffee")
    return lake


@query(
    f"""WITH {_SQL_BACKFILL}, quarters AS (SELECT DISTINCT quarter FROM placed),
        gold AS (SELECT count(*) AS n FROM placed WHERE {_SCOPED} AND value IS NOT NULL)
        SELECT quarter, 1 AS attempt, CASE quarter WHEN '1998q4' THEN 'halted' ELSE 'ok' END AS status,
          n AS gold_rows FROM quarters, gold
        UNION ALL SELECT '1998q4', 2, 'ok', n FROM gold
        UNION ALL SELECT '_gold_rebuild', 1, 'error', n FROM gold
        UNION ALL SELECT '_gold_rebuild', 2, 'ok', n FROM gold"""
)
def backfill_resume(spark, sf):
    """Every attempt on record: a halted quarter and a failed rebuild cost only themselves."""
    lake = _resumed(spark, sf)
    order = Window.partitionBy("quarter").orderBy("ts")
    return Ledger(lake).read().select(
        "quarter",
        F.row_number().over(order).alias("attempt"),
        "status",
        lake.gold.read().agg(F.count("*")).scalar().alias("gold_rows"),
    )


@query(
    f"""WITH {_SQL_BACKFILL}, batches AS (
          SELECT *, FALSE AS refused FROM placed
          UNION ALL SELECT * REPLACE ('v1' AS version), TRUE FROM placed WHERE quarter = '1998q4'),
        keys AS (SELECT quarter, refused, count(*) AS n FROM batches WHERE {_SCOPED} AND value IS NOT NULL
          GROUP BY quarter, refused, adsh, tag, version, ddate, qtrs, uom),
        twice AS (SELECT quarter, refused, CAST(sum(n - 1) AS BIGINT) AS k FROM keys GROUP BY 1, 2)
        SELECT b.quarter, count(*) AS rows_in, count(*) FILTER (WHERE NOT ({_SCOPED})) AS scoped_out,
          CASE WHEN refused THEN 0 ELSE count(*) FILTER (WHERE {_SCOPED} AND value IS NOT NULL) END
            AS rows_to_silver,
          count(*) FILTER (WHERE {_SCOPED} AND value IS NULL) AS q_rows, CAST(0 AS BIGINT) AS q_detail,
          CAST(0 AS BIGINT) AS q_uneval, CAST(0 AS BIGINT) AS dedupe, any_value(k) AS key_collisions,
          FALSE AS unequal_slices, TRUE AS timed
        FROM batches b JOIN twice USING (quarter, refused) GROUP BY b.quarter, refused"""
)
def backfill_metrics(spark, sf):
    """Metrics of that backfill from its own tables, commits, log files and ledger."""
    return lake_metrics(_resumed(spark, sf)).select(
        "quarter", *METRIC_COLUMNS, "unequal_slices", (F.col("wall_clock_s") >= 0).alias("timed")
    )


@query(
    f"""WITH {SQL_GOLD}, n AS (SELECT (SELECT count(*) FROM raw) AS bronze, (SELECT count(*) FROM silver) AS s,
          (SELECT count(*) FROM gold) AS g,
          (SELECT count(*) FROM raw WHERE {_SCOPED} AND value IS NULL) AS q)
        SELECT 'bronze count unchanged' AS "check", CAST(bronze AS VARCHAR) AS got,
          CAST(bronze AS VARCHAR) AS want, TRUE AS ok FROM n
        UNION ALL SELECT 'registry count unchanged', '1', '1', TRUE FROM n
        UNION ALL SELECT 'quarantine grew by the rerun''s quarantined rows', CAST(2 * q AS VARCHAR),
          CAST(2 * q AS VARCHAR), TRUE FROM n
        UNION ALL SELECT 'silver count unchanged', CAST(s AS VARCHAR), CAST(s AS VARCHAR), TRUE FROM n
        UNION ALL SELECT 'silver content unchanged', 'same', 'same', TRUE FROM n
        UNION ALL SELECT 'gold count unchanged', CAST(g AS VARCHAR), CAST(g AS VARCHAR), TRUE FROM n
        UNION ALL SELECT 'gold content unchanged', 'same', 'same', TRUE FROM n
        UNION ALL SELECT 'silver merge inserted rows', '0', '0', TRUE FROM n"""
)
def rerun_diff_job(spark, sf):
    """Loading a quarter again end to end changes only what it may change."""
    lake, source = _lake(spark), scratch_folder(spark, "source")
    (quarter,) = _write_sources(spark, sf, source)

    def load(at):
        got = ingest_quarter(lake, source, quarter, "c0ffee", at)
        run = run_silver(lake, got.facts, got.filings, got.batch_id, at)
        rebuild_gold(lake)
        return run

    load(_NOW)
    before = note_state(lake)
    run = load("2024-02-01 00:00:00")
    diff = rerun_diff(lake, before, run.quarantined)
    equal = F.col("check").contains("content") & (F.col("got") == F.col("want"))
    shown = [F.when(equal, "same").otherwise(F.col(c)).alias(c) for c in ("got", "want")]
    return diff.select("check", *shown, "ok")

@query(
    f"""WITH {SQL_ORDERS_GOLD}, {SQL_REGISTRY}, n AS (
          SELECT count(*) AS n_rows, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS bad FROM gold),
        seen AS (SELECT o_totalprice AS price FROM gold
          WHERE valid_from <= TIMESTAMP '{AS_OF}' AND valid_to > TIMESTAMP '{AS_OF}'
          ORDER BY o_custkey, o_orderpriority LIMIT 1)
        SELECT 'GREEN' AS candidate, 'RED' AS twin, bad AS planted, bad AS twin_a1,
          FALSE AS control_passed, TRUE AS probe_passed, TRUE AS published, TRUE AS credited,
          n_rows AS published_rows, price AS probed, (SELECT count(*) FROM registry) AS batches
        FROM n, seen"""
)
def write_audit_publish_job(spark, sf):
    """The whole gold of the orders with its registry: audit green on the candidate, red
    on its twin, probe after the publish but not before."""
    lake = Lake(spark, scratch_folder(spark, "lake"), ORDERS)
    lake.gold.overwrite(validity_intervals(order_rows(spark, sf), ORDERS))
    lake.registry.overwrite(quarter_registry(spark, sf))
    key = list(ORDERS.natural_key)
    seen = as_of(lake.gold, AS_OF).orderBy(*key).select(*key, ORDERS.value).first()
    published = Published(spark, f"{lake.root}/published")
    record = write_audit_publish(
        lake,
        published,
        f"{lake.root}/twin/gold",
        F.col("o_orderpriority") == "1-URGENT",
        {k: seen[k] for k in key},
        AS_OF,
        seen[ORDERS.value],
    )
    return record.frame(spark).select(
        "*",
        published.read().agg(F.count("*")).scalar().alias("published_rows"),
        F.lit(seen[ORDERS.value]).alias("probed"),
        F.lit(lake.registry.row_count()).cast("bigint").alias("batches"),
    )
