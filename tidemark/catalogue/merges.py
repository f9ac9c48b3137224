"""Merge, versioned-table and registry queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalogue.base import SQL_REGISTRY, quarter_registry, query, table, text
from tidemark.model import BATCH_ID, INGEST_TS, ROW_HASH, instant
from tidemark.functions.frames import one_row
from tidemark.functions.hashing import row_hash
from tidemark.operators.merge import (
    ambiguous_keys,
    classify,
    insert_only,
    merge_metrics,
    newer,
    upsert,
)
from tidemark.plans.lake import REGISTRY_SCHEMA, BatchRecord, Lake
from tidemark.session import scratch_folder
from tidemark.sources.tables import VersionedTable

_KEY = ["o_orderkey"]
_T0, _T1, _OLD = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2023-12-01 00:00:00"
_NAMES = ("o_orderkey", "o_custkey", "o_totalprice")


def _target(spark, sf):
    """Orders before 1998, loaded at T0."""
    o = table(spark, sf, "orders").filter(F.col("o_orderdate") < instant("1998-01-01 00:00:00"))
    return o.select(*_NAMES).withColumn(INGEST_TS, instant(_T0))


def _batch(spark, sf):
    """Orders from 1997 on: 1997 resent with another price, later ones new.

    Resent rows are newer, equally old or older by order status.
    """
    o = table(spark, sf, "orders").filter(F.col("o_orderdate") >= instant("1997-01-01 00:00:00"))
    loaded = (
        F.when(F.col("o_orderstatus") == "P", instant(_T1))
        .when(F.col("o_orderstatus") == "O", instant(_T0))
        .otherwise(instant(_OLD))
    )
    return o.select(
        "o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice"),
        loaded.alias(INGEST_TS),
    )


def _show(df):
    return df.select(*_NAMES, text(INGEST_TS).alias(INGEST_TS))


_SQL_SIDES = f"""target AS (SELECT o_orderkey, o_custkey, o_totalprice,
    TIMESTAMP '{_T0}' AS _ingest_ts FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
  batch AS (SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice,
    CASE o_orderstatus WHEN 'P' THEN TIMESTAMP '{_T1}' WHEN 'O' THEN TIMESTAMP '{_T0}'
         ELSE TIMESTAMP '{_OLD}' END AS _ingest_ts
    FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')"""
_OUT = "o_orderkey, o_custkey, o_totalprice, CAST(_ingest_ts AS VARCHAR) AS _ingest_ts"
_FRESH = "SELECT * FROM batch WHERE o_orderkey NOT IN (SELECT o_orderkey FROM target)"


def _sql_upsert(condition: str) -> str:
    return f"""WITH {_SQL_SIDES}, merged AS (
      SELECT t.o_orderkey,
        CASE WHEN {condition} THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
        CASE WHEN {condition} THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
        CASE WHEN {condition} THEN s._ingest_ts ELSE t._ingest_ts END AS _ingest_ts
      FROM target t LEFT JOIN batch s ON t.o_orderkey = s.o_orderkey
      UNION ALL {_FRESH}) SELECT {_OUT} FROM merged"""


@query(f"WITH {_SQL_SIDES} SELECT {_OUT} FROM (SELECT * FROM target UNION ALL {_FRESH})")
def merge_insert_only(spark, sf):
    return _show(insert_only(_target(spark, sf), _batch(spark, sf), _KEY))


@query(_sql_upsert("s._ingest_ts > t._ingest_ts"))
def merge_latest_wins(spark, sf):
    return _show(upsert(_target(spark, sf), _batch(spark, sf), _KEY, newer()))


@query(_sql_upsert("s.o_orderkey IS NOT NULL"))
def merge_always(spark, sf):
    return _show(upsert(_target(spark, sf), _batch(spark, sf), _KEY))


@query(
    f"""WITH {_SQL_SIDES},
      t AS (SELECT CASE WHEN o_totalprice < 100000 THEN NULL ELSE o_orderkey END AS k,
                   o_orderkey AS row_id, 'target' AS origin FROM target),
      s AS (SELECT CASE WHEN o_totalprice - 1 < 100000 THEN NULL ELSE o_orderkey END AS k,
                   o_orderkey AS row_id, 'batch' AS origin FROM batch)
      SELECT t.k, t.row_id, coalesce(s.origin, t.origin) AS origin
        FROM t LEFT JOIN s ON t.k = s.k
      UNION ALL SELECT k, row_id, origin FROM s
        WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.k = s.k)"""
)
def merge_null_keys(spark, sf):
    """Rows without a key never match: they stay, or are inserted."""

    def keyed(df, price, origin):
        k = F.when(price >= 100000, F.col("o_orderkey"))
        return df.select(k.alias("k"), F.col("o_orderkey").alias("row_id"), F.lit(origin).alias("origin"))

    target = keyed(_target(spark, sf), F.col("o_totalprice"), "target")
    batch = keyed(_batch(spark, sf), F.col("o_totalprice") - 1, "batch")
    return upsert(target, batch, ["k"])


@query(
    f"""WITH {_SQL_SIDES}, hits AS (
      SELECT s._ingest_ts > t._ingest_ts AS newer, t.o_orderkey AS hit
      FROM batch s LEFT JOIN target t ON s.o_orderkey = t.o_orderkey)
    SELECT count(*) AS num_source, count(*) FILTER (WHERE hit IS NULL) AS num_inserted,
      count(*) FILTER (WHERE newer) AS num_updated,
      count(*) FILTER (WHERE hit IS NOT NULL AND NOT newer) AS dedupe FROM hits"""
)
def merge_counts(spark, sf):
    return merge_metrics(
        classify(_batch(spark, sf), _target(spark, sf), _KEY, newer(), [INGEST_TS])
    )


@query(
    """SELECT l_orderkey, count(*) AS n_source FROM lineitem
       WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
       GROUP BY l_orderkey HAVING count(*) > 1"""
)
def merge_ambiguous(spark, sf):
    """Keys for which a merge must be refused: many source rows, one target row."""
    source = table(spark, sf, "lineitem").select("l_orderkey")
    pending = table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    return ambiguous_keys(source, pending.select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"])


# -- versioned tables ----------------------------------------------------------


def _merged_table(spark, sf) -> VersionedTable:
    """Version 0 is the target, version 1 the merged batch, version 2 a resend."""
    t = VersionedTable(spark, scratch_folder(spark, "table"))
    t.overwrite(_target(spark, sf), label="first")
    for label in ("second", "second"):
        t.merge(_batch(spark, sf), _KEY, newer(), compare=[INGEST_TS], label=label)
    return t


@query(_sql_upsert("s._ingest_ts > t._ingest_ts"))
def table_latest(spark, sf):
    return _show(_merged_table(spark, sf).read())


@query(f"WITH {_SQL_SIDES} SELECT {_OUT} FROM target")
def table_time_travel(spark, sf):
    return _show(_merged_table(spark, sf).read(version=0))


@query(
    f"""WITH {_SQL_SIDES}, n AS (SELECT (SELECT count(*) FROM target) AS t,
        (SELECT count(*) FROM batch) AS s,
        (SELECT count(*) FROM batch WHERE o_orderkey NOT IN (SELECT o_orderkey FROM target)) AS i,
        (SELECT count(*) FROM batch s JOIN target t ON s.o_orderkey = t.o_orderkey
          WHERE s._ingest_ts > t._ingest_ts) AS u)
    SELECT CAST(0 AS BIGINT) AS version, 'WRITE' AS operation, t AS num_source,
      t AS num_inserted, CAST(0 AS BIGINT) AS num_updated, t AS rows FROM n
    UNION ALL SELECT 1, 'MERGE', s, i, u, t + i FROM n
    UNION ALL SELECT 2, 'MERGE', s, 0, 0, t + i FROM n"""
)
def table_commits(spark, sf):
    return (
        _merged_table(spark, sf)
        .commits()
        .select("version", "operation", "num_source", "num_inserted", "num_updated", "rows")
    )


@query(
    """SELECT o_orderstatus, 2 * count(*) AS n FROM orders GROUP BY o_orderstatus"""
)
def append_lane(spark, sf):
    """An append lane is an audit log: a rerun adds its rows again."""
    lane = VersionedTable(spark, scratch_folder(spark, "lane"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    lane.append(orders)
    lane.append(orders)
    lane.append(orders.filter("o_orderkey < 0"))  # empty: adds no version
    return lane.read().groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query(
    """SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS accepted, 'b1' AS batch FROM orders
       WHERE o_orderstatus <> 'O'"""
)
def batch_replay(spark, sf):
    """One batch's rows at its recorded version, after another batch and a rerun."""
    lake = Lake(spark, scratch_folder(spark, "lake"))
    orders = table(spark, sf, "orders")
    hashed = ["o_orderkey", "o_orderdate"]

    def load(batch, which):
        rows = orders.filter(which).select(*hashed)
        rows = rows.withColumns({BATCH_ID: F.lit(batch), ROW_HASH: row_hash(hashed)})
        version = lake.bronze_facts.insert_new(
            rows, [BATCH_ID, ROW_HASH], within=F.col(BATCH_ID) == batch, label=batch
        )
        lake.register(BatchRecord(batch, "{}", version))

    is_open = F.col("o_orderstatus") == "O"
    for batch, which in (("b1", ~is_open), ("b2", is_open), ("b1", ~is_open)):
        load(batch, which)
    return lake.replay("b1").select(
        "o_orderkey", text("o_orderdate").alias("accepted"), F.col(BATCH_ID).alias("batch")
    )


@query(
    f"""WITH {SQL_REGISTRY} SELECT batch_id, manifest_json,
        CASE WHEN batch_id < 'b-1998' THEN delta_version + 1 ELSE delta_version END
          AS delta_version FROM registry"""
)
def registry_upsert(spark, sf):
    """Registering batches again moves their version and adds no row."""
    registry = VersionedTable(spark, scratch_folder(spark, "registry"))
    batches = quarter_registry(spark, sf)
    registry.merge(batches, ["batch_id"])
    early = batches.filter("batch_id < 'b-1998'")
    registry.merge(early.withColumn("delta_version", F.col("delta_version") + 1), ["batch_id"])
    return registry.read()


@query(
    f"""WITH {SQL_REGISTRY} SELECT batch_id, manifest_json, delta_version FROM registry
        WHERE batch_id = 'b-1998q2'"""
)
def registry_lookup(spark, sf):
    """One batch by id: the manifest and version recorded for it."""
    lake = Lake(spark, scratch_folder(spark, "lake"))
    lake.registry.merge(quarter_registry(spark, sf), ["batch_id"])
    found = lake.lookup("b-1998q2")
    return one_row(
        spark, (found.batch_id, found.manifest_json, found.delta_version), REGISTRY_SCHEMA
    )


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS adsh, o_custkey AS cik,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' AND o_orderdate >= TIMESTAMP '1997-01-01'
            THEN 'second' ELSE CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'first'
            ELSE 'second' END END AS seen_in FROM orders"""
)
def merge_filing_index(spark, sf):
    """The filing index grows batch by batch and keeps one row per filing."""
    o = table(spark, sf, "orders").select(
        text("o_orderkey").alias("adsh"), F.col("o_custkey").alias("cik"), "o_orderdate"
    )
    first = o.filter(F.col("o_orderdate") < instant("1998-01-01 00:00:00"))
    second = o.filter(F.col("o_orderdate") >= instant("1997-01-01 00:00:00"))

    def loaded(df, label, at):
        stamped = df.withColumns({"seen_in": F.lit(label), INGEST_TS: instant(at)})
        return stamped.drop("o_orderdate")

    index = VersionedTable(spark, scratch_folder(spark, "index"))
    index.merge(loaded(first, "first", _T0), ["adsh"], newer(), compare=[INGEST_TS])
    index.merge(loaded(second, "second", _T1), ["adsh"], newer(), compare=[INGEST_TS])
    return index.read().select("adsh", "cik", "seen_in")
