"""Incremental gold, keyed merges and pruned point reads: same rows, less read."""

import re

import pytest
from helpers import silver_rows
from pyspark.sql import functions as F

from tidemark.catalogue import jobs
from tidemark.model import BATCH_ID, FILED_FACTS, INGEST_TS
from tidemark.operators.intervals import as_of
from tidemark.operators.merge import classify, newer
from tidemark.operators.quality import QualityHalt
from tidemark.plans.gold import rebuild_gold, run_batch
from tidemark.sources.tables import VersionedTable

OLD, NEW = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
KEYS = FILED_FACTS.fact_key


def rows_of(df):
    return sorted(map(str, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def twice(spark, sf):
    return jobs._second_delivery(spark, sf)


def test_increment_equals_the_full_rebuild(spark, twice):
    log = {r["version"]: r for r in twice.gold.commits().collect()}
    assert log[1]["operation"] == "REPLACE" and log[1]["rows"] == twice.gold.row_count()
    found = rows_of(twice.gold.read())
    assert len(found) == twice.gold.row_count()
    before = rows_of(twice.gold.read(0))
    rebuild_gold(twice, full=True)
    assert rows_of(twice.gold.read()) == found
    assert rows_of(twice.gold.read(1)) == found and rows_of(twice.gold.read(0)) == before != found


def _one_more(spark, lake, cik):
    """A batch of one new filing with one fact for one entity."""
    facts = silver_rows(spark, [("zz-1", "T", "v1", 20230331, 1, "USD", "5", NEW)])
    facts = facts.withColumns({"segments": F.lit(None).cast("string"), "coreg": F.lit(None).cast("string")})
    filing = spark.createDataFrame([("zz-1", cik)], "adsh string, cik bigint")
    filing = filing.withColumn("accepted", F.lit("2023-05-01 00:00:00").cast("timestamp_ntz"))
    run_batch(lake, facts.withColumn(INGEST_TS, F.lit(NEW).cast("timestamp_ntz")), filing, "b3", NEW)


def test_only_the_touched_folder_is_written(spark, sf):
    lake = jobs._lake(spark)
    facts, filings = jobs._frames(spark, sf)
    run_batch(lake, facts, filings, "b1", OLD)
    folder = spark.range(1).select(lake.gold.folder_of(F.lit(3).cast("bigint"))).first()[0]
    untouched = [f for f in range(lake.gold.buckets()) if f != folder]
    before = lake.gold.read(folders=untouched)
    files, rows = _files_read(before), rows_of(before)
    _one_more(spark, lake, 3)
    last = lake.gold.commits().orderBy(F.desc("version")).first()
    assert list(last["folders"]) == [folder]
    after = lake.gold.read(folders=untouched)
    assert _files_read(after) == files and rows_of(after) == rows
    (new,) = as_of(lake.gold, "2023-06-01", cik=3, tag="T").collect()
    assert float(new["value"]) == 5.0
    # nothing changed since: the next rebuild writes no row
    rebuild_gold(lake)
    last = lake.gold.commits().orderBy(F.desc("version")).first()
    assert last["operation"] == "LABEL" and last["rows"] == lake.gold.read().count()


def test_a_filing_that_comes_later_brings_its_facts(spark, sf):
    lake = jobs._lake(spark)
    facts, filings = jobs._frames(spark, sf)
    run_batch(lake, facts, filings.filter("cik % 2 = 0"), "b1", OLD)
    none = facts.limit(0)
    again = facts.limit(1).withColumn(INGEST_TS, F.lit(NEW).cast("timestamp_ntz"))
    assert none.isEmpty()
    run_batch(lake, again, filings, "b2", NEW, share=1.0)
    found = rows_of(lake.gold.read())
    rebuild_gold(lake, full=True)
    assert rows_of(lake.gold.read()) == found


def test_a_batch_is_read_twice_and_refused_before_it_shows(spark, sf, monkeypatch):
    lake = jobs._lake(spark)
    facts, filings = jobs._frames(spark, sf)
    written = []
    part = VersionedTable._write_part
    monkeypatch.setattr(
        VersionedTable,
        "_write_part",
        lambda t, log, rows: (written.append((t.root, plan_of(rows))), part(t, log, rows))[1],
    )
    run_batch(lake, facts, filings, "b1", OLD)
    assert lake.silver.read().columns == [*FILED_FACTS.fact_types, INGEST_TS, BATCH_ID]
    scans = [p.count("lineitem") for root, p in written if root.endswith(("silver", "quarantine/rows"))]
    assert scans == [1, 1]
    twice_sent = facts.filter("tag = 'A'").unionByName(facts.filter("tag = 'A'"))
    before = rows_of(lake.silver.read())
    with pytest.raises(QualityHalt, match="uniqueness"):
        run_batch(lake, twice_sent.withColumn(INGEST_TS, F.lit(NEW).cast("timestamp_ntz")), filings, "b2", NEW)
    assert lake.silver.refresh().latest_version() == 0 and rows_of(lake.silver.read()) == before
    for at in ("2024-03-01 00:00:00", "2024-04-01 00:00:00"):  # and later batches merge as before
        again = facts.filter("tag = 'A'").withColumn(INGEST_TS, F.lit(at).cast("timestamp_ntz"))
        run_batch(lake, again, filings, "b3", at)
    assert lake.silver.latest_version() == 2 and lake.silver.row_count() == len(before)
    assert rows_of(lake.silver.read(0)) == before
    (detail,) = lake.quarantine_detail.read().collect()
    valid = facts.filter("tag = 'A' and segments is null and coreg is null and value is not null").count()
    assert (detail["constraint"], detail["violations"]) == ("uniqueness", valid)


def test_gold_is_rebuilt_whole_when_the_log_cannot_tell(spark, twice):
    twice.silver.compact()
    assert twice.silver.changed_since(0) is None
    found = rows_of(twice.gold.read())
    rebuild_gold(twice)
    last = twice.gold.commits().orderBy(F.desc("version")).first()
    assert last["replaces"] and rows_of(twice.gold.read()) == found


def test_one_entity_opens_one_folder(spark, twice):
    whole = twice.gold.read()
    point = as_of(twice.gold, "1999-01-01", cik=7)
    assert rows_of(point) == rows_of(as_of(whole, "1999-01-01", cik=7)) != []
    folders = lambda df: {re.search(r"/b=(\d+)/", f).group(1) for f in _files_read(df)}
    assert len(folders(twice.gold.read(near={"cik": 7}))) == 1 < len(folders(whole))
    # the folder is known when the scan is planned, so no other file is opened
    assert re.search(r"PartitionFilters: \[[^\]]*b#\d+ = \d+", plan_of(point))


def _files_read(df):
    """Files whose rows come out of a scan."""
    return {r["f"] for r in df.select(F.input_file_name().alias("f")).distinct().collect()}


def test_a_keyed_merge_moves_no_row_of_the_table(spark, tmp_path, monkeypatch):
    t = VersionedTable(spark, str(tmp_path / "t"), keyed=KEYS, buckets=3)
    row = lambda a, v, at: (a, "T", "v1", 20230331, 1, "USD", v, at)
    t.merge(silver_rows(spark, [row(f"a{i}", "1", OLD) for i in range(20)]), KEYS, newer(), [INGEST_TS])
    batch = silver_rows(spark, [row("a1", "9", NEW), row("b", "3", NEW)])
    monkeypatch.setattr("tidemark.sources.tables.PRUNE_VALUES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(classify(batch, t.read(), KEYS, newer(), [INGEST_TS]))
        t.merge(batch, KEYS, newer(), [INGEST_TS], prune_by="adsh")
        again = plan_of(t.read())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert "Exchange" not in again and "LeftAnti" in again
    got = {r["adsh"]: float(r["value"]) for r in t.read().collect()}
    assert got == {f"a{i}": 1.0 for i in range(20)} | {"a1": 9.0, "b": 3.0}
    assert t.read(0).count() == 20 and t.row_count() == 21
    # another session's object finds the layout in the log
    other = VersionedTable(spark, str(tmp_path / "t"))
    assert rows_of(other.read()) == rows_of(t.read()) and other.buckets() == 3
