"""What jobs move and write: shared steps run once, rows stay where they are dealt."""

import glob

from pyspark.sql import functions as F

from tidemark.catalogue import base, jobs, verify
from tidemark.operators.merge import newer
from tidemark.plans.gold import _respliced, run_batch
from tidemark.plans.lake import Lake
from tidemark.sources import tables
from tidemark.sources.tables import VersionedTable
from tidemark.session import unsorted_writes
from tests.helpers import T1, T2, Filing, facts_frame, filings_frame, load

ROWS = "adsh string, part string, value int, _ingest_ts timestamp_ntz"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def at(spark, rows, day):
    stamp = F.lit(f"2024-01-0{day}").cast("timestamp_ntz")
    return spark.createDataFrame(rows, "adsh string, part string, value int").withColumn("_ingest_ts", stamp)


def test_metrics_join_facts_and_filings_once(spark, sf, monkeypatch):
    joined = []
    monkeypatch.setattr(verify, "batched_facts", lambda *a: (joined.append(1), base.batched_facts(*a))[1])
    assert verify.logged_vs_recomputed(spark, sf).count()
    assert len(joined) == 1


def test_rows_sent_again_are_told_without_moving_them(spark, tmp_path, monkeypatch):
    t = VersionedTable(spark, str(tmp_path / "t"))
    rows = at(spark, [("a", "x", 1), ("a", "x", 1), ("b", "y", 2)], 1)
    t.insert_new(rows, ["adsh", "part"])
    with monkeypatch.context() as m:
        m.setattr(tables, "unmatched", None)  # the join is not even planned
        t.insert_new(rows, ["adsh", "part"])
    last = t.commits().orderBy(F.desc("version")).first()
    assert (last["num_source"], last["num_inserted"], t.row_count()) == (3, 0, 3)
    t.insert_new(rows.limit(1).unionByName(at(spark, [("c", "z", 3)], 1)), ["adsh", "part"])
    assert t.row_count() == 4
    t.insert_new(at(spark, [("d", None, 4)], 1), ["adsh", "part"])
    t.insert_new(at(spark, [("d", None, 4)], 1), ["adsh", "part"])  # matches nothing
    assert t.row_count() == 6


def test_quarters_are_written_by_one_join(spark, sf, tmp_path, monkeypatch):
    joined = []
    monkeypatch.setattr(jobs, "filed_facts", lambda *a: (joined.append(1), base.filed_facts(*a))[1])
    quarter = F.when(F.col("accepted") < "1997", "q1").when(F.col("adsh") == "1", "q2").otherwise("q3")
    drop = lambda f: f.filter("_q != 'q3'")  # noqa: E731 -- a quarter with filings alone
    quarters = jobs._write_sources(spark, sf, str(tmp_path), quarter, drop)
    assert len(joined) == 1 and "q3" in quarters
    assert all(glob.glob(f"{tmp_path}/{q}/{n}.txt/*.csv.gz") for q in quarters for n in ("num", "sub"))
    read = lambda q: spark.read.csv(f"{tmp_path}/{q}/num.txt", header=True, sep="\t")
    assert read("q3").count() == 0 and read("q3").columns == read("q1").columns
    wanted = base.raw_facts(spark, sf).join(
        base.raw_filings(spark, sf).filter("accepted < '1997'").select("adsh"), "adsh"
    )
    assert sorted(map(str, read("q1").collect())) == sorted(map(str, wanted.select(read("q1").columns).collect()))


def test_merges_by_more_than_the_bucket_key_move_no_stored_row(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), keyed=("adsh",), buckets=3)
    merge = lambda rows, day: t.merge(
        at(spark, rows, day), ["adsh", "part"], newer(), compare=["_ingest_ts"], source_unique=True,
        watch=lambda nth: [F.count(F.lit(1)).alias("rows")], accept=lambda seen: None,
    )
    merge([("a", "x", 1), ("a", "y", 2), ("b", None, 3)], 2)
    merge([("a", "x", 9), ("b", None, 4), ("c", "z", 5)], 3)
    merge([("a", "y", 7)], 1)  # older: changes nothing
    found = sorted((r["adsh"], r["part"] or "", r["value"]) for r in t.read().collect())
    assert found == [("a", "x", 9), ("a", "y", 2), ("b", "", 3), ("b", "", 4), ("c", "z", 5)]
    assert t.has_updates() and "Exchange" not in plan_of(t.read())


def test_gold_moves_once_behind_its_join(spark, tmp_path, monkeypatch):
    lake, written = Lake(spark, str(tmp_path / "lake")), []
    part = VersionedTable._write_part
    monkeypatch.setattr(
        VersionedTable, "_write_part", lambda t, log, r: (written.append((t.root, plan_of(r))), part(t, log, r))[1]
    )
    load(lake, "b1", [Filing("f1", 1, "A", "1", T1), Filing("f2", 1, "A", "2", T2), Filing("f3", 2, "B", "3", T1)])
    (plan,) = [p for root, p in written if root.endswith("/gold")]
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Exchange rebalance" in line]
    assert len([m for m in moves if "hashpartitioning(adsh" not in m]) == 1
    ends = {r["adsh"]: str(r["valid_to"])[:10] for r in lake.gold.read().collect()}
    assert ends == {"f1": T2[:10], "f2": "9999-12-31", "f3": "9999-12-31"}


def test_tables_get_buckets_for_their_first_batch(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    monkeypatch.setattr(tables, "BUCKET_ROWS", 3)
    facts = [Filing(f"f{i}", i, "A", str(i), T1) for i in range(25)]
    load(lake, "b1", facts)
    load(lake, "b2", [Filing("f3", 3, "A", "9", T1, ingest="2023-06-01 00:00:00"), Filing("g", 77, "B", "1", T2)])
    for t in (lake.silver, lake.filing_index, lake.gold):  # as the log has it, for another session too
        assert t.buckets() == VersionedTable(spark, t.root).buckets() == 9 > 4
    found = {r["adsh"]: int(r["value"]) for r in lake.gold.read().collect()}
    assert found == {f"f{i}": i for i in range(25)} | {"f3": 9, "g": 1}
    joined = lake.silver.read().join(lake.filing_index.read(), "adsh").hint("merge")
    assert "Exchange hashpartitioning" not in plan_of(joined)
    refused = VersionedTable(spark, str(tmp_path / "t"))
    refused.size_for(2)
    assert refused.buckets() == 4  # never fewer than the session has


def test_large_joins_and_few_folders_need_no_large_sort(spark, sf, tmp_path, monkeypatch):
    plain = sorted(map(str, base.filed_facts(spark, sf, base.raw_filings(spark, sf).select("adsh", "cik")).collect()))
    monkeypatch.setattr(base, "JOIN_ROWS", 500)
    facts = base.filed_facts(spark, sf, base.raw_filings(spark, sf).select("adsh", "cik"))
    tasks = -(-base.table(spark, sf, "lineitem").count() // 500)
    assert tasks > 4 and plan_of(facts).count(f"{tasks}), REPARTITION_BY_NUM") == 2
    assert sorted(map(str, facts.collect())) == plain
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    with unsorted_writes(spark):
        assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") != "0"
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_a_splice_moves_gold_once(spark, tmp_path, monkeypatch):
    plans = []
    monkeypatch.setattr(
        "tidemark.plans.gold._respliced",
        lambda *a: (rows := _respliced(*a), plans.append(plan_of(rows)))[0],
    )
    lake = Lake(spark, str(tmp_path / "lake"))
    load(lake, "b1", [Filing("f1", 1, "A", "1", T1), Filing("f2", 1, "A", "2", T2), Filing("f3", 2, "B", "3", T1)])
    facts = [Filing("f1", 5, "A", "7", T1, ingest=T2), Filing("f4", 1, "A", "4", "2023-09-01 00:00:00", ingest=T2)]
    run_batch(
        lake, facts_frame(spark, facts).withColumn("_batch_id", F.lit("b2")), filings_frame(spark, facts), "b2", T2, share=1.0
    )  # f1 is corrected and moves to another entity
    (plan,) = plans
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(cik") == 1
    found = sorted((r["cik"], r["adsh"], int(r["value"]), str(r["valid_to"])[:10]) for r in lake.gold.read().collect())
    assert found == [
        (1, "f2", 2, "2023-09-01"), (1, "f4", 4, "9999-12-31"), (2, "f3", 3, "9999-12-31"), (5, "f1", 7, "9999-12-31")
    ]
