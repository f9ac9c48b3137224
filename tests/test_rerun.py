"""A batch sent again: each pass over the tables does no more than it has to."""

import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions.hashing import content_fingerprint, exact_sum
from tidemark.model import BATCH_ID, ROW_HASH
from tidemark.operators.merge import classify_in_place, newer
from tidemark.plans.gold import rebuild_gold, run_batch
from tidemark.plans.lake import Lake
from tidemark.sources import tables
from tidemark.sources.tables import VersionedTable
from tests.helpers import T1, T2, Filing, facts_frame, filings_frame, load

LATER, LAST = "2023-06-01 00:00:00", "2023-07-01 00:00:00"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df):
    return sorted(map(str, df.collect()))


def sent(at="2023-05-02 00:00:00", value="1"):
    return [Filing(f"f{i}", i % 3, "A", value, T1, ingest=at) for i in range(8)]


def test_a_merge_that_supersedes_every_row_replaces_the_table(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    load(lake, "b1", sent())
    old = rows_of(lake.silver.read())
    load(lake, "b2", [*sent(LATER, "2"), Filing("g", 1, "A", "3", T2, ingest=LATER)])
    log = {r["version"]: r for r in lake.silver.commits().collect()}
    assert {v: r["operation"] for v, r in log.items()} == {0: "WRITE", 1: "MERGE"}  # not written once more
    assert (log[1]["num_updated"], log[1]["num_inserted"], log[1]["replaces"]) == (8, 1, True)
    assert not lake.silver.has_updates() and "Window" not in plan_of(lake.silver.read())
    assert rows_of(lake.silver.read(0)) == old
    changed = lake.silver.changed_since(0)  # all rows are new
    assert rows_of(changed) == rows_of(lake.silver.read()) and changed.count() == 9 == lake.silver.row_count()
    found = rows_of(lake.gold.read())
    rebuild_gold(lake, full=True)
    assert rows_of(lake.gold.read()) == found and len(found) == 9
    load(lake, "b3", sent(LAST, "4")[:2])  # and later updates supersede rows of the merge
    values = {r["adsh"]: int(r["value"]) for r in lake.silver.read().collect()}
    assert values == {f"f{i}": 4 if i < 2 else 2 for i in range(8)} | {"g": 3}
    assert not log[0]["num_updated"] and lake.silver.superseded_rows() == 2


def test_a_table_is_written_again_once_half_of_it_is_superseded(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    load(lake, "b1", sent())
    seen = []
    for n, day in enumerate(("06-01", "07-01", "08-01"), 2):
        load(lake, f"b{n}", sent(f"2023-{day} 00:00:00", str(n))[:3])
        seen.append((lake.silver.superseded_rows(), lake.silver.latest_version()))
        values = {r["adsh"]: int(r["value"]) for r in lake.gold.read().collect()}
        assert values == {f"f{i}": n if i < 3 else 1 for i in range(8)}
    assert seen == [(3, 1), (6, 2), (0, 4)]  # 9 of 17 stored rows


def test_a_merge_in_place_numbers_and_matches_by_one_sort(spark, tmp_path):
    ddl = "adsh string, part string, value int, _ingest_ts int"
    at = lambda rows: spark.createDataFrame(rows, ddl).repartition(3, "adsh")
    source = at([("a", "x", 1, 2), ("a", "x", 2, 2), ("a", "y", 3, 0), ("b", None, 4, 2), ("b", None, 5, 2)])
    target = at([("a", "x", 0, 1), ("a", "y", 0, 1), ("b", None, 0, 1)])
    got = classify_in_place(source, target, ["adsh", "part"], newer(), ["_ingest_ts"], "n")
    assert plan_of(got).count("Sort [") == 1
    found = {(r["adsh"], r["part"], r["value"]): (r["n"], r["op"]) for r in got.collect()}
    assert sorted(found) == [("a", "x", 1), ("a", "x", 2), ("a", "y", 3), ("b", None, 4), ("b", None, 5)]
    assert {k[1]: {v[1] for j, v in found.items() if j[1] == k[1]} for k in found} == {
        "x": {"update"}, "y": {"noop"}, None: {"insert"}
    }
    assert sorted(v[0] for v in found.values()) == [1, 1, 1, 2, 2] and found["a", "y", 3][0] == 1


def test_the_links_of_a_batch_are_not_counted_by_a_pass_of_their_own(spark, tmp_path, monkeypatch):
    lake, told = Lake(spark, str(tmp_path / "lake")), []
    only = tables._only_values_of
    monkeypatch.setattr(tables, "_only_values_of", lambda *a: (told.append(a[2:]), only(*a))[1])
    monkeypatch.setattr(tables, "PRUNE_VALUES", 4)
    load(lake, "b1", sent())
    load(lake, "b2", sent(LATER, "2"))  # many links
    load(lake, "b3", sent(LAST, "3")[:2])  # few
    assert [a for a in told if a[0] == "adsh"] == [("adsh", False, n) for n in (8, 8, 2, 2)]
    assert {r["adsh"]: int(r["value"]) for r in lake.gold.read().collect()} == {
        f"f{i}": 3 if i < 2 else 2 for i in range(8)
    }
    twice = [*sent("2023-08-01 00:00:00")[:1]] * 2
    facts = facts_frame(spark, twice[:1]).withColumn(BATCH_ID, F.lit("b4"))
    filings = filings_frame(spark, twice).unionAll(filings_frame(spark, twice))
    try:
        run_batch(lake, facts, filings, "b4", "2023-08-01 00:00:00")
    except Exception as e:
        assert "uniqueness" in str(e)
    (detail,) = lake.quarantine_detail.read().collect()  # repeated filings are still told
    assert (detail["target"], detail["violations"]) == ("adsh", 1)


def test_gold_is_written_in_the_order_of_its_window(spark, tmp_path, monkeypatch):
    lake, written = Lake(spark, str(tmp_path / "lake")), []
    part = VersionedTable._write_part
    monkeypatch.setattr(
        VersionedTable, "_write_part", lambda t, log, r: (written.append((t.root, plan_of(
            r.sortWithinPartitions(*t._sorted_by(r.drop("b"))) if t.split_by else r))), part(t, log, r))[1]
    )
    load(lake, "b1", sent())
    (plan,) = [p for root, p in written if root.endswith("/gold")]
    assert plan.count("Sort [cik") == 1  # that of the window
    files = lake.gold.read().select("cik", "adsh", F.input_file_name().alias("f")).collect()
    for f in {r["f"] for r in files}:
        assert (ciks := [r["cik"] for r in files if r["f"] == f]) == sorted(ciks)


def test_sums_and_prints_are_exact(spark):
    numbers = [0, 5, 2**59 + 12345, 2**60 - 1, -1, None, -(2**63), 2**63 - 1]
    df = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    total = sum(n % 2**64 for n in numbers if n is not None)
    assert df.agg(exact_sum(F.col("n"))).first()[0] == Decimal(total)
    assert df.limit(0).agg(exact_sum(F.col("n"))).first()[0] is None
    rows = [("a", None, Decimal("1.50")), ("", "1:b", None), ("é:", "N", Decimal("0.00")), (None, None, None)]
    df = spark.createDataFrame(rows, "a string, b string, c decimal(9,2)")
    code = lambda v: "N" if v is None else f"{len(str(v))}:{v}"
    bits = [int(hashlib.sha256("".join(map(code, r)).encode()).hexdigest()[:15], 16) for r in rows]
    got = content_fingerprint(df).first()
    assert (got["n_rows"], got["content_hash"]) == (4, str(sum(bits)))
    assert tuple(content_fingerprint(df.limit(0)).first()) == (0, "0")


def test_a_row_hash_is_not_hashed_again_to_tell_a_resend(spark, tmp_path, monkeypatch):
    t, keys = VersionedTable(spark, str(tmp_path / "t")), [BATCH_ID, ROW_HASH]
    rows = spark.createDataFrame([("b", "x"), ("b", "y"), ("b", "y")], f"{BATCH_ID} string, {ROW_HASH} string")
    t.insert_new(rows, keys)
    with monkeypatch.context() as m:
        m.setattr(tables, "row_hash", None)
        m.setattr(tables, "unmatched", None)
        t.insert_new(rows, keys)
    assert t.row_count() == 3
    t.insert_new(rows.distinct(), keys)  # other counts, the same keys
    t.insert_new(spark.createDataFrame([("b", "x"), ("b", "x"), ("b", "z")], rows.schema), keys)
    assert rows_of(t.read()) == rows_of(rows.unionAll(spark.createDataFrame([("b", "z")], rows.schema)))
