"""Files to gold: ingest, rerun, backfill, replay, publish."""

import os

import pytest
from helpers import T1, T2, Filing, load
from pyspark.sql import functions as F

from tidemark.functions.hashing import canonical_json, row_hash
from tidemark.functions.identity import (
    batch_manifest,
    manifest_entries,
    schema_fingerprint,
    with_batch_identity,
)
from tidemark.model import FILED_FACTS
from tidemark.operators.audit import run_audit
from tidemark.operators.compare import note_state, rerun_diff
from tidemark.operators.intervals import as_of
from tidemark.operators.recompute import conservation_findings, logged_mismatches, metrics_table
from tidemark.operators.twins import (
    TwinRefused,
    lookahead_twin,
    null_twin,
    require_twin_destination,
    seeded_sample,
)
from tidemark.plans.backfill import Ledger, backfill
from tidemark.plans.gold import rebuild_gold
from tidemark.plans.ingest import ingest_quarter
from tidemark.plans.lake import Lake
from tidemark.plans.publish import Published, write_audit_publish
from tidemark.plans.silver import run_silver
from tidemark.sources.delimited import scan_declared, source_digests
from tidemark.sources.logs import parse_run_lines

NUM = "adsh\ttag\tversion\tddate\tqtrs\tuom\tsegments\tcoreg\tvalue\n"
SUB = "adsh\tcik\tname\tform\tperiod\tfy\tfp\tfiled\taccepted\n"


def _sub(adsh, cik, accepted):
    return f"{adsh}\t{cik}\tACME\t10-Q\t20230331\t2023\tQ1\t20230501\t{accepted}\n"


def _write(root, quarter, num_rows, sub_rows, header=NUM):
    folder = root / quarter
    os.makedirs(folder)
    (folder / "num.txt").write_text(header + "".join(num_rows))
    (folder / "sub.txt").write_text(SUB + "".join(sub_rows))


@pytest.fixture
def source(tmp_path):
    root = tmp_path / "source"
    _write(
        root,
        "2023q1",
        [
            "a1\tRevenues\tv1\t20230331\t1\tUSD\t\t\t100.5\n",
            "a1\tRevenues\tv1\t20230331\t1\tUSD\tLine=X\t\t7\n",
            "a1\tNotes\tv1\t20230331\t1\tUSD\t\t\t\n",
        ],
        [_sub("a1", 1, f"{T1}.0")],
    )
    _write(
        root,
        "2023q2",
        ["a2\tRevenues\tv1\t20230331\t1\tUSD\t\t\t150\n"],
        [_sub("a2", 1, T2)],
    )
    dup = "a3\tRevenues\tv1\t20230331\t1\tUSD\t\t\t{}\n"
    _write(root, "2023q3", [dup.format(1), dup.format(2)], [_sub("a3", 1, T2)])
    _write(root, "2023q4", [], [_sub("a4", 1, T2)])
    return str(root)


def _lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def _load(lake, source, quarter, at="2024-01-01 00:00:00"):
    got = ingest_quarter(lake, source, quarter, "c0ffee", at)
    return got, run_silver(lake, got.facts, got.filings, got.batch_id, at)


def test_files_to_gold_and_idempotent_reload(spark, tmp_path, source):
    lake = _lake(spark, tmp_path)
    got, run = _load(lake, source, "2023q1")
    rebuild_gold(lake)
    assert (run.rows_in, run.scoped_out, run.quarantined, run.rows_out) == (3, 1, 1, 1)
    (row,) = as_of(lake.gold.read(), "2023-06-01").collect()
    assert (row["cik"], float(row["value"]), row["adsh"]) == (1, 100.5, "a1")

    before = note_state(lake)
    again, rerun = _load(lake, source, "2023q1", "2024-02-01 00:00:00")
    rebuild_gold(lake)
    assert again.batch_id == got.batch_id
    assert lake.bronze_facts.read().count() == 3 and lake.registry.read().count() == 1
    diff = rerun_diff(lake, before, rerun.quarantined)
    assert [r["check"] for r in diff.collect() if not r["ok"]] == []
    # The resend refreshed the load time and nothing else.
    merges = lake.silver.commits().filter("operation = 'MERGE'")
    commit = merges.orderBy(F.desc("version")).first()
    assert (commit["num_inserted"], commit["num_updated"]) == (0, 1)
    assert not lake.silver.has_updates()  # the rebuild compacted the table


def test_rerun_diff_reports_changes(spark, tmp_path, source):
    lake = _lake(spark, tmp_path)
    _load(lake, source, "2023q1")
    rebuild_gold(lake)
    before = note_state(lake)
    _load(lake, source, "2023q2")
    rebuild_gold(lake)
    failed = {r["check"] for r in rerun_diff(lake, before, 0).collect() if not r["ok"]}
    assert "silver content unchanged" in failed and "gold count unchanged" in failed


def test_replay_returns_the_registered_batch(spark, tmp_path, source):
    lake = _lake(spark, tmp_path)
    first, _ = _load(lake, source, "2023q1")
    _load(lake, source, "2023q2")
    assert lake.replay(first.batch_id).count() == 3
    assert lake.lookup("nope") is None
    with pytest.raises(LookupError):
        lake.replay("nope")


def test_backfill_records_halts_and_resumes(spark, tmp_path, source):
    lake = _lake(spark, tmp_path)
    quarters = ["2023q3", "2023q1", "2023q4", "2023q2"]
    status = {r["quarter"]: r["status"] for r in backfill(lake, source, quarters, "c0ffee").collect()}
    assert status == {"2023q1": "ok", "2023q2": "ok", "2023q3": "halted", "2023q4": "halted"}
    assert Ledger(lake).todo(quarters) == ["2023q3", "2023q4"]
    assert lake.silver.row_count() == 2
    reasons = [r["reason"] for r in lake.quarantine_unevaluable.read().collect()]
    assert reasons == ["empty batch where rows expected"]

    metrics = metrics_table(
        lake.registry.read(),
        lake.bronze_facts.read(),
        lake.quarantine_rows.read(),
        lake.quarantine_unevaluable.read(),
        lake.silver.commits(),
        lake.model,
    ).cache()
    rows = {r["quarter"]: r for r in metrics.collect()}
    assert (rows["2023q1"]["rows_in"], rows["2023q1"]["rows_to_silver"]) == (3, 1)
    assert rows["2023q3"]["key_collisions"] == 1 and rows["2023q3"]["rows_to_silver"] == 0
    assert rows["2023q4"]["q_uneval"] == 1
    ledger = Ledger(lake).read()
    assert conservation_findings(metrics, ledger).isEmpty()

    lines = ledger.filter("status = 'ok' AND quarter LIKE '2%'").select("quarter", "log_line")
    logged = parse_run_lines(lines, "log_line")
    assert logged.count() == 2
    assert logged_mismatches(metrics, logged).isEmpty()
    wrong = logged.withColumn("rows_in", F.col("rows_in") + 1)
    assert logged_mismatches(metrics, wrong).count() == 2
    metrics.unpersist()


def test_one_byte_changes_the_batch_id(spark, tmp_path, source):
    lake = _lake(spark, tmp_path)
    first = ingest_quarter(lake, source, "2023q2", "c0ffee", "2024-01-01 00:00:00")
    num = tmp_path / "source" / "2023q2" / "num.txt"
    num.write_text(num.read_text().replace("150", "151"))
    second = ingest_quarter(lake, source, "2023q2", "c0ffee", "2024-01-01 00:00:00")
    assert first.batch_id != second.batch_id
    assert lake.registry.read().count() == 2


def test_missing_source_column_halts_after_bronze(spark, tmp_path):
    root = tmp_path / "source"
    header = NUM.replace("\tvalue", "")
    _write(root, "2023q1", ["a1\tRevenues\tv1\t20230331\t1\tUSD\t\t\n"], [_sub("a1", 1, T1)], header)
    lake = _lake(spark, tmp_path)
    backfill(lake, str(root), ["2023q1"], "c0ffee")
    (row,) = Ledger(lake).read().collect()
    assert row["status"] == "halted" and "value" in row["log_line"]
    assert lake.bronze_facts.exists() and lake.registry.exists()
    assert not lake.silver.exists() and lake.quarantine_unevaluable.row_count() == 1


def test_scan_keeps_declared_order_and_reads_blank_as_null(spark, tmp_path):
    path = tmp_path / "x.txt"
    path.write_text('b\textra\ta\n1\tx\t\n"2"\ty\t""\n')
    df = scan_declared(spark, str(path), ["a", "b", "c"])
    assert df.columns == ["a", "b"]
    assert [tuple(r) for r in df.collect()] == [(None, "1"), (None, "2")]


def test_files_are_read_by_their_own_headers(spark, tmp_path):
    (tmp_path / "one.txt").write_text("a\tb\tc\n1\t2\t3\n")
    (tmp_path / "two.txt").write_text("c\ta\n6\t4\n")
    df = scan_declared(spark, str(tmp_path), ["a", "b", "c"])
    assert sorted(map(tuple, df.collect())) == [("1", "3"), ("4", "6")]


def test_files_are_digested(spark, tmp_path):
    import hashlib

    for n in (1, 1000):
        (tmp_path / f"{n}.bin").write_bytes(b"abc" * n)
    got = {r["length"]: r["sha256"] for r in source_digests(spark, str(tmp_path)).collect()}
    assert got == {n: hashlib.sha256(b"abc" * (n // 3)).hexdigest() for n in (3, 3000)}


def test_manifest_text_is_the_same_on_driver_and_in_spark(spark):
    batch_id, text = batch_manifest(["b", "a"], "s", "c", {"quarter": '20"\\23q1'})
    assert text.startswith('{"code_sha":"c","param.quarter":"20\\"\\\\23q1"')
    df = spark.createDataFrame([(["b", "a"], '20"\\23q1')], "h array<string>, q string")
    entries = manifest_entries(F.col("h"), F.lit("s"), F.lit("c"), {"quarter": F.col("q")})
    row = with_batch_identity(df, entries).first()
    assert (row["batch_id"], row["manifest_json"]) == (batch_id, text)
    for other in (batch_manifest(["a", "x"], "s", "c", {}), batch_manifest(["b", "a"], "s", "d", {})):
        assert other[0] != batch_id


def test_hashes_and_fingerprints(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "x"), (" ", "x")], "a string, b string")
    strict = [r[0] for r in df.select(row_hash(["a", "b"])).collect()]
    loose = [r[0] for r in df.select(row_hash(["a", "b"], injective=False)).collect()]
    assert len(set(strict)) == 4 and len(set(loose)) == 2
    m = F.create_map(F.lit("b"), F.lit("2"), F.lit("a"), F.lit("1"))
    assert spark.range(1).select(canonical_json(m)).first()[0] == '{"a":"1","b":"2"}'
    swapped = df.select("b", "a")
    assert schema_fingerprint(df.schema) != schema_fingerprint(swapped.schema)


def _history(spark, tmp_path):
    lake = _lake(spark, tmp_path)
    filings = [
        Filing("a1", 1, "Revenues", "100", T1),
        Filing("a2", 1, "Revenues", "150", T2),
        Filing("a3", 2, "Assets", "10", T1),
        Filing("a4", 3, "Assets", "20", T2),
    ]
    load(lake, "b", filings)
    from tidemark.plans.lake import BatchRecord

    lake.register(BatchRecord("b", '{"param.quarter":"2023q1"}', 0))
    return lake


def test_audit_is_green_on_gold_and_red_on_its_twin(spark, tmp_path):
    lake = _history(spark, tmp_path)
    gold, registry = lake.gold.read(), lake.registry.read()
    green = run_audit(gold, FILED_FACTS, registry)
    assert (green.verdict, green.exit_code) == ("GREEN", 0)
    red = run_audit(lookahead_twin(gold, FILED_FACTS, F.col("tag") == "Assets"), FILED_FACTS, registry)
    assert (red.verdict, red.exit_code, red.count("A1")) == ("RED", 1, 2)
    assert all(r.verdict == "PASS" for r in red.results if not r.check.startswith("A1"))
    green.write_json(spark, str(tmp_path / "report"))
    report = spark.read.json(str(tmp_path / "report"))
    assert report.count() == 8 and report.select("outcome").distinct().first()[0] == "GREEN"


def test_audit_that_cannot_run_halts(spark, tmp_path):
    lake = _history(spark, tmp_path)
    gold = lake.gold.read()
    for damaged in (OSError("gone"), gold.drop("accepted"), gold.filter("1 = 0")):
        outcome = run_audit(damaged, FILED_FACTS, lake.registry.read())
        assert (outcome.verdict, outcome.exit_code) == ("UNEVALUABLE", 2)
    assert run_audit(gold, FILED_FACTS, None).verdict == "UNEVALUABLE"
    twice = lake.registry.read().unionByName(lake.registry.read())
    assert run_audit(gold, FILED_FACTS, twice).verdict == "RED"


def test_publish_is_credited_only_when_earned(spark, tmp_path):
    lake = _history(spark, tmp_path)
    published = Published(spark, str(tmp_path / "published"))
    key = {"cik": 1, "tag": "Revenues", "ddate": 20230331, "qtrs": 1, "uom": "USD"}
    defect = F.col("tag") == "Assets"
    with pytest.raises(TwinRefused):
        write_audit_publish(lake, published, str(tmp_path / "copy"), defect, key, "2023-06-01", 100)
    record = write_audit_publish(
        lake, published, str(tmp_path / "twin"), defect, key, "2023-06-01", 100
    )
    assert record.credited and record.planted == 2 and not record.control_passed
    assert published.read().count() == 4
    # Publishing again: the control already passes, so the effect earns no credit.
    again = write_audit_publish(
        lake, published, str(tmp_path / "twin2"), defect, key, "2023-06-01", 100
    )
    assert again.published and again.control_passed and not again.credited
    # A twin with nothing planted proves nothing, so nothing is published.
    fresh = Published(spark, str(tmp_path / "published2"))
    vacuous = write_audit_publish(
        lake, fresh, str(tmp_path / "twin3"), F.lit(False), key, "2023-06-01", 100
    )
    assert not vacuous.published and not fresh.pointers.exists()


def test_null_twin_plants_exactly_n(spark):
    rows = [(i, "x") for i in range(50)] + [(99, "same")] * 50
    df = spark.createDataFrame(rows, "id int, c string")
    for n in (1, 60, 100):
        twin = null_twin(df, "c", n, seed=5)
        assert (twin.count(), twin.filter("c IS NULL").count()) == (100, n)
    unique = df.filter("id < 50")
    keyed = null_twin(unique, "c", 7, seed=5, key=["id"])
    assert (keyed.count(), keyed.filter("c IS NULL").count()) == (50, 7)
    ids = lambda d: {r["id"] for r in seeded_sample(d, 7, 5, ["id"]).collect()}
    assert ids(unique) == ids(unique.repartition(7))
    for bad in (lambda: null_twin(df, "c", 0, 1), lambda: null_twin(df, "c", 101, 1),
                lambda: null_twin(df, "zz", 1, 1), lambda: null_twin(df.filter("1=0"), "c", 1, 1),
                lambda: require_twin_destination("/lake/gold")):
        with pytest.raises(TwinRefused):
            bad()
