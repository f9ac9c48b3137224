"""What is read and moved once only: metrics, audits, profiles and text scans."""

import gzip

import pytest
from pyspark.sql import functions as F

from tidemark.catalogue import QUERIES, base, verify
from tidemark.catalogue.intervals import filed_gold
from tidemark.model import BATCH_ID, FILED_FACTS
from tidemark.operators.audit import interval_counts
from tidemark.operators.probe import probe
from tidemark.operators.recompute import bronze_counts, bronze_metrics, key_collisions, with_totals
from tidemark.sources.delimited import first_line, profile_types, scan_declared, scan_profiled
from tidemark.sources.logs import last_run_lines, scan_run_logs, write_run_log


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_metrics_scan_bronze_once(spark, sf):
    for name in ("metrics_recomputed", "metrics_totals", "conservation"):
        plan = plan_of(QUERIES[name](spark, sf))
        assert plan.count("/bronze-") == 1, name


def test_one_fold_equals_the_separate_counts(spark, sf):
    bronze = verify._loose(spark, sf)
    found = bronze_metrics(bronze, FILED_FACTS)
    counts = bronze_counts(bronze, FILED_FACTS)
    collided = key_collisions(bronze, FILED_FACTS)
    want = counts.join(collided, BATCH_ID, "left").fillna(0)
    assert sorted(map(tuple, found.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_totals_keep_rows_and_add_one(spark):
    rows = spark.createDataFrame([("q1", "a", 1), ("q1", "b", 2), ("q2", "c", None)], "quarter string, batch string, n int")
    got = sorted(map(tuple, with_totals(rows, columns=["n"]).collect()))
    assert got == [("q1", 1), ("q1", 2), ("q2", 0), ("total", 3)]
    assert with_totals(rows.limit(0), columns=["n"]).isEmpty()


def test_a_constant_key_column_costs_no_exchange(spark, sf):
    gold = filed_gold(spark, sf)
    counts = interval_counts(gold, FILED_FACTS, constant=("qtrs",))
    before, after = plan_of(gold).count("Exchange hash"), plan_of(counts).count("Exchange hash")
    assert after <= before + 1 < plan_of(interval_counts(gold, FILED_FACTS)).count("Exchange hash")
    assert counts.first() == interval_counts(gold, FILED_FACTS).first()
    split = gold.withColumn("qtrs", F.when(F.col("tag") == "R", F.lit(1)).otherwise(F.col("qtrs")))
    assert interval_counts(split, FILED_FACTS, constant=("qtrs",)).first()["n_rows"] is None
    nothing = gold.withColumn("qtrs", F.lit(None).cast("int"))
    assert interval_counts(nothing, FILED_FACTS, constant=("qtrs",)).first()["n_rows"] == gold.count()


@pytest.fixture
def folder(tmp_path):
    """Files of two headers under an awkward path, one of them compressed, one empty."""
    where = tmp_path / "a b%20c [x] {y}"
    where.mkdir()
    (where / "one.txt").write_text("adsh\ttag\tvalue\n1\tA\t5\n2\tB\t\n")
    (where / "two.txt.gz").write_bytes(gzip.compress(b"value\textra\tadsh\ttag\n7\tx\t3\tC\n"))
    (where / "none.txt").write_text("")
    return where


def escaped(path):
    return "".join(f"\\{c}" if c in "{}[]*?\\" else c for c in str(path))


def test_two_headers_under_an_encoded_path(spark, folder):
    got = scan_declared(spark, escaped(folder), ["adsh", "tag", "value", "missing"])
    assert got.columns == ["adsh", "tag", "value"]
    assert sorted(map(tuple, got.collect()), key=str) == [("1", "A", "5"), ("2", "B", None), ("3", "C", "7")]
    # each file stands in one scan, and no scan of plain lines is left
    plan = plan_of(got)
    assert plan.count("FileScan csv") == 2 and "FileScan text" not in plan


def test_first_lines(spark, folder):
    files = spark.read.text(escaped(folder)).inputFiles()
    lines = sorted((first_line(spark, f) or "" for f in files))
    assert lines == ["", "adsh\ttag\tvalue", "value\textra\tadsh\ttag"]


def test_profile_takes_the_narrowest_type(spark, tmp_path):
    rows = [
        ("1", "3000000000", "1.5", "2024-01-01 00:00:00", "true", "x", None),
        (None, "7", "-2", "2024-02-01", "false", "1", None),
    ]
    names = ["i", "l", "d", "t", "b", "s", "e.mpty"]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))
    kinds = profile_types(df)
    assert [kinds[n] for n in names] == ["int", "bigint", "double", "timestamp_ntz", "boolean", "string", "string"]
    df.write.option("header", True).option("sep", "\t").csv(str(tmp_path / "p"))
    back = scan_profiled(spark, str(tmp_path / "p"))
    assert [f.dataType.simpleString() for f in back.schema] == [kinds[n] for n in names]
    assert back.agg(F.sum("l")).first()[0] == 3000000007


def test_the_last_line_of_a_quarter_counts(spark, tmp_path):
    line = "run batch_id={} rows_in=1 rows_out=1 scoped_out=0 rejected=0 quarantined=0 gate=Pass delta_version=0 wall_clock_ms={}"
    for attempt, batch, ms in ((1, "old", 5), (10, "new", 7), (2, "mid", 6)):
        write_run_log(spark, str(tmp_path / "logs"), "2023q1", attempt, line.format(batch, ms))
    write_run_log(spark, str(tmp_path / "logs"), "2023q2", 1, line.format("other", 9))
    write_run_log(spark, str(tmp_path / "logs"), "2023q2", 2, "DQ gate fail: uniqueness")
    ledger = [("2023q1", "ok", 1), ("2023q2", "ok", 1), ("2023q2", "halted", 2)]
    ledger = spark.createDataFrame(ledger, "quarter string, status string, ts int")
    logs = scan_run_logs(spark, str(tmp_path / "logs"))
    assert logs.count() == 4
    (last,) = last_run_lines(logs, ledger).collect()
    assert (last["quarter"], last["batch_id"], last["wall_clock_ms"]) == ("2023q1", "new", 7)


def test_a_probe_compares_decimals_exactly(spark):
    gold = spark.sql(
        "SELECT 1L AS cik, 'a' AS adsh, cast('900719925474099267.0001' as decimal(28,4)) AS value, "
        "timestamp_ntz'2020-01-01' AS valid_from, timestamp_ntz'9999-12-31' AS valid_to"
    )
    ask = lambda expect: probe(gold, base.FILED, {"cik": 1}, "2021-01-01 00:00:00", expect)[0]
    assert ask("900719925474099267.0001") and not ask("900719925474099267.0002")
