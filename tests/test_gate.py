"""The gate's three outcomes, lanes, row checks and verdicts."""

import pytest
from helpers import T1, Filing, facts_frame, filings_frame, load, silver_rows
from pyspark.sql import functions as F

from tidemark.functions.casting import cast_facts
from tidemark.model import FILED_FACTS
from tidemark.operators.quality import QualityHalt, gate, missing_source_columns
from tidemark.operators.rowchecks import FILED_CHECKS, run_row_checks, worst
from tidemark.operators.splits import split_scope, split_valid
from tidemark.plans.lake import Lake
from tidemark.plans.silver import run_silver

CONTRACT = FILED_FACTS.contract
ROW = ("a1", "Revenues", "v1", 20230331, 1, "USD", "100")


def test_clean_batch_passes(spark):
    assert gate(silver_rows(spark, [ROW]), CONTRACT).label == "Pass"


def test_two_units_are_two_facts(spark):
    euro = (*ROW[:5], "EUR", "92")
    assert gate(silver_rows(spark, [ROW, euro]), CONTRACT).label == "Pass"


def test_duplicate_key_fails_with_group_count(spark):
    outcome = gate(silver_rows(spark, [ROW, ROW, ROW]), CONTRACT)
    assert outcome.label == "Fail"
    assert [(v.constraint, v.count) for v in outcome.violations] == [("uniqueness", 1)]


def test_null_and_negative_are_counted_apart(spark):
    bad = [("a1", "T", "v1", 1, -1, "USD", None), ("a2", None, "v1", 1, None, "USD", "1")]
    found = {(v.constraint, v.target): v.count for v in gate(silver_rows(spark, bad), CONTRACT).violations}
    assert found == {
        ("completeness", "tag"): 1,
        ("completeness", "value"): 1,
        ("non-negative", "qtrs"): 1,
    }


def test_missing_column_empty_and_wrong_type_are_unevaluable(spark):
    df = silver_rows(spark, [ROW])
    missing = gate(df.drop("value"), CONTRACT)
    assert missing.label == "Unevaluable" and "value" in missing.reason
    assert gate(df.filter("1 = 0"), CONTRACT).label == "Unevaluable"
    typed = gate(df.withColumn("value", F.col("value").cast("string")), CONTRACT)
    assert "expected decimal(28,4)" in typed.reason


def test_a_contract_column_the_batch_lacks_fails_closed(spark):
    outcome = gate(silver_rows(spark, [ROW]).drop("qtrs"), CONTRACT)
    assert outcome.label == "Unevaluable" and outcome.reason.startswith("analyzer error")


def test_a_failing_action_fails_closed(spark):
    broken = silver_rows(spark, [ROW]).withColumn("qtrs", F.raise_error(F.lit("boom")).cast("int"))
    outcome = gate(broken, CONTRACT)
    assert outcome.label == "Unevaluable" and outcome.reason.startswith("analyzer error")


def test_source_precondition_sees_what_the_cast_would_hide(spark):
    raw = silver_rows(spark, [ROW]).drop("value")
    assert missing_source_columns(raw, ["adsh", "value"]) == "missing source column(s): value"
    assert cast_facts(raw, FILED_FACTS).schema["value"].dataType.simpleString() == "decimal(28,4)"


def test_casts_give_null_not_errors(spark):
    df = spark.createDataFrame(
        [("a", "1.25", "20230331.0", "x")], "adsh string, value string, ddate string, qtrs string"
    )
    row = cast_facts(df, FILED_FACTS).first()
    assert (float(row["value"]), row["ddate"], row["qtrs"], row["tag"]) == (1.25, 20230331, None, None)


def test_splits_lose_no_row(spark):
    rows = [("a", "", None, "1"), ("b", None, "x", "1"), ("c", None, "", None)]
    df = spark.createDataFrame(rows, "adsh string, segments string, coreg string, value string")
    inside, outside = split_scope(df, ("segments", "coreg"))
    assert {r.adsh for r in inside.collect()} == {"a", "c"}
    assert {r.adsh for r in outside.collect()} == {"b"}
    good, bad = split_valid(inside, ["adsh", "value"])
    assert (good.count(), bad.count()) == (1, 1)


def test_lanes_hold_three_shapes(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    twice = [Filing("a1", 1, "Revenues", "1", T1), Filing("a1", 1, "Revenues", "2", T1),
             Filing("a1", 1, "Notes", None, T1)]
    with pytest.raises(QualityHalt) as refused:
        load(lake, "b-dup", twice)
    assert refused.value.outcome.label == "Fail"
    assert lake.quarantine_rows.row_count() == 1  # written before the gate
    detail = lake.quarantine_detail.read().first()
    assert (detail["check"], detail["constraint"], detail["violations"]) == ("silver-num", "uniqueness", 1)

    facts = facts_frame(spark, twice[:1]).drop("value")
    with pytest.raises(QualityHalt, match="value"):
        run_silver(lake, facts, filings_frame(spark, twice), "b-missing", T1)
    with pytest.raises(QualityHalt, match="empty batch"):
        run_silver(
            lake, facts_frame(spark, twice).filter("1 = 0"), filings_frame(spark, twice), "b-empty", T1
        )
    lanes = {r["batch_id"]: r["reason"] for r in lake.quarantine_unevaluable.read().collect()}
    assert lanes == {
        "b-missing": "missing source column(s): value",
        "b-empty": "empty batch where rows expected",
    }
    assert not lake.silver.exists() and not lake.filing_index.exists()

    load(lake, "b-ok", [Filing("a2", 1, "Revenues", "1", T1)])
    assert lake.silver.row_count() == 1


def _sub(spark, rows):
    return spark.createDataFrame(rows, "adsh string, cik bigint, form string")


def _num(spark, rows):
    return spark.createDataFrame(rows, "tag string, value string")


def test_row_checks_apply_criticality_at_the_outcome(spark):
    tables = {
        "sub": _sub(spark, [("a", 1, "10-K"), ("b", None, "")]),
        "num": _num(spark, [("T", None), ("T", "1")]),
    }
    got = {r["name"]: (r["outcome"], r["bad"]) for r in run_row_checks(tables)}
    assert got == {
        "precondition": ("pass", None),
        "sub_cik_not_null": ("fail", 1),
        "sub_adsh_not_null": ("pass", 0),
        "sub_form_not_null_not_empty": ("fail", 1),
        "num_value_not_null": ("warn", 1),
        "num_tag_not_null": ("pass", 0),
    }
    assert worst([o for o, _ in got.values()]) == ("fail", 1)
    assert worst(["pass", "warn"]) == ("warn", 0)
    assert worst(["fail", "unevaluable"]) == ("unevaluable", 2)


@pytest.mark.parametrize(
    "damage, text",
    [
        (lambda t: t.pop("num"), "missing data"),
        (lambda t: t.update(num=OSError("gone")), "unreadable"),
        (lambda t: t.update(num=t["num"].drop("value")), "missing columns"),
        (lambda t: t.update(num=t["num"].filter("1 = 0")), "zero rows"),
    ],
)
def test_row_check_preconditions_stop_the_run(spark, damage, text):
    tables = {"sub": _sub(spark, [("a", 1, "10-K")]), "num": _num(spark, [("T", "1")])}
    damage(tables)
    (only,) = run_row_checks(tables, FILED_CHECKS)
    assert only["outcome"] == "unevaluable" and text in only["detail"]
