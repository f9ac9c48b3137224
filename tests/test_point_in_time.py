"""What was known when: restatements, load order, ties, units."""

import itertools

import pytest
from helpers import T1, T2, Filing, facts_frame, filings_frame, load
from pyspark.sql import functions as F

from tidemark.model import FILED_FACTS, OPEN_END
from tidemark.operators.intervals import as_of, as_of_ranked, attach_filings, build_intervals
from tidemark.plans.lake import Lake

ORIGINAL = Filing("a1", 1, "Revenues", "100", T1)
CORRECTION = Filing("a2", 1, "Revenues", "150", T2, ingest="2023-08-02 00:00:00")
PROBES = [("2023-04-01", None), ("2023-06-01", 100), (T2, 150), ("2023-09-01", 150)]


def _gold(spark, filings):
    return build_intervals(facts_frame(spark, filings), filings_frame(spark, filings), FILED_FACTS)


def _values(df):
    return sorted(float(r["value"]) for r in df.collect())


@pytest.mark.parametrize("order", list(itertools.permutations([ORIGINAL, CORRECTION])))
def test_as_of_shows_only_what_was_known(spark, order):
    gold = _gold(spark, order).cache()
    for at, expected in PROBES:
        want = [] if expected is None else [float(expected)]
        assert _values(as_of_ranked(gold, at, FILED_FACTS)) == want
        assert _values(as_of(gold, at)) == want
    gold.unpersist()


def test_units_do_not_restate_each_other(spark):
    euro = Filing("a1", 1, "Revenues", "92", T1, uom="EUR")
    assert _values(as_of(_gold(spark, [ORIGINAL, euro]), "2023-06-01")) == [92.0, 100.0]


def test_masking_hides_when_a_fact_was_superseded(spark):
    gold = _gold(spark, [ORIGINAL, CORRECTION])
    ends = lambda df: [r[0] for r in df.select(F.col("valid_to").cast("string")).collect()]
    assert ends(as_of(gold, "2023-06-01")) == [T2]
    assert ends(as_of(gold, "2023-06-01", mask_future=True)) == [OPEN_END]


@pytest.mark.parametrize("late_original", [False, True])
def test_load_order_changes_no_answer(spark, tmp_path, late_original):
    lake = Lake(spark, str(tmp_path))
    if late_original:
        load(lake, "b-corr", [CORRECTION])
        load(lake, "b-orig", [Filing("a1", 1, "Revenues", "100", T1, ingest="2023-09-02 00:00:00")])
    else:
        load(lake, "b-orig", [ORIGINAL])
        load(lake, "b-corr", [CORRECTION])
    gold = lake.gold.read()
    for at, expected in PROBES:
        assert _values(as_of(gold, at)) == ([] if expected is None else [float(expected)])
    spans = gold.orderBy("accepted").select(F.col("valid_to").cast("string")).collect()
    assert [r[0] for r in spans] == [T2, OPEN_END]

    if late_original:  # negative control: arrival order returns the stale value
        rows = attach_filings(lake.silver.read(), lake.filing_index.read(), FILED_FACTS)
        arrival = lake.silver.read().select("adsh", "_ingest_ts")
        wrong = as_of_ranked(
            rows.join(arrival, "adsh"), "2023-09-01", FILED_FACTS, order=["_ingest_ts"]
        )
        assert _values(wrong) == [100.0]


@pytest.mark.parametrize("reverse", [False, True])
def test_resend_of_a_filing_keeps_the_latest_load(spark, tmp_path, reverse):
    first = Filing("b1", 2, "Assets", "100", T1, ingest="2023-05-02 00:00:00")
    again = Filing("b1", 2, "Assets", "110", T1, ingest="2023-06-02 00:00:00")
    lake = Lake(spark, str(tmp_path))
    for f in (again, first) if reverse else (first, again):
        load(lake, f"b-{f.value}", [f])
    assert _values(lake.silver.read()) == [110.0]
    assert _values(as_of(lake.gold.read(), "2023-09-01")) == [110.0]


@pytest.mark.parametrize("reverse", [False, True])
def test_equal_acceptance_falls_to_the_greater_filing(spark, tmp_path, reverse):
    one = Filing("c1", 3, "Assets", "100", T1)
    two = Filing("c2", 3, "Assets", "200", T1)
    lake = Lake(spark, str(tmp_path))
    for f in (two, one) if reverse else (one, two):
        load(lake, f"b-{f.adsh}", [f])
    assert _values(as_of(lake.gold.read(), "2023-09-01")) == [200.0]


def test_orphans_stay_in_silver_and_leave_gold(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    filings = [ORIGINAL, Filing("a9", 9, "Assets", "5", T1)]
    from tidemark.plans.gold import run_batch

    index = filings_frame(spark, [ORIGINAL])
    run_batch(lake, facts_frame(spark, filings), index, "b", ORIGINAL.ingest)
    assert lake.silver.row_count() == 2
    assert lake.gold.row_count() == 1


def test_scope_counts_and_footnotes(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    run = load(
        lake,
        "b",
        [
            Filing("a1", 1, "Revenues", "100", T1),
            Filing("a1", 1, "Costs", "7", T1, segments="Line=A"),
            Filing("a1", 1, "Costs", "8", T1, coreg="Sub"),
            Filing("a1", 1, "Notes", None, T1),
        ],
    )
    assert (run.rows_in, run.scoped_out, run.quarantined, run.rows_out) == (4, 2, 1, 1)
    assert run.rejected == 1
    assert lake.quarantine_rows.row_count() == 1
    assert lake.gold.row_count() == 1
    assert run.line(spark).startswith("run batch_id=b rows_in=4 rows_out=1 scoped_out=2")
