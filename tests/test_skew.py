"""Sliced windows give what plain windows give, whatever the cuts."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.catalogue.base import ORDERS, order_rows
from tidemark.catalogue.intervals import _BY_STATUS, orders_gold
from tidemark.operators.audit import interval_counts, plan_audit_slices
from tidemark.operators.intervals import validity_intervals
from tidemark.operators.skew import next_in_order, plan_slices, with_slice


def _rows(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = None if i % 9 == 0 else ("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(40)}")
        out.append((key, rnd.randrange(50), i))
    return spark.createDataFrame(out, "k string, t int, id int")


@pytest.mark.parametrize("value", ["t", "id"])
@pytest.mark.parametrize("per_slice", [1, 100, 2500])
def test_sliced_lead_equals_plain_lead(spark, per_slice, value):
    df = _rows(spark).withColumn("t", F.when(F.col("t") > 10, F.col("t")))
    plan = plan_slices(df, ["k"], ["t", "id"], rows_per_slice=per_slice, small_table=0)
    plain = next_in_order(df, ["k"], ["t", "id"], value)
    sliced = next_in_order(df, ["k"], ["t", "id"], value, plan)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, sliced.collect()))


def test_large_keys_are_cut_into_small_slices(spark):
    df = _rows(spark)
    plan = plan_slices(df, ["k"], ["t", "id"], rows_per_slice=100, small_table=0)
    biggest = with_slice(df, plan).groupBy("k", "_slice").count().agg(F.max("count")).first()[0]
    assert biggest <= 200


def test_a_planning_sample_only_steers_balance(spark):
    df = _rows(spark)
    plan = plan_slices(
        df, ["k"], ["t", "id"], rows_per_slice=100, small_table=0, sample_rows=400, hits_per_slice=5
    )
    assert plan is not None
    plain = next_in_order(df, ["k"], ["t", "id"], "id")
    sliced = next_in_order(df, ["k"], ["t", "id"], "id", plan)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, sliced.collect()))


def test_one_instant_with_most_rows_is_still_split(spark):
    rows = [("hot", 5, i) for i in range(2000)] + [("hot", 9, 1), ("cold", 1, 1)]
    df = spark.createDataFrame(rows, "k string, t int, id int")
    plan = plan_slices(df, ["k"], ["t", "id"], rows_per_slice=100, small_table=0)
    sizes = with_slice(df, plan).groupBy("k", "_slice").count()
    assert sizes.agg(F.max("count")).first()[0] <= 200
    sliced = next_in_order(df, ["k"], ["t", "id"], "t", plan)
    assert sliced.filter("k = 'hot' AND t = 5 AND _next = 9").count() == 1


def test_small_tables_get_no_plan(spark):
    assert plan_slices(_rows(spark), ["k"], ["t", "id"]) is None


def test_audit_counts_do_not_depend_on_slicing(spark, sf):
    rows = spark.read.parquet(f"{sf}/orders.parquet").select(*_BY_STATUS.fact_types)
    gold = validity_intervals(rows, _BY_STATUS)
    longer = F.col("valid_to") + F.make_dt_interval(F.lit(90))
    bad = gold.withColumn(
        "valid_to", F.when(F.col("o_totalprice") > 400000, longer).otherwise(F.col("valid_to"))
    )
    plan = plan_audit_slices(bad, _BY_STATUS, rows_per_slice=40, small_table=0)
    assert plan is not None
    plain = interval_counts(bad, _BY_STATUS).first().asDict()
    sliced = interval_counts(bad, _BY_STATUS, plan).first().asDict()
    assert plain == sliced
    assert plain["overlapping"] > 0


def test_gold_does_not_depend_on_slicing(spark, sf):
    rows = order_rows(spark, sf)
    plan = plan_slices(rows, ORDERS.natural_key, ORDERS.order, rows_per_slice=2, small_table=0)
    sliced = validity_intervals(rows, ORDERS, plan)
    left = orders_gold(spark, sf).select(*sliced.columns)
    assert left.exceptAll(sliced).isEmpty() and sliced.exceptAll(left).isEmpty()


def test_as_of_by_rank_limits_rows_before_the_shuffle(spark, sf):
    from tidemark.operators.intervals import as_of_ranked

    df = as_of_ranked(order_rows(spark, sf), "1998-06-30", ORDERS)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("Partial")  # printed top down
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThanOrEqual(o_orderdate" in plan
