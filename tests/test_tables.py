"""Versioned tables, merges and their guards."""

import pytest
from helpers import silver_rows
from pyspark.sql import functions as F

from tidemark.model import FILED_FACTS, INGEST_TS, instant
from tidemark.operators.merge import (
    AmbiguousSource,
    classify,
    insert_only,
    merge_metrics,
    newer,
    upsert,
)
from tidemark.sources.tables import MissingTable, VersionedTable

OLD, NEW = "2024-01-01 00:00:00", "2024-02-01 00:00:00"
KEYS = FILED_FACTS.fact_key


def _row(adsh, value, at=OLD):
    return (adsh, "T", "v1", 20230331, 1, "USD", value, at)


def _merge(table, df):
    return table.merge(df, KEYS, newer(), compare=[INGEST_TS])


def _values(df):
    return {r["adsh"]: float(r["value"]) for r in df.collect()}


def test_latest_load_wins_and_equal_load_is_a_no_op(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "silver"))
    _merge(t, silver_rows(spark, [_row("a", "1"), _row("b", "2")]))
    _merge(t, silver_rows(spark, [_row("a", "9", NEW), _row("c", "3", NEW)]))
    assert _values(t.read()) == {"a": 9.0, "b": 2.0, "c": 3.0}
    _merge(t, silver_rows(spark, [_row("a", "5", NEW)]))  # same load time
    _merge(t, silver_rows(spark, [_row("a", "6", OLD)]))  # older
    assert _values(t.read()) == {"a": 9.0, "b": 2.0, "c": 3.0}
    log = {r["version"]: r for r in t.commits().collect()}
    assert [(log[v]["num_source"], log[v]["num_inserted"], log[v]["num_updated"]) for v in range(4)] == [
        (2, 2, 0), (2, 1, 1), (1, 0, 0), (1, 0, 0),
    ]
    assert t.row_count() == t.read().count() == 3


def test_every_version_stays_readable(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    for i, value in enumerate(("1", "2", "3")):
        _merge(t, silver_rows(spark, [_row("a", value, f"2024-0{i + 1}-01 00:00:00")]))
    assert [_values(t.read(v))["a"] for v in range(3)] == [1.0, 2.0, 3.0]
    t.overwrite(silver_rows(spark, [_row("z", "7")]))
    assert _values(t.read()) == {"z": 7.0}
    assert _values(t.read(1)) == {"a": 2.0}
    with pytest.raises(MissingTable):
        t.read(9)


def test_absent_table_is_not_an_error_but_reading_it_is(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "nothing"))
    assert not t.exists() and t.latest_version() is None and t.row_count() == 0
    with pytest.raises(MissingTable):
        t.read()


def test_an_unfinished_write_is_never_read(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    good = silver_rows(spark, [_row("a", "1")])
    t.overwrite(good)
    broken = good.withColumn("value", F.raise_error(F.lit("executor lost")).cast("decimal(28,4)"))
    with pytest.raises(Exception, match="executor lost"):
        t.append(broken)
    assert t.latest_version() == 0
    t.append(silver_rows(spark, [_row("b", "2")]))
    assert _values(t.refresh().read()) == {"a": 1.0, "b": 2.0}


def test_empty_results_are_readable(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    df = silver_rows(spark, [_row("a", "1")])
    t.overwrite(df.filter("1 = 0"))
    assert t.read().count() == 0 and t.read().columns == df.columns
    assert t.append(df.filter("1 = 0")) is None
    assert t.latest_version() == 0


def test_two_writers_do_not_pass_unnoticed(spark, tmp_path):
    one, two = (VersionedTable(spark, str(tmp_path)) for _ in range(2))
    df = silver_rows(spark, [_row("a", "1")])
    one.overwrite(df)
    two.exists()
    one.append(df)
    with pytest.raises(RuntimeError, match="another writer"):
        two.append(df)
    again = VersionedTable(spark, str(tmp_path))
    assert again.latest_version() == 1
    assert again.row_count() == again.read().count() == 2


def test_a_merge_on_other_keys_is_refused(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    _merge(t, silver_rows(spark, [_row("a", "1")]))
    _merge(t, silver_rows(spark, [_row("a", "2", NEW)]))
    with pytest.raises(ValueError, match="merged on"):
        t.merge(silver_rows(spark, [_row("a", "3", NEW)]), ["adsh"], newer(), [INGEST_TS])


def test_schema_drift_is_refused(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    df = silver_rows(spark, [_row("a", "1")])
    t.overwrite(df)
    with pytest.raises(ValueError, match="schema"):
        t.append(df.withColumn("extra", F.lit(1)))


def test_several_source_rows_for_one_target_row_are_refused(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    _merge(t, silver_rows(spark, [_row("a", "1")]))
    with pytest.raises(AmbiguousSource):
        _merge(t, silver_rows(spark, [_row("a", "2", NEW), _row("a", "3", NEW)]))
    with pytest.raises(AmbiguousSource):
        _merge(
            VersionedTable(spark, str(tmp_path / "new")),
            silver_rows(spark, [_row("a", "2"), _row("a", "3")]),
        )


def test_insert_only_keeps_equal_rows_of_one_batch(spark, tmp_path):
    df = spark.createDataFrame([("b", "h1"), ("b", "h1"), ("b", "h2")], "_batch_id string, h string")
    df = df.withColumn(INGEST_TS, instant(OLD))
    t = VersionedTable(spark, str(tmp_path))
    t.insert_new(df, ["_batch_id", "h"])
    t.insert_new(df.withColumn(INGEST_TS, instant(NEW)), ["_batch_id", "h"], F.col("_batch_id") == "b")
    assert t.read().count() == 3
    assert t.read().select(F.max(INGEST_TS).cast("string")).first()[0] == OLD
    extra = spark.createDataFrame([("b", "h3")], "_batch_id string, h string")
    assert insert_only(df.drop(INGEST_TS), extra, ["_batch_id", "h"]).count() == 4


def test_null_keys_never_match(spark):
    ddl = "k int, v string"
    target = spark.createDataFrame([(None, "t"), (1, "t")], ddl)
    source = spark.createDataFrame([(None, "s"), (1, "s"), (2, "s")], ddl)
    merged = sorted(map(tuple, upsert(target, source, ["k"]).collect()), key=repr)
    assert merged == sorted([(None, "t"), (None, "s"), (1, "s"), (2, "s")], key=repr)
    counts = merge_metrics(classify(source, target, ["k"])).first()
    assert (counts["num_inserted"], counts["num_updated"]) == (2, 1)


def test_a_merge_scans_only_keys_of_the_target(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    _merge(t, silver_rows(spark, [_row("a", "1")]))
    changes = classify(silver_rows(spark, [_row("b", "2")]), t.read(), KEYS, newer(), [INGEST_TS])
    plan = changes._jdf.queryExecution().executedPlan().toString()
    (read,) = [line.split("ReadSchema: ")[1] for line in plan.split("\n") if "ReadSchema" in line]
    assert "adsh" in read and "value" not in read


def test_pruning_the_target_changes_no_merge(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    _merge(t, silver_rows(spark, [_row("a", "1"), _row("b", "2")]))
    batch = silver_rows(spark, [_row("a", "9", NEW), _row("c", "3", NEW)])
    t.merge(batch, KEYS, newer(), compare=[INGEST_TS], prune_by="adsh")
    assert _values(t.read()) == {"a": 9.0, "b": 2.0, "c": 3.0}


def test_compaction_keeps_rows_and_history(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path))
    _merge(t, silver_rows(spark, [_row("a", "1"), _row("b", "2")]))
    _merge(t, silver_rows(spark, [_row("a", "9", NEW)]))
    plan = lambda: t.read()._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan()
    t.compact()
    assert "LeftAnti" not in plan()
    assert _values(t.read()) == {"a": 9.0, "b": 2.0}
    assert _values(t.read(0)) == {"a": 1.0, "b": 2.0}
