"""Gold rebuild and the end-to-end run over frames."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.model import INGEST_TS, FactModel
from tidemark.operators.intervals import (
    attach_filings,
    build_intervals,
    plan_interval_slices,
    validity_intervals,
)
from tidemark.operators.skew import SMALL_TABLE_ROWS, plan_slices
from tidemark.plans.lake import Lake
from tidemark.plans.silver import RunMetrics, run_silver
from tidemark.session import scratch_folder
from tidemark.sources.tables import VersionedTable


#: Share of silver's rows up to which changes are spliced into gold; beyond it gold is
#: computed whole, with the same rows as result.
INCREMENT_SHARE = 0.01


def rebuild_gold(lake: Lake, full: bool = False, share: float = INCREMENT_SHARE) -> int:
    """Bring gold up to silver and the accumulated filing index; returns its version.

    Gold follows from all filings, never from one batch's: that would drop the
    facts of every earlier filing.  When gold's own commit says which versions
    it was built from, only the natural keys of facts and filings that changed
    since are computed again, and only the folders of their entities are read
    and replaced.  Otherwise, with ``full``, or if more than ``share`` of
    silver's rows are new, everything is computed.
    """
    changes = None if full else _changes(lake, share)
    if changes is None and lake.silver.has_updates() and _half_superseded(lake.silver):
        lake.silver.compact()  # once, instead of dropping the old rows at every later read
    built = json.dumps(
        {"silver": lake.silver.latest_version(), "filings": lake.filing_index.latest_version()}
    )
    if changes is not None:
        return _splice(lake, changes, built)
    facts = lake.silver.read()
    filings = lake.filing_index.read().drop(INGEST_TS)
    n_facts, model = lake.silver.row_count(), lake.model
    entity = model.natural_key[:1]
    lake.gold.size_for(n_facts)
    if _dealt_by_entity(lake, n_facts) and not plan_interval_slices(
        facts, filings, model, entity, at_most=n_facts
    ):  # no entity too large for a task: its keys can be windowed where its folder is written
        rows = lake.gold.deal(attach_filings(facts, filings, model))
        return lake.gold.overwrite(validity_intervals(rows, model), built)
    plan = plan_interval_slices(facts, filings, model, at_most=n_facts)
    return lake.gold.overwrite(build_intervals(facts, filings, model, plan), built)


def _half_superseded(table: VersionedTable) -> bool:
    """Whether half of the rows that a read opens are dropped: then the table is worth writing again."""
    return table.superseded_rows() >= table.row_count()


def _changes(lake: Lake, share: float) -> DataFrame | None:
    """Changed facts with their filings of then and now; None if a full rebuild is due.

    Columns: fact key and value, ``now`` and ``before`` (the filing's columns as
    a struct, null if there was none).
    """
    gold, model = lake.gold, lake.model
    if not gold.exists() or gold.split_by is None or not set(model.fact_key) <= set(model.gold_columns):
        return None
    try:
        built = json.loads(gold.label())
        silver, filings = built["silver"], built["filings"]
    except (ValueError, KeyError, TypeError):
        return None
    facts, index = lake.silver.changed_since(silver), lake.filing_index.changed_since(filings)
    if facts is None or index is None:
        return None
    if lake.silver.rows_since(silver) > share * lake.silver.row_count():
        return None  # one pass over everything costs less than finding what changed
    link = model.link
    names = list(dict.fromkeys((*model.fact_key, model.value)))
    links = index.select(link)
    # facts of a filing that came or changed count as changed, whenever they were loaded
    touched = lake.silver.read().join(links, link, "left_semi").select(*names)
    others = facts.join(links, link, "left_anti").select(*names)
    entry = F.struct(*[c for c in model.filing_types if c != link])
    now = lake.filing_index.read().select(link, entry.alias("now"))
    before = lake.filing_index.read(filings).select(link, entry.alias("before"))
    return touched.unionAll(others).join(now, link, "left").join(before, link, "left")


def _splice(lake: Lake, changes: DataFrame, built: str) -> int:
    """Gold with the natural keys of ``changes`` computed again; other folders stay."""
    spark, gold, model = lake.spark, lake.gold, lake.model
    path = scratch_folder(spark, "gold-changes")
    changes.write.parquet(path)
    changes = spark.read.schema(changes.schema).parquet(path)

    def at(filing: str) -> DataFrame:
        """Changed facts as rows of gold, under the filings of one time."""
        own = {c: F.col(f"{filing}.{c}") for c in model.filing_types if c != model.link}
        known = changes.filter(F.col(filing).isNotNull()).withColumns(own)
        return known.select(*dict.fromkeys((*model.natural_key, model.value, *model.order)))

    keys = at("now").unionAll(at("before")).select(*model.natural_key).distinct()
    folder = gold.folder_of(F.col(model.natural_key[0])).alias("f")
    folders = sorted(r["f"] for r in keys.select(folder).distinct().collect())  # at most one per folder
    if not folders:
        return gold.relabel(built)
    stood = gold.read(folders=folders)
    names = list(dict.fromkeys((*model.natural_key, model.value, *model.order)))
    bound = gold.row_count() + lake.silver.row_count()
    told = set(model.natural_key) <= {*model.fact_key, *model.filing_types}  # a key never moves but by its filing
    if told and _dealt_by_entity(lake, bound) and not plan_slices(
        stood.select(*names).unionAll(at("now").select(*names)), model.natural_key[:1], model.order, at_most=bound
    ):
        return gold.replace_folders(_respliced(gold, stood, at, names, model), folders, built)
    kept = stood.join(changes.select(*model.fact_key), list(model.fact_key), "left_anti")
    same_key = F.lit(True)
    for c in model.natural_key:
        same_key = same_key & F.col(f"g.{c}").eqNullSafe(F.col(f"k.{c}"))
    known = lambda how: kept.alias("g").join(keys.alias("k"), same_key, how)
    again = known("left_semi").select(*names).unionAll(at("now").select(*names))
    plan = plan_slices(again, model.natural_key, model.order, at_most=bound)
    fresh = validity_intervals(again, model, plan)
    return gold.replace_folders(known("left_anti").unionByName(fresh), folders, built)


def _dealt_by_entity(lake: Lake, rows: int) -> bool:
    """Whether a task may take all rows of a folder of gold, as far as their number goes."""
    gold = lake.gold
    return gold.split_by == lake.model.natural_key[0] and rows <= gold.buckets() * SMALL_TABLE_ROWS


def _respliced(gold: VersionedTable, stood: DataFrame, at, names: list[str], model: FactModel) -> DataFrame:
    """Rows of gold after a splice: one deal by entity, where the changed keys are told and windowed.

    ``_how`` is 0 for a row that stood, 1 for one of now, 2 for a mark of where one was
    before.  A row that stood lies with its mark, as it was built from the same fact and filing.
    """
    no_end = F.lit(None).cast("timestamp_ntz").alias("valid_to")
    marked = lambda rows, how, end: rows.select(*names, end, F.lit(how).alias("_how"))
    rows = marked(stood, 0, F.col("valid_to"))
    rows = rows.unionAll(marked(at("now"), 1, no_end)).unionAll(marked(at("before"), 2, no_end))
    changed = F.max("_how").over(Window.partitionBy(*model.natural_key)) > 0
    same_fact = list(dict.fromkeys((*model.natural_key, *model.fact_key)))
    marks = F.count_if(F.col("_how") == 2).over(Window.partitionBy(*same_fact))
    rows = gold.deal(rows).withColumn("_changed", changed).withColumn("_marks", marks)
    rows = rows.filter("_how = 1 OR _how = 0 AND _marks = 0").drop("_marks")
    fresh = validity_intervals(rows.withColumnRenamed("valid_to", "_known_to"), model)
    end = F.when(F.col("_changed"), F.col("valid_to")).otherwise(F.col("_known_to"))
    return fresh.withColumn("valid_to", end).drop("_how", "_changed", "_known_to")


def run_batch(
    lake: Lake,
    facts: DataFrame,
    filings: DataFrame,
    batch_id: str,
    ingest_ts: str,
    share: float = INCREMENT_SHARE,
) -> RunMetrics:
    """One batch from frames through silver to a rebuilt gold."""
    metrics = run_silver(lake, facts, filings, batch_id, ingest_ts)
    rebuild_gold(lake, share=share)
    return metrics
