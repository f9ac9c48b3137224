"""Many quarters in time order: halts are recorded, reruns resume, gold comes last."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.frames import one_row
from tidemark.operators.quality import QualityHalt
from tidemark.operators.recompute import metrics_table
from tidemark.plans.gold import rebuild_gold
from tidemark.plans.ingest import ingest_quarter
from tidemark.plans.lake import UNEVALUABLE_SCHEMA, Lake
from tidemark.plans.silver import run_silver
from tidemark.sources.logs import (
    LEDGER_SCHEMA,
    last_run_lines,
    remaining,
    scan_ledger,
    scan_run_logs,
    write_run_log,
)


class Ledger:
    """Attempt records as JSON lines; the last record of a quarter is its status."""

    def __init__(self, lake: Lake):
        self.spark, self.path = lake.spark, f"{lake.root}/ledger"

    def read(self) -> DataFrame:
        try:
            return scan_ledger(self.spark, self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER_SCHEMA)

    def record(self, quarter, status, exit_code, wall_s, line, code_version) -> None:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        row = (quarter, status, exit_code, wall_s, line, code_version, now)
        one_row(self.spark, row, LEDGER_SCHEMA).write.mode("append").json(self.path)

    def todo(self, quarters: Sequence[str]) -> list[str]:
        """Quarters still to run, in time order."""
        wanted = self.spark.createDataFrame([(q,) for q in quarters], "quarter string")
        left = remaining(wanted, self.read())
        return [r["quarter"] for r in left.orderBy("quarter").collect()]


def backfill(
    lake: Lake,
    source_root: str,
    quarters: Sequence[str],
    code_version: str,
    build_gold: Callable[[Lake], int] = rebuild_gold,
) -> DataFrame:
    """Run every quarter that is not yet ok; returns the ledger.

    Each attempt leaves its log under ``logs`` of the lake.

    A refused or failed quarter costs only itself: it is recorded and skipped,
    because quarters are independent up to silver.  Gold is rebuilt when a
    quarter got through, or when the last rebuild failed; a rebuild that fails
    is recorded too.
    """
    ledger, spark = Ledger(lake), lake.spark
    rebuild = bool(ledger.todo(["_gold_rebuild"]))
    earlier = {r["quarter"]: r["count"] for r in ledger.read().groupBy("quarter").count().collect()}
    for quarter in ledger.todo(quarters):
        started = time.monotonic()
        ingest_ts = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
        line = ""
        try:
            got = ingest_quarter(lake, source_root, quarter, code_version, ingest_ts)
            run = run_silver(lake, got.facts, got.filings, got.batch_id, ingest_ts)
            status, code, line = "ok", 0, run.line(spark)
            rebuild = True
        except QualityHalt as halt:
            status, code, line = "halted", 1, str(halt)
        except Exception as e:
            status, code, line = "error", 1, f"{type(e).__name__}: {e}"
        wall = round(time.monotonic() - started, 1)
        write_run_log(spark, f"{lake.root}/logs", quarter, earlier.get(quarter, 0) + 1, line)
        ledger.record(quarter, status, code, wall, line, code_version)
    if rebuild and lake.silver.exists():
        started = time.monotonic()
        try:
            version = build_gold(lake)
            status, code = "ok", 0
            line = f"gold_rebuild rows={lake.gold.row_count()} delta_version={version}"
        except Exception as e:
            status, code, line = "error", 1, f"{type(e).__name__}: {e}"
        wall = round(time.monotonic() - started, 1)
        ledger.record("_gold_rebuild", status, code, wall, line, code_version)
    return ledger.read().filter(~F.col("quarter").startswith("_"))


def lake_metrics(lake: Lake) -> DataFrame:
    """Metrics of every registered batch, from the lake's tables, logs and ledger."""
    unevaluable = lake.spark.createDataFrame([], UNEVALUABLE_SCHEMA)
    if lake.quarantine_unevaluable.refresh().exists():
        unevaluable = lake.quarantine_unevaluable.read()
    bronze = lake.bronze_facts.read()
    rows = lake.quarantine_rows.read() if lake.quarantine_rows.refresh().exists() else bronze.limit(0)
    logs = last_run_lines(scan_run_logs(lake.spark, f"{lake.root}/logs"), Ledger(lake).read())
    return metrics_table(
        lake.registry.read(), bronze, rows, unevaluable, lake.silver.commits(), lake.model, logs
    )
