"""Attempt ledgers and run-log lines as data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.frames import one_row

LEDGER_SCHEMA = (
    "quarter string, status string, exit int, wall_s double, log_line string, "
    "code_sha string, ts timestamp_ntz"
)

# Text by which a run log shows that the gate refused the batch.
REFUSAL_MARKS = ("DataQualityException", "DQ gate")

# The run line written per batch, and the pattern that reads it.
RUN_LINE_FORMAT = (
    "run batch_id=%s rows_in=%d rows_out=%d scoped_out=%d rejected=%d quarantined=%d "
    "gate=%s delta_version=%d wall_clock_ms=%d"
)
RUN_LINE_PATTERN = (
    r"run batch_id=(\S+) rows_in=(\d+) rows_out=(\d+) scoped_out=(\d+) rejected=(\d+) "
    r"quarantined=(\d+) gate=(\S+) delta_version=(\d+)(?: wall_clock_ms=(\d+))?"
)
RUN_LINE_FIELDS = (
    ("batch_id", "string"),
    ("rows_in", "bigint"),
    ("rows_out", "bigint"),
    ("scoped_out", "bigint"),
    ("rejected", "bigint"),
    ("quarantined", "bigint"),
    ("gate", "string"),
    ("delta_version", "bigint"),
    ("wall_clock_ms", "bigint"),
)


def run_line() -> Column:
    """The run line as text, from columns named after its fields."""
    return F.format_string(RUN_LINE_FORMAT, *[F.col(n) for n, _ in RUN_LINE_FIELDS])


def parse_run_lines(lines: DataFrame, text: str = "value") -> DataFrame:
    """The nine fields of every run line found in ``text``; other lines drop out.

    Text before the marker (a build tool's prefix) is ignored; an absent
    wall clock reads as NULL.
    """
    found = lines.filter(F.col(text).rlike(RUN_LINE_PATTERN))
    keep = [c for c in lines.columns if c != text]
    fields = [
        F.regexp_extract(text, RUN_LINE_PATTERN, i + 1).try_cast(ddl).alias(name)
        for i, (name, ddl) in enumerate(RUN_LINE_FIELDS)
    ]
    return found.select(*keep, *fields)


def scan_run_logs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Run lines of log files: ``quarter, attempt`` from the path, the fields, and ``place``.

    Files (or folders of part files) are named ``backfill-<quarter>.log`` and
    may lie in folders ``attempt=<n>``; without one the attempt is 0.  ``place``
    orders the lines of a quarter: by attempt, then by file age, then as they
    stand in the file.
    """
    path = F.col("_metadata.file_path")
    attempt = F.regexp_extract(path, r"/attempt=(\d+)/", 1).try_cast("bigint")
    lines = spark.read.text(paths).select(
        "value",
        F.regexp_extract(path, r"backfill-([^/]+)\.log", 1).alias("quarter"),
        F.coalesce(attempt, F.lit(0).cast("bigint")).alias("attempt"),
        F.struct(
            F.col("_metadata.file_modification_time").alias("written"),
            path.alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("place"),
    )
    return parse_run_lines(lines.filter("quarter <> ''"))


def last_run_lines(logs: DataFrame, ledger: DataFrame) -> DataFrame:
    """The last run line of every quarter whose last attempt on record went through.

    A later attempt that was refused or failed leaves its quarter without one.
    """
    ok = latest_attempts(ledger).filter("status = 'ok'").select("quarter")
    last = latest_attempts(logs, order=("attempt", "place"))
    return last.join(ok, "quarter", "left_semi").drop("attempt", "place")


def write_run_log(spark: SparkSession, root: str, quarter: str, attempt: int, text: str) -> None:
    """The log file of one attempt, where :func:`scan_run_logs` finds it."""
    folder = f"{root}/attempt={attempt}/backfill-{quarter}.log"
    one_row(spark, (text,), "value string").write.mode("append").text(folder)


def scan_ledger(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return spark.read.schema(LEDGER_SCHEMA).json(paths)


def latest_attempts(ledger: DataFrame, key: str = "quarter", order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """The last record per key; partial maxima keep a retried key cheap."""
    rest = [c for c in ledger.columns if c != key]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return ledger.groupBy(key).agg(last.alias("_r")).select(key, *[f"_r.{c}" for c in rest])


def remaining(expected: DataFrame, ledger: DataFrame, key: str = "quarter") -> DataFrame:
    """Expected keys whose last attempt is not ``ok``."""
    done = latest_attempts(ledger, key).filter(F.col("status") == "ok").select(key)
    return expected.join(done, key, "left_anti")


def attempt_status(exit_code: Column, log_text: Column) -> Column:
    """ok on exit 0; halted when the log shows the gate refused; else error."""
    refused = reduce(lambda a, b: a | b, [log_text.contains(m) for m in REFUSAL_MARKS])
    return F.when(exit_code == 0, "ok").when(refused, "halted").otherwise("error")
