"""Row checks on raw tables, each with a criticality, and the verdict order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Verdicts in rising severity, with the exit code of each.
SEVERITY = {"pass": 0, "warn": 1, "fail": 2, "unevaluable": 3}
EXIT_CODE = {"pass": 0, "warn": 0, "fail": 1, "unevaluable": 2}

RESULT_COLUMNS = (
    "name",
    "table",
    "column",
    "check_func",
    "outcome",
    "total",
    "good",
    "bad",
    "detail",
)
RESULT_SCHEMA = (
    "name string, table string, column string, check_func string, outcome string, "
    "total bigint, good bigint, bad bigint, detail string"
)


@dataclass(frozen=True)
class RowCheck:
    name: str
    table: str
    column: str
    check_func: str = "is_not_null"
    criticality: str = "error"

    def violated(self) -> Column:
        c = F.col(self.column)
        if self.check_func == "is_not_null":
            return c.isNull()
        if self.check_func == "is_not_null_and_not_empty":
            return c.isNull() | (c.cast("string") == "")
        raise ValueError(f"unknown check function {self.check_func}")


# Checks on the raw filing and fact files.  A missing ``value`` is normal in
# the source (footnote-only rows), so it is counted but does not gate.
FILED_CHECKS = (
    RowCheck("sub_cik_not_null", "sub", "cik"),
    RowCheck("sub_adsh_not_null", "sub", "adsh"),
    RowCheck("sub_form_not_null_not_empty", "sub", "form", "is_not_null_and_not_empty"),
    RowCheck("num_value_not_null", "num", "value", criticality="warn"),
    RowCheck("num_tag_not_null", "num", "tag"),
)
FILED_REQUIRED = {"sub": ("adsh", "cik", "form"), "num": ("tag", "value")}


def split_by_check(df: DataFrame, check: RowCheck) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` rows of one check."""
    return df.filter(~check.violated()), df.filter(check.violated())


def check_table(df: DataFrame, table: str, checks: Sequence[RowCheck]) -> DataFrame:
    """Results of all checks on one table from one scan.

    A check whose column the table lacks gives an ``unevaluable`` row: a
    skipped check is neither a pass nor a count of bad rows.
    """
    mine = [c for c in checks if c.table == table]
    runnable = [c for c in mine if c.column in df.columns]
    absent = [c for c in mine if c.column not in df.columns]
    counted = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(c.violated()).alias(f"_bad_{i}") for i, c in enumerate(runnable)],
    )
    total = F.col("_total")
    rows = []
    for i, c in enumerate(runnable):
        bad = F.col(f"_bad_{i}")
        on_bad = "warn" if c.criticality == "warn" else "fail"
        rows.append(
            _result(
                c,
                outcome=F.when(bad > 0, on_bad).otherwise("pass"),
                total=total,
                good=total - bad,
                bad=bad,
                detail=F.format_string("%d bad rows out of %d", bad, total),
            )
        )
    none = F.lit(None).cast("bigint")
    for c in absent:
        why = F.lit(f"check skipped: column {c.column} is not in {table}")
        rows.append(_result(c, F.lit("unevaluable"), none, none, none, why))
    return counted.select(F.inline(F.array(*rows)))


def _result(c: RowCheck, outcome, total, good, bad, detail) -> Column:
    return F.struct(
        F.lit(c.name).alias("name"),
        F.lit(c.table).alias("table"),
        F.lit(c.column).alias("column"),
        F.lit(c.check_func).alias("check_func"),
        outcome.alias("outcome"),
        total.alias("total"),
        good.alias("good"),
        bad.alias("bad"),
        detail.alias("detail"),
    )


def overall_verdict(results: DataFrame, outcome: str = "outcome") -> DataFrame:
    """Worst outcome of a result frame and its exit code, as one row."""
    rank = F.coalesce(*[F.when(F.col(outcome) == v, F.lit(s)) for v, s in SEVERITY.items()])
    label = F.coalesce(*[F.when(F.col("_worst") == s, F.lit(v)) for v, s in SEVERITY.items()])
    code = F.coalesce(
        *[F.when(F.col("_worst") == SEVERITY[v], F.lit(x)) for v, x in EXIT_CODE.items()]
    )
    return results.agg(F.max(rank).alias("_worst")).select(
        label.alias("verdict"), code.alias("exit_code")
    )


def worst(outcomes: Sequence[str]) -> tuple[str, int]:
    """Driver-side twin of :func:`overall_verdict` for a handful of verdicts."""
    top = max((o.lower() for o in outcomes), key=SEVERITY.__getitem__)
    return top, EXIT_CODE[top]


def _total(rows: list[dict]) -> int:
    return max((r["total"] or 0 for r in rows), default=0)


def run_row_checks(
    tables: Mapping[str, DataFrame | Exception],
    checks: Sequence[RowCheck] = FILED_CHECKS,
    required: Mapping[str, Sequence[str]] = FILED_REQUIRED,
) -> list[dict]:
    """Preconditions, then every check; any failed precondition stops the run.

    ``tables`` maps a name to its frame, or to the error met while reading it.
    """

    def precondition(outcome: str, detail: str) -> dict:
        blank = dict.fromkeys(RESULT_COLUMNS)
        return {**blank, "name": "precondition", "outcome": outcome, "detail": detail}

    absent = sorted(t for t in required if t not in tables)
    if absent:
        return [precondition("unevaluable", f"missing data: {absent}")]
    for name, df in tables.items():
        if isinstance(df, Exception):
            return [precondition("unevaluable", f"{name} unreadable: {df}")]
    gaps = [
        f"{t} missing columns: {sorted(set(cols) - set(tables[t].columns))}"
        for t, cols in required.items()
        if set(cols) - set(tables[t].columns)
    ]
    if gaps:
        return [precondition("unevaluable", "; ".join(gaps))]
    try:
        results = []
        for t in required:
            rows = [r.asDict() for r in check_table(tables[t], t, checks).collect()]
            results.append((t, rows))
    except Exception as e:
        return [precondition("unevaluable", f"check execution failed: {e}")]
    for t, rows in results:
        if any(r["total"] == 0 for r in rows):
            return [precondition("unevaluable", f"{t} has zero rows -- nothing to gate")]
    counts = ", ".join(f"{t} readable ({_total(rows)} rows)" for t, rows in results)
    return [precondition("pass", counts)] + [r for _, rows in results for r in rows]
