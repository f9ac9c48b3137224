"""Audit of a gold table: invariants that hold if and only if intervals are right.

All six table checks come out of one chain of aggregates.  Rows are first
folded per ``(key, valid_from, filing)``, then per ``(key, valid_from)``, then
per key.  When no key is large the frame is hashed by key once and every fold
reuses that partitioning; with large keys each fold shuffles its own, already
folded, input instead, so no task ever holds a whole key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import json_field
from tidemark.model import OPEN_FLOOR, FactModel, columns, instant
from tidemark.operators.rowchecks import EXIT_CODE, worst
from tidemark.operators.skew import SlicePlan, next_in_order, plan_slices

# Check names in report order.
CHECKS = (
    ("A1 no-lookahead", "lookahead"),
    ("A2 interval-shape", "inverted"),
    ("A2b empty-superseded", "orphan_empty"),
    ("A3 no-overlap", "overlapping"),
    ("A4 one-open-interval", "not_one_open"),
    ("A5 no-dup-fact", "duplicate_facts"),
)
REGISTRY_CHECK = "A6 registry-sane"


def plan_audit_slices(gold: DataFrame, model: FactModel, **options) -> SlicePlan | None:
    return plan_slices(gold, model.natural_key, ("valid_from",), **options)


def interval_counts(
    gold: DataFrame,
    model: FactModel,
    plan: SlicePlan | None = None,
    constant: Sequence[str] = (),
) -> DataFrame:
    """One row with the violation count of each table check.

    ``constant`` names key columns that hold one value in the whole frame, such
    as a literal.  Spark takes literals out of a grouping, which would then no
    longer fit a partitioning by them, so they are left out of the key; the
    counts are NULL if a column turns out not to be constant.

    * lookahead: valid before known, or either instant missing
    * inverted: ends before it starts (an empty interval is legal)
    * orphan_empty: empty interval with no non-empty interval of another filing
      starting at the same instant for the same key
    * overlapping: non-empty interval that runs past the next one of its key
    * not_one_open: keys that do not have exactly one open interval
    * duplicate_facts: rows beyond the first per key, start and filing
    """
    key, filing = [k for k in model.natural_key if k not in constant], model.link
    start, end = F.col("valid_from"), F.col("valid_to")
    rows = gold if plan else gold.repartition(*columns(key))
    n = F.count(F.lit(1))

    per_filing = rows.groupBy(*key, "valid_from", filing).agg(
        n.alias("n"),
        F.count_if(end == start).alias("empty"),
        F.count_if(end > start).alias("full"),
        F.count_if(F.coalesce(start < F.col(model.known_at), F.lit(True))).alias("lookahead"),
        F.count_if(end < start).alias("inverted"),
        F.count_if(end >= instant(OPEN_FLOOR)).alias("open"),
        F.max(F.when(end > start, end)).alias("full_end"),
        *_extremes(constant),
    )
    # a missing filing is no other filing: it never wins and never has a sibling
    is_winner = (F.col("full") > 0) & F.col(filing).isNotNull()
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    per_start = (
        per_filing.groupBy(*key, "valid_from")
        .agg(
            F.sum("lookahead").alias("lookahead"),
            F.sum("inverted").alias("inverted"),
            F.sum("open").alias("open"),
            F.sum("empty").alias("empty"),
            F.sum("full").alias("full"),
            F.max("full_end").alias("full_end"),
            F.sum("n").alias("_rows"),
            F.sum(F.col("n") - 1).alias("duplicate_facts"),
            F.count_if(is_winner).alias("winners"),
            F.sum(F.when(is_winner, F.col("empty")).otherwise(0)).alias("winner_empty"),
            F.sum(F.when(F.col(filing).isNull(), F.col("empty")).otherwise(0)).alias("lost_empty"),
            *_carried(constant),
        )
        .withColumn(
            "orphan_empty",
            # With one winning filing only its own empty rows lack a sibling
            # of another filing; with two or more winners none do.  A key with
            # a NULL in it equals no other row's key.
            F.when((F.col("winners") == 0) | no_key, F.col("empty"))
            .when(F.col("winners") == 1, F.col("winner_empty") + F.col("lost_empty"))
            .otherwise(F.col("lost_empty")),
        )
    )
    # Neighbours are compared among starts of the same kind, so an interval is
    # measured against the next non-empty one only.
    kinds = per_start.withColumn("_full", F.col("full") > 0)
    ahead = next_in_order(kinds, [*key, "_full"], ("valid_from",), "valid_from", plan, "_next")
    runs_over = F.coalesce((F.col("full_end") > F.col("_next")).cast("int"), F.lit(0))
    per_key = (
        ahead.withColumn(
            "overlapping", F.when(F.col("_full"), F.col("full") - 1 + runs_over).otherwise(0)
        )
        .groupBy(*key)
        .agg(
            *[F.sum(c).alias(c) for c in ("lookahead", "inverted", "orphan_empty", "open")],
            *[F.sum(c).alias(c) for c in ("overlapping", "duplicate_facts", "_rows")],
            *_carried(constant),
        )
    )
    total = [
        F.coalesce(F.sum(c), F.lit(0)).alias(c)
        for c in ("lookahead", "inverted", "orphan_empty", "overlapping", "duplicate_facts")
    ]
    counts = per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"),
        *total,
        F.count_if(F.col("open") != 1).alias("not_one_open"),
        *_carried(constant),
    )
    if not constant:
        return counts
    steady = reduce(lambda a, b: a & b, [F.col(f"_low_{c}").eqNullSafe(F.col(f"_high_{c}")) for c in constant])
    names = [c for c in counts.columns if not c.startswith(("_low_", "_high_"))]
    return counts.select(*[F.when(steady, F.col(c)).alias(c) for c in names])


def _extremes(constant: Sequence[str]) -> list[Column]:
    """Least and greatest of each column as text; a NULL beside a value differs from it."""
    shown = {c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in constant}
    low = [F.min(x).alias(f"_low_{c}") for c, x in shown.items()]
    return low + [F.max(x).alias(f"_high_{c}") for c, x in shown.items()]


def _carried(constant: Sequence[str]) -> list[Column]:
    low = [F.min(f"_low_{c}").alias(f"_low_{c}") for c in constant]
    return low + [F.max(f"_high_{c}").alias(f"_high_{c}") for c in constant]


def orphan_empty_rows(gold: DataFrame, model: FactModel) -> DataFrame:
    """The rows behind A2b: empty intervals nothing at the same instant replaced.

    Winners are folded to one row per key and instant before the anti-join, so
    a crowded instant is never compared pair by pair.
    """
    key, filing = list(model.natural_key), model.link
    winners = (
        gold.filter(F.col("valid_to") > F.col("valid_from"))
        .groupBy(*key, "valid_from")
        .agg(F.min(filing).alias("_low"), F.max(filing).alias("_high"))
        .alias("w")
    )
    same = (F.col("w._low") != F.col(f"e.{filing}")) | (F.col("w._high") != F.col(f"e.{filing}"))
    for k in (*key, "valid_from"):
        same = same & (F.col(f"w.{k}") == F.col(f"e.{k}"))
    empty = gold.filter(F.col("valid_to") == F.col("valid_from")).alias("e")
    return empty.join(winners, same, "left_anti")


def interval_report(
    gold: DataFrame,
    model: FactModel,
    plan: SlicePlan | None = None,
    constant: Sequence[str] = (),
) -> DataFrame:
    """``(check, verdict, violations)`` per table check, computed lazily.

    An empty table is unevaluable: nothing was audited.
    """
    counts = interval_counts(gold, model, plan, constant)
    rows = F.array(
        *[
            F.struct(F.lit(name).alias("check"), F.col(c).alias("violations"))
            for name, c in CHECKS
        ]
    )
    verdict = (
        F.when(F.coalesce(F.col("n_rows"), F.lit(0)) == 0, "UNEVALUABLE")
        .when(F.col("violations") == 0, "PASS")
        .otherwise("FAIL")
    )
    return counts.select("n_rows", F.inline(rows)).select(
        "check", verdict.alias("verdict"), "violations"
    )


def registry_counts(registry: DataFrame, param: str = "param.quarter") -> DataFrame:
    """Batches, distinct ids and distinct quarters of a batch registry."""
    return registry.agg(
        F.count(F.lit(1)).alias("batches"),
        F.countDistinct("batch_id").alias("distinct_ids"),
        F.countDistinct(json_field(F.col("manifest_json"), param)).alias("distinct_quarters"),
    )


def registry_report(registry: DataFrame) -> DataFrame:
    """The registry check: it has batches, unique ids, and one batch per quarter."""
    sane = (
        (F.col("batches") > 0)
        & (F.col("distinct_ids") == F.col("batches"))
        & (F.col("distinct_quarters") == F.col("batches"))
    )
    return registry_counts(registry).select(
        F.lit(REGISTRY_CHECK).alias("check"),
        F.when(sane, "PASS").otherwise("FAIL").alias("verdict"),
        "batches",
        "distinct_ids",
        "distinct_quarters",
    )


@dataclass(frozen=True)
class CheckResult:
    check: str
    verdict: str
    violations: int | None = None
    detail: str = ""


@dataclass(frozen=True)
class AuditOutcome:
    results: tuple[CheckResult, ...]

    @property
    def verdict(self) -> str:
        return {"pass": "GREEN", "fail": "RED", "unevaluable": "UNEVALUABLE"}[self._worst()]

    @property
    def exit_code(self) -> int:
        return EXIT_CODE[self._worst()]

    def count(self, name: str) -> int | None:
        return next((r.violations for r in self.results if r.check.startswith(name)), None)

    def _worst(self) -> str:
        return worst([r.verdict for r in self.results])[0]

    def frame(self, spark) -> DataFrame:
        rows = [(r.check, r.verdict, r.violations, r.detail) for r in self.results]
        return spark.createDataFrame(
            rows, "check string, verdict string, violations bigint, detail string"
        )

    def write_json(self, spark, path: str) -> None:
        """The machine-readable report: one line per check with the overall outcome."""
        self.frame(spark).withColumns(
            {"outcome": F.lit(self.verdict), "exit": F.lit(self.exit_code)}
        ).coalesce(1).write.mode("overwrite").json(path)


def run_audit(
    gold: DataFrame | Exception, model: FactModel, registry: DataFrame | None = None
) -> AuditOutcome:
    """Audit with a verdict; whatever cannot be evaluated halts, never passes.

    ``gold`` may be the error met while opening the table.
    """
    if isinstance(gold, Exception):
        return AuditOutcome((CheckResult("precondition", "UNEVALUABLE", detail=str(gold)),))
    missing = sorted(set(model.gold_columns) - set(gold.columns))
    if missing:
        why = f"gold missing columns: {missing}"
        return AuditOutcome((CheckResult("precondition", "UNEVALUABLE", detail=why),))
    try:
        plan = plan_audit_slices(gold, model)
        counts = interval_counts(gold, model, plan).first().asDict()
    except Exception as e:
        return AuditOutcome((CheckResult("precondition", "UNEVALUABLE", detail=f"query failed: {e}"),))
    if counts["n_rows"] == 0:
        why = "gold has zero rows -- nothing to audit"
        return AuditOutcome((CheckResult("precondition", "UNEVALUABLE", detail=why),))
    results = [CheckResult("precondition", "PASS", detail=f"{counts['n_rows']} rows")]
    for name, column in CHECKS:
        bad = counts[column]
        results.append(CheckResult(name, "FAIL" if bad else "PASS", bad))
    results.append(_audit_registry(registry))
    return AuditOutcome(tuple(results))


def _audit_registry(registry: DataFrame | None) -> CheckResult:
    if registry is None:
        return CheckResult(REGISTRY_CHECK, "UNEVALUABLE", detail="no registry table")
    try:
        row = registry_report(registry).first()
    except Exception as e:
        return CheckResult(REGISTRY_CHECK, "UNEVALUABLE", detail=f"query failed: {e}")
    detail = (
        f"batches={row['batches']} distinct_ids={row['distinct_ids']} "
        f"distinct_quarters={row['distinct_quarters']}"
    )
    return CheckResult(REGISTRY_CHECK, row["verdict"], detail=detail)
