"""The batch gate: three outcomes, and a check that cannot run never passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import Contract

PASS, FAIL, UNEVALUABLE = "Pass", "Fail", "Unevaluable"

DETAIL_SCHEMA = "check string, constraint string, target string, violations bigint"


@dataclass(frozen=True)
class Violation:
    constraint: str
    target: str
    count: int


@dataclass(frozen=True)
class Outcome:
    """Verdict over one batch; ``violations`` only on Fail, ``reason`` only on Unevaluable."""

    label: str
    reason: str = ""
    violations: tuple[Violation, ...] = field(default=())

    def detail(self, spark: SparkSession, contract: Contract) -> DataFrame:
        rows = [(contract.name, v.constraint, v.target, v.count) for v in self.violations]
        return spark.createDataFrame(rows, DETAIL_SCHEMA)

    def message(self) -> str:
        """All violations in one line; there are as many as rules."""
        return "; ".join(f"{v.constraint}({v.target})={v.count}" for v in self.violations)


class QualityHalt(RuntimeError):
    """A batch was refused; the outcome says why."""

    def __init__(self, outcome: Outcome):
        self.outcome = outcome
        text = outcome.reason if outcome.label == UNEVALUABLE else outcome.message()
        super().__init__(f"DQ gate {outcome.label.lower()}: {text}")


def missing_source_columns(source: DataFrame, required: Sequence[str]) -> str | None:
    """Reason text when a needed source column is absent.

    Must run before typed casts, which would turn an absent column into NULLs
    and so make "missing" look like "incomplete".
    """
    absent = [c for c in required if c not in source.columns]
    return "missing source column(s): " + ", ".join(absent) if absent else None


def type_mismatches(schema: T.StructType, types: Mapping[str, str]) -> str | None:
    found = {f.name: f.dataType.simpleString() for f in schema.fields}
    wrong = []
    for name, ddl in types.items():
        if name not in found:
            wrong.append(f"missing column {name}")
        elif found[name] != ddl:
            wrong.append(f"column {name} is {found[name]}, expected {ddl}")
    return "; ".join(wrong) or None


def contract_counts(batch: DataFrame, contract: Contract) -> DataFrame:
    """One row with the batch size and the violation count of every rule.

    Rows are folded per unique key first (partial counts merge before the
    shuffle, so a heavily repeated key costs one row per task), which gives
    key and column rules in a single pass.  NULL keys group together.
    """
    rules = {f"completeness:{c}": F.col(c).isNull() for c in contract.complete}
    rules |= {f"non-negative:{c}": F.col(c) < 0 for c in contract.non_negative}
    counters = [F.count(F.lit(1)).alias("rows")]
    counters += [F.count_if(broken).alias(name) for name, broken in rules.items()]
    if not contract.unique:
        return batch.agg(*counters)
    per_key = batch.groupBy(*contract.unique).agg(*counters)
    return per_key.agg(
        *[F.coalesce(F.sum(f"`{n}`"), F.lit(0)).alias(n) for n in ("rows", *rules)],
        F.count_if(F.col("rows") > 1).alias(_unique_rule(contract)),
    )


def _unique_rule(contract: Contract) -> str:
    return "uniqueness:" + ",".join(contract.unique)


def _rules(contract: Contract) -> list[tuple[str, str]]:
    """``(constraint, target)`` of every rule, in report order."""
    out = [("completeness", c) for c in contract.complete]
    if contract.unique:
        out.append(("uniqueness", ",".join(contract.unique)))
    return out + [("non-negative", c) for c in contract.non_negative]


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups with more than one row; NULL keys group together.

    Partial counts are merged before the shuffle, so one heavily repeated key
    costs one row per task.
    """
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def duplicate_group_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return duplicate_groups(df, keys).agg(F.count(F.lit(1)).alias("violations"))


def excess_row_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each duplicate group."""
    return duplicate_groups(df, keys).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("violations")
    )


def violation_frame(batch: DataFrame, contract: Contract) -> DataFrame:
    """Lazy form of the gate's evidence: ``(check, constraint, target, violations)``.

    Only rules that are violated give a row.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(kind).alias("constraint"),
                F.lit(target).alias("target"),
                F.col(f"`{kind}:{target}`").alias("violations"),
            )
            for kind, target in _rules(contract)
        ]
    )
    return (
        contract_counts(batch, contract)
        .select(F.inline(rows))
        .filter("violations > 0")
        .select(F.lit(contract.name).alias("check"), "constraint", "target", "violations")
    )


@dataclass(frozen=True)
class Judged:
    """Outcome of the gate and the number of rows it looked at."""

    outcome: Outcome
    rows: int = 0


def judge(batch: DataFrame, contract: Contract) -> Judged:
    """Judge a typed batch in one pass over it."""
    wrong = type_mismatches(batch.schema, contract.types)
    if wrong:
        return Judged(Outcome(UNEVALUABLE, wrong))
    try:
        counted = contract_counts(batch, contract).first().asDict()
    except Exception as e:  # fail closed: what cannot be evaluated is never a pass
        return Judged(Outcome(UNEVALUABLE, f"analyzer error: {type(e).__name__}: {e}"))
    if counted["rows"] == 0:
        return Judged(Outcome(UNEVALUABLE, "empty batch where rows expected"))
    return Judged(outcome_of(counted, contract), counted["rows"])


def outcome_of(counted: Mapping[str, int], contract: Contract) -> Outcome:
    """Pass or Fail from the violation count of every rule."""
    found = [Violation(kind, t, counted[f"{kind}:{t}"] or 0) for kind, t in _rules(contract)]
    violated = tuple(v for v in found if v.count)
    return Outcome(FAIL, violations=violated) if violated else Outcome(PASS)


def counters(contract: Contract, nth: Column) -> list[Column]:
    """The gate as plain aggregates, to be observed while a batch is written.

    ``nth`` numbers the rows of each unique key: every key that is not unique
    has exactly one second row.
    """
    rules = {f"completeness:{c}": F.col(c).isNull() for c in contract.complete}
    rules |= {f"non-negative:{c}": F.col(c) < 0 for c in contract.non_negative}
    if contract.unique:
        rules[_unique_rule(contract)] = nth == 2
    found = [F.count(F.lit(1)).alias("rows")]
    return found + [F.count_if(broken).alias(name) for name, broken in rules.items()]


def gate(batch: DataFrame, contract: Contract) -> Outcome:
    return judge(batch, contract).outcome
