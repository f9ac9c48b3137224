"""Consumer probes, and when a published effect may be credited."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.model import FactModel
from tidemark.operators.intervals import as_of


def probe(
    gold: DataFrame | Exception, model: FactModel, key: Mapping[str, object], at: str, expect
) -> tuple[bool, str]:
    """Whether the consumer path returns exactly one row with the expected value.

    A table that cannot be read fails the probe; that is what the control run
    before a publish is supposed to see.
    """
    try:
        if isinstance(gold, Exception):
            raise gold
        # At most two rows are needed to tell "one" from "several".
        rows = as_of(gold, at, **key).select(model.value, model.link).limit(2).collect()
    except Exception as e:
        return False, f"consumer path unreadable: {e}"
    if len(rows) == 1 and rows[0][0] is not None and _same(rows[0][0], expect):
        return True, f"as_of({at}) -> value={rows[0][0]} {model.link}={rows[0][1]}"
    seen = "at least 2 rows" if len(rows) > 1 else f"{len(rows)} row(s)"
    return False, f"as_of({at}) -> {seen}, expected exactly one == {expect}"


def _same(found, expect) -> bool:
    """Equality without a detour through floats: decimals differ in their last digit too."""
    if isinstance(found, Decimal):
        return found == Decimal(str(expect))
    return found == type(found)(expect)


def probe_all(gold: DataFrame, expected: DataFrame, model: FactModel, at: str | Column) -> DataFrame:
    """Many probes as one join: per expected row, rows found and whether it passes.

    ``expected`` holds the natural key and an ``expect`` column.
    """
    key = list(model.natural_key)
    found = (
        as_of(gold, at)
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n_found"), F.max(model.value).alias("_value"))
    )
    n = F.coalesce("n_found", F.lit(0).cast("bigint"))
    passed = F.coalesce((n == 1) & (F.col("_value") == F.col("expect")), F.lit(False))
    return expected.join(found, key, "left").select(
        *key, "expect", n.alias("n_found"), passed.alias("passed")
    )


def credit(records: DataFrame, claim: str = "claim") -> DataFrame:
    """Fold probe and control records per claim.

    ``records`` holds ``claim, role, passed``; a claim is credited only when
    its probe passed and its control ran and failed.
    """
    of = lambda role: F.when(F.col("role") == role, F.col("passed"))
    folded = records.groupBy(claim).agg(
        F.bool_and(of("probe")).alias("probe_passed"),
        (F.count_if(F.col("role") == "control") > 0).alias("control_ran"),
        F.bool_or(of("control")).alias("control_passed"),
    )
    credited = F.coalesce(F.col("probe_passed"), F.lit(False)) & F.coalesce(
        F.col("control_ran") & ~F.col("control_passed"), F.lit(False)
    )
    return folded.withColumn("credited", credited)
