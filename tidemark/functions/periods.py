"""Quarter names and day-based timestamp shifts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The name of a quarter, and the same name inside a listing link.
QUARTER_NAME = r"^\d{4}q[1-4]$"
QUARTER_LINK = r"(\d{4}q[1-4])\.zip"
DAYS_PER_YEAR = 365


def quarter_of(ts: Column) -> Column:
    """``1998q3`` for an instant in the third quarter of 1998."""
    return F.concat(F.year(ts).cast("string"), F.lit("q"), F.quarter(ts).cast("string"))


def is_quarter_name(text: Column) -> Column:
    return text.rlike(QUARTER_NAME)


def listed_quarters(lines: DataFrame, text: str) -> DataFrame:
    """Distinct quarter names linked anywhere in a listing, one per row."""
    found = F.regexp_extract_all(F.col(text), F.lit(QUARTER_LINK), F.lit(1))
    return lines.select(F.explode(found).alias("quarter")).distinct()


def shift_years(ts: Column, years: int) -> Column:
    """``ts`` moved by ``years`` × 365 days (days, not calendar years)."""
    return ts + F.make_dt_interval(F.lit(DAYS_PER_YEAR * years))
