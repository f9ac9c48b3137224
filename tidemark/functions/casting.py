"""Typed projections that turn uncastable text into NULL instead of an error."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import BATCH_ID, INGEST_TS, FactModel

_WHOLE_WITH_FRACTION = r"^\s*[+-]?\d+\.\d*\s*$"


def typed(column: str, ddl: str, source: T.DataType | None = None) -> Column:
    """``column`` as ``ddl``; NULL where the text does not parse.

    Integer targets also accept text such as ``20230331.0`` and drop the
    fraction, which is what non-ANSI Spark casts do.
    """
    c = F.col(column)
    cast = c.try_cast(ddl)
    if isinstance(source, T.StringType) and ddl in ("int", "bigint"):
        head = F.when(c.rlike(_WHOLE_WITH_FRACTION), F.substring_index(F.trim(c), ".", 1))
        cast = F.coalesce(cast, head.try_cast(ddl))
    return cast


def cast_declared(df: DataFrame, types: Mapping[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Project ``df`` to the declared types; a column it lacks becomes a typed NULL.

    Columns named in ``keep`` ride along when present; everything else is dropped.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    out = [
        (typed(name, ddl, present[name]) if name in present else F.lit(None).cast(ddl)).alias(name)
        for name, ddl in types.items()
    ]
    return df.select(*out, *[F.col(k) for k in keep if k in present and k not in types])


def cast_facts(df: DataFrame, model: FactModel) -> DataFrame:
    """Typed facts with their load provenance."""
    return cast_declared(df, model.fact_types, keep=(INGEST_TS, BATCH_ID))


def cast_filings(df: DataFrame, model: FactModel) -> DataFrame:
    """The typed filing columns the interval build joins on."""
    return cast_declared(df, model.filing_types, keep=(INGEST_TS,))
