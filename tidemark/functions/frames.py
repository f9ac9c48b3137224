"""Small frames built from driver values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def one_row(spark: SparkSession, values: Sequence, ddl: str) -> DataFrame:
    """One provenance row with an explicit schema, as literals in one partition."""
    schema = T.StructType.fromDDL(ddl)
    if len(values) != len(schema):
        raise ValueError(f"{len(values)} values for {len(schema)} columns")
    cells = [
        F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, schema.fields, strict=True)
    ]
    return spark.range(0, 1, 1, 1).select(*cells)
