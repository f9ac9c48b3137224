"""Fixtures in the shape of filed facts."""

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.model import FILED_FACTS, INGEST_TS, instant
from tidemark.plans.gold import run_batch

T1, T2 = "2023-05-01 12:00:00", "2023-08-01 12:00:00"


@dataclass(frozen=True)
class Filing:
    adsh: str
    cik: int
    tag: str
    value: str | None
    accepted: str
    ingest: str = "2023-05-02 00:00:00"
    ddate: int = 20230331
    qtrs: int = 1
    uom: str = "USD"
    segments: str = ""
    coreg: str = ""
    version: str = "v1"


def facts_frame(spark, filings):
    rows = [
        (
            f.adsh, f.tag, f.version, f.ddate, f.qtrs, f.uom, f.segments, f.coreg,
            None if f.value is None else Decimal(f.value), f.ingest,
        )
        for f in filings
    ]
    ddl = (
        "adsh string, tag string, version string, ddate int, qtrs int, uom string, "
        "segments string, coreg string, value decimal(28,4), _i string"
    )
    df = spark.createDataFrame(rows, ddl)
    return df.withColumn(INGEST_TS, F.col("_i").cast("timestamp_ntz")).drop("_i")


def filings_frame(spark, filings):
    rows = sorted({(f.adsh, f.cik, f.accepted) for f in filings})
    df = spark.createDataFrame(rows, "adsh string, cik bigint, _a string")
    return df.select("adsh", "cik", F.col("_a").cast("timestamp_ntz").alias("accepted"))


def load(lake, batch_id, filings):
    spark = lake.spark
    facts = facts_frame(spark, filings).withColumn("_batch_id", F.lit(batch_id))
    return run_batch(lake, facts, filings_frame(spark, filings), batch_id, filings[0].ingest)


def silver_rows(spark, rows):
    """Typed silver rows ``(adsh, tag, version, ddate, qtrs, uom, value[, ingest])``."""
    ddl = ", ".join(f"{n} {t}" for n, t in FILED_FACTS.fact_types.items())
    typed = [tuple(r[:6]) + (None if r[6] is None else Decimal(r[6]),) for r in rows]
    df = spark.createDataFrame(typed, ddl)
    return df if len(rows[0]) == 7 else df.withColumn(INGEST_TS, instant(rows[0][7]))
