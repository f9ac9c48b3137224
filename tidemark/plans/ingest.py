"""Source files of one quarter into bronze, with a content-derived batch id."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casting import cast_filings
from tidemark.functions.hashing import row_hash
from tidemark.functions.identity import batch_manifest, model_schema_version
from tidemark.model import BATCH_ID, INGEST_TS, ROW_HASH, SOURCE_FILE, instant
from tidemark.plans.lake import BatchRecord, Lake
from tidemark.sources.delimited import scan_declared, source_digests


@dataclass(frozen=True)
class Ingested:
    facts: DataFrame
    filings: DataFrame
    batch_id: str
    bronze_version: int


def with_audit_columns(
    df: DataFrame,
    batch_id: str | Column,
    source_file: str | Column,
    ingest_ts: str | Column,
    injective_hash: bool = True,
) -> DataFrame:
    """Load time, source, batch id, and a hash over the source columns in order."""
    hashed: Sequence[str] = df.columns
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.withColumns(
        {
            INGEST_TS: ingest_ts if isinstance(ingest_ts, Column) else instant(ingest_ts),
            SOURCE_FILE: as_col(source_file),
            BATCH_ID: as_col(batch_id),
            ROW_HASH: row_hash(hashed, injective_hash),
        }
    )


def ingest_quarter(
    lake: Lake,
    source_root: str,
    quarter: str,
    code_version: str,
    ingest_ts: str,
    facts_file: str = "num.txt",
    filings_file: str = "sub.txt",
) -> Ingested:
    """Load ``<source_root>/<quarter>`` into bronze and register the batch.

    Each source may be one file or a folder of part files.  The same bytes
    under the same code give the same batch id, and loading it again adds
    nothing.  The returned facts are read back from the columnar bronze table,
    so later stages never parse the text again.
    """
    spark, model = lake.spark, lake.model
    facts_path = f"{source_root}/{quarter}/{facts_file}"
    filings_path = f"{source_root}/{quarter}/{filings_file}"

    raw_facts = scan_declared(spark, facts_path, model.source_columns)
    raw_filings = scan_declared(spark, filings_path, model.filing_columns)

    digests = source_digests(spark, [facts_path, filings_path])
    hashes = [r["sha256"] for r in digests.select("sha256").collect()]  # one per file
    batch_id, manifest = batch_manifest(
        hashes, model_schema_version(model), code_version, {"quarter": quarter}
    )

    keys = [BATCH_ID, ROW_HASH]
    this_batch = F.col(BATCH_ID) == batch_id
    facts = with_audit_columns(raw_facts, batch_id, facts_file, ingest_ts)
    version = lake.bronze_facts.insert_new(
        _to_declared(facts, model.source_columns), keys, within=this_batch, label=batch_id
    )
    filings = with_audit_columns(raw_filings, batch_id, filings_file, ingest_ts)
    lake.bronze_filings.insert_new(
        _to_declared(filings, model.filing_columns), keys, within=this_batch, label=batch_id
    )
    lake.register(BatchRecord(batch_id, manifest, version))

    # A resend keeps its stored rows but counts as loaded now, as in any later stage.
    stored = lake.bronze_facts.read().filter(this_batch).select(*facts.columns)
    stored = stored.withColumn(INGEST_TS, instant(ingest_ts))
    stored_filings = lake.bronze_filings.read().filter(this_batch).drop(INGEST_TS)
    # a column the file lacks stays absent, so that the next stage can refuse the batch
    absent = [c for c in model.filing_types if c not in raw_filings.columns]
    typed_filings = cast_filings(stored_filings, model).drop(*absent)
    return Ingested(stored, typed_filings, batch_id, version)


def _to_declared(df: DataFrame, declared: Sequence[str]) -> DataFrame:
    """Bronze has one schema; a column the file lacks is stored as NULL text."""
    missing = {c: F.lit(None).cast("string") for c in declared if c not in df.columns}
    audit = [INGEST_TS, SOURCE_FILE, BATCH_ID, ROW_HASH]
    return (df.withColumns(missing) if missing else df).select(*declared, *audit)
