"""The set of tables one engine instance works on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.frames import one_row
from tidemark.model import BATCH_ID, FILED_FACTS, FactModel
from tidemark.sources.tables import VersionedTable

REGISTRY_SCHEMA = "batch_id string, manifest_json string, delta_version bigint"
UNEVALUABLE_SCHEMA = "batch_id string, reason string"


@dataclass(frozen=True)
class BatchRecord:
    batch_id: str
    manifest_json: str
    delta_version: int


class Lake:
    """Bronze, silver, gold, quarantine lanes and registry under one root."""

    def __init__(self, spark: SparkSession, root: str, model: FactModel = FILED_FACTS):
        self.spark, self.root, self.model = spark, root.rstrip("/"), model
        self.bronze_facts = self._table("bronze/facts")
        self.bronze_filings = self._table("bronze/filings")
        # merges and the join of facts with their filings meet their rows where they lie,
        # and one entity's gold lies in one folder
        self.silver = self._table("silver", keyed=(model.link,))
        self.filing_index = self._table("silver_filings", keyed=(model.link,))
        self.gold = self._table("gold", split_by=model.natural_key[0])
        self.registry = self._table("registry")
        # Four lanes because their rows have four shapes.
        self.quarantine_rows = self._table("quarantine/rows")
        self.quarantine_filings = self._table("quarantine/filings")
        self.quarantine_detail = self._table("quarantine/detail")
        self.quarantine_unevaluable = self._table("quarantine/unevaluable")

    def _table(self, name: str, **layout) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/{name}", **layout)

    def register(self, record: BatchRecord) -> None:
        """Record a batch; registering it again moves its retrieval version."""
        cells = (record.batch_id, record.manifest_json, record.delta_version)
        row = one_row(self.spark, cells, REGISTRY_SCHEMA)
        self.registry.merge(row, ["batch_id"], num_source=1, source_unique=True)

    def lookup(self, batch_id: str) -> BatchRecord | None:
        if not self.registry.exists():
            return None
        row = self.registry.read().filter(F.col("batch_id") == batch_id).first()
        return BatchRecord(**row.asDict()) if row else None

    def replay(self, batch_id: str) -> DataFrame:
        """A batch's bronze rows as of the version the registry recorded for it."""
        record = self.lookup(batch_id)
        if record is None:
            raise LookupError(f"batch {batch_id} is not registered")
        bronze = self.bronze_facts.read(record.delta_version)
        return bronze.filter(F.col(BATCH_ID) == batch_id)
