"""Point-in-time fact tables on Spark: what was known on a given date."""

from tidemark.model import FILED_FACTS, OPEN_END, Contract, FactModel
from tidemark.operators.audit import interval_report, run_audit
from tidemark.operators.intervals import (
    as_of,
    as_of_ranked,
    attach_filings,
    build_intervals,
    plan_interval_slices,
    validity_intervals,
)
from tidemark.operators.quality import QualityHalt, gate
from tidemark.plans.backfill import backfill
from tidemark.plans.gold import rebuild_gold, run_batch
from tidemark.plans.ingest import ingest_quarter
from tidemark.plans.lake import Lake
from tidemark.plans.publish import Published, write_audit_publish
from tidemark.plans.silver import run_silver
from tidemark.sources.tables import VersionedTable

__all__ = [
    "Contract",
    "FILED_FACTS",
    "FactModel",
    "Lake",
    "OPEN_END",
    "Published",
    "QualityHalt",
    "VersionedTable",
    "as_of",
    "as_of_ranked",
    "attach_filings",
    "backfill",
    "build_intervals",
    "gate",
    "ingest_quarter",
    "interval_report",
    "plan_interval_slices",
    "rebuild_gold",
    "run_audit",
    "run_batch",
    "run_silver",
    "validity_intervals",
    "write_audit_publish",
]
