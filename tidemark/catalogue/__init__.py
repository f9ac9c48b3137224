"""Registered queries: each engine operator over the given tables, with its SQL twin.

Every query reads whole tables.  The SQL twin states the same result in plain
SQL, written from the operator's meaning rather than from its plan.
"""

from tidemark.catalogue import hashes, intervals, jobs, merges, quality, refusals, verify  # noqa: F401
from tidemark.catalogue.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
