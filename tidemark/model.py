"""Plan-time description of a point-in-time fact table.

Operators never hard-code column names; they take a :class:`FactModel`.  A
model says which columns identify a fact row, which columns identify the thing
the fact is about, and in which order restatements of it became known.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# The instant stored for "still valid", and the floor from which
# a stored instant counts as open.
OPEN_END = "9999-12-31 00:00:00"
OPEN_FLOOR = "9999-01-01 00:00:00"

INGEST_TS = "_ingest_ts"
BATCH_ID = "_batch_id"
SOURCE_FILE = "_source_file"
ROW_HASH = "_src_row_hash"


def instant(text: str) -> Column:
    """A zoneless timestamp literal; every instant in the engine is zoneless."""
    return F.lit(text).cast("timestamp_ntz")


@dataclass(frozen=True)
class Contract:
    """Column and key rules a batch must meet before it is merged."""

    name: str
    complete: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    types: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class FactModel:
    """Names and keys of one fact table and the filing index it joins to."""

    name: str
    fact_types: Mapping[str, str]
    filing_types: Mapping[str, str]
    link: str
    fact_key: tuple[str, ...]
    natural_key: tuple[str, ...]
    known_at: str
    tiebreak: tuple[str, ...]
    value: str
    scope: tuple[str, ...] = ()
    extra_filing_columns: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    typed_required: tuple[str, ...] = ()

    @property
    def order(self) -> tuple[str, ...]:
        """Total restatement order inside one natural key; never arrival order."""
        return (self.known_at, *self.tiebreak)

    @property
    def source_columns(self) -> tuple[str, ...]:
        """Declared fact columns as they stand in the delimited source."""
        value_last = [c for c in self.fact_types if c != self.value]
        return (*value_last, *self.scope, self.value)

    @property
    def filing_columns(self) -> tuple[str, ...]:
        return (*self.filing_types, *self.extra_filing_columns)

    @property
    def row_required(self) -> tuple[str, ...]:
        """Columns that must hold a value for a row to be usable at all."""
        return (*self.fact_key, self.value)

    @property
    def gold_columns(self) -> tuple[str, ...]:
        return (
            *self.natural_key,
            self.value,
            self.known_at,
            *self.tiebreak,
            "valid_from",
            "valid_to",
        )

    @property
    def contract(self) -> Contract:
        needed = self.typed_required or (self.link, self.value)
        return Contract(
            name=f"silver-{self.name}",
            complete=tuple(needed),
            unique=self.fact_key,
            non_negative=self.non_negative,
            types={c: self.fact_types[c] for c in needed},
        )

    def renamed(self, **changes) -> "FactModel":
        from dataclasses import replace

        return replace(self, **changes)


def columns(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


# Preset for quarterly regulatory filings: one row per reported number, one
# row per filing.  The declared column names below are fixed by the publisher
# of the files.
FILED_FACTS = FactModel(
    name="num",
    fact_types={
        "adsh": "string",
        "tag": "string",
        "version": "string",
        "ddate": "int",
        "qtrs": "int",
        "uom": "string",
        "value": "decimal(28,4)",
    },
    filing_types={"adsh": "string", "cik": "bigint", "accepted": "timestamp_ntz"},
    link="adsh",
    fact_key=("adsh", "tag", "version", "ddate", "qtrs", "uom"),
    natural_key=("cik", "tag", "ddate", "qtrs", "uom"),
    known_at="accepted",
    tiebreak=("adsh", "version"),
    value="value",
    scope=("segments", "coreg"),
    extra_filing_columns=("name", "form", "period", "fy", "fp", "filed"),
    non_negative=("qtrs",),
    typed_required=("adsh", "tag", "uom", "value"),
)
