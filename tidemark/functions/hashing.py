"""Hash expressions: row hash, canonical JSON, table fingerprint."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def row_hash(names: Sequence[str], injective: bool = True) -> Column:
    """SHA-256 over the text of ``names`` in the given order.

    The default encoding writes ``<length>:<text>`` per value and ``N`` for
    NULL, so no two different rows encode alike.  ``injective=False`` gives the
    plain form: texts run together, NULL read as one space.
    """
    texts = [F.col(n).cast("string") for n in names]
    if injective:  # one flat concat: no text is copied twice
        parts = [p for t in texts for p in _encoded(t)]
    else:
        parts = [F.coalesce(t, F.lit(" ")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _encoded(t: Column) -> tuple[Column, Column, Column]:
    """``<length>``, ``:`` and the text; ``N`` and nothing more for NULL."""
    mark = F.when(t.isNull(), F.lit("")).otherwise(F.lit(":"))
    return F.coalesce(F.length(t).cast("string"), F.lit("N")), mark, F.coalesce(t, F.lit(""))


def exact_sum(number: Column) -> Column:
    """Sum of 64-bit numbers, read as unsigned, as a decimal(38,0); NULL without rows.

    Pieces of 22 bits are summed as plain numbers, which 2^41 rows cannot overflow;
    a sum of decimals makes an object for every row.
    """
    total = F.lit(0).cast("decimal(38,0)")
    for at in (0, 22, 44):
        piece = F.shiftrightunsigned(number, at).bitwiseAND(F.lit((1 << 22) - 1))
        weight = F.lit(1 << at).cast("decimal(15,0)")
        total = total + F.sum(piece).cast("decimal(20,0)") * weight
    return total.cast("decimal(38,0)")


def canonical_json(entries: Column) -> Column:
    """A map<string,string> as a JSON object with its keys in sorted order."""
    ordered = F.map_from_entries(F.array_sort(F.map_entries(entries)))
    return F.to_json(ordered)


def json_field(text: Column, key: str) -> Column:
    """Value of one (possibly dotted) top-level key of a flat JSON object."""
    return F.get_json_object(text, f"$['{key}']")


def content_fingerprint(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """One row ``(n_rows, content_hash)`` that does not depend on row order.

    Each row contributes the first 60 bits of the SHA-256 of its encoded
    columns; the sum is a map-side aggregate, so only one row per task moves.
    """
    names = [c for c in df.columns if c not in set(exclude)]
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in names])  # each written out once
    bits = F.conv(F.substring(row_hash(names), 1, 15), 16, 10).cast("bigint")
    return texts.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(exact_sum(bits), F.lit(0).cast("decimal(38,0)")).cast("string").alias("content_hash"),
    )
