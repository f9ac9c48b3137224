"""Exact deduplication by exchange of Golomb-coded fingerprints.

Every source partition sends each owner its sorted fingerprints, Golomb coded.
The owner answers with one bit per fingerprint: seen elsewhere or not.  The bits
become one small bitmap over the rows' hashes, applied where the texts are read:
only the rows it names have their bytes shuffled, and equal bytes make a group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import golomb
from tidemark.llm.common import keep_once, staged, whole_text

#: Fingerprints that one owner holds; fixes the number of owners, not the result.
OWNER_ROWS = 2_000_000
#: Fingerprint values per row: a row without a twin is a suspect about once in so many.
SPREAD = 256
#: Most 64-bit words of the bitmap that names suspects; about 40 MB on an executor.
#: Up to some 4 million suspect hashes it has a word for four of them; with more it
#: lets more rows through to the byte comparison, which settles all of them.
FILTER_WORDS = 1 << 20

MESSAGE = "src int, owner int, n int, width int, unary binary, rest binary"


def _sent(h: np.ndarray, slots: int, owners: int):
    """Distinct fingerprints in order, each row's place among them, which of them
    several rows have, and each owner's range."""
    prints = np.mod(h.astype(np.uint64), np.uint64(slots * owners)).astype(np.int64)
    prints, place, counts = np.unique(prints, return_inverse=True, return_counts=True)
    bounds = np.searchsorted(prints, np.arange(owners + 1, dtype=np.int64) * slots)
    return prints, place, counts > 1, bounds


def suspects(rows: DataFrame, total: int) -> DataFrame:
    """Hashes ``h`` of rows whose fingerprint occurs again; ``rows`` holds h and src.

    A partition sends each fingerprint once, however many of its rows have it:
    that they are several it knows itself.
    """
    owners = max(1, -(-total // OWNER_ROWS))
    slots = max(1, -(-total * SPREAD // owners))

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        prints, _, _, bounds = _sent(pdf["h"].to_numpy(), slots, owners)
        out = []
        for owner in np.flatnonzero(np.diff(bounds)):
            part = prints[bounds[owner] : bounds[owner + 1]] - owner * slots
            out.append((pdf["src"].iloc[0], owner, len(part), *golomb.encode(part)))
        return pd.DataFrame(out, columns=["src", "owner", "n", "width", "unary", "rest"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        lists = [
            golomb.decode(*x) for x in pdf[["n", "width", "unary", "rest"]].itertuples(index=False)
        ]
        prints, inverse, counts = np.unique(
            np.concatenate(lists), return_inverse=True, return_counts=True
        )
        again = np.split(counts[inverse] > 1, np.cumsum([len(x) for x in lists])[:-1])
        bits = [np.packbits(x).tobytes() for x in again]
        return pd.DataFrame({"src": pdf["src"], "owner": pdf["owner"], "bits": bits})

    def pick(own: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        h = own["h"].to_numpy()
        _, place, again, bounds = _sent(h, slots, owners)
        for owner, bits in zip(replies["owner"], replies["bits"], strict=True):
            lo, hi = bounds[owner], bounds[owner + 1]
            again[lo:hi] |= np.unpackbits(np.frombuffer(bits, np.uint8))[: hi - lo].astype(bool)
        return pd.DataFrame({"h": np.unique(h[again[place]])})

    own = rows.groupBy("src")
    messages = own.applyInPandas(send, MESSAGE)
    replies = messages.groupBy("owner").applyInPandas(answer, "src int, owner int, bits binary")
    return own.cogroup(replies.groupBy("src")).applyInPandas(pick, "h long")


def named(texts: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``texts`` whose ``h`` is in ``found``, and few others; nothing is shuffled.

    ``found`` becomes a bitmap of at most ``FILTER_WORDS`` words, which is broadcast.
    """
    words = min(FILTER_WORDS, 1 << max(0, (found.count() // 4).bit_length()))
    word = F.col("h").bitwiseAND(F.lit(words - 1))
    bit = F.expr("shiftleft(1L, cast(shiftrightunsigned(h, 32) & 63 AS int))")
    marks = found.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    hit = texts.join(F.broadcast(marks), word == F.col("word"))
    return hit.filter(F.col("bits").bitwiseAND(bit) != 0).select(*texts.columns)


def duplicate_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are; null counts as empty, and empty texts
    are equal like any others.  The largest id of a group stays.  Rows that
    repeat an id and a text are each counted in ``group_size`` and share
    ``kept``.  A null id is smaller than any other.  Other columns are ignored;
    an empty table gives no rows.  Texts of any length are compared whole.
    """
    base = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("t"))
    base = base.withColumn("h", F.xxhash64("t"))
    rows = staged(
        base.select(
            "id", "h", F.sha2("t", 256).alias("sha"), F.spark_partition_id().alias("src")
        ),
        "exact-rows",
    )
    total = rows.count()
    found = staged(suspects(rows.select("h", "src"), total), "exact-suspects")
    groups = named(base, found).groupBy("h", "t").agg(
        F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("size")
    )
    groups = groups.filter("size > 1").select("h", F.sha2("t", 256).alias("sha"), "keep_id", "size")
    return rows.join(groups, ["h", "sha"], "left").select(
        F.col("id").alias("doc_id"),
        F.coalesce("keep_id", "id").alias("keep_id"),
        F.coalesce("size", F.lit(1)).alias("group_size"),
        (F.col("size").isNull() | F.col("id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, one row per distinct text, with all their columns.

    Of rows that repeat both the largest id and the text, one stays.
    """
    kept = duplicate_groups(docs, id_col, text_col).filter("kept")
    kept = kept.select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("mark"))
    return keep_once(docs, kept, id_col, F.sha2(whole_text(docs[text_col]), 256), "exact-kept")
