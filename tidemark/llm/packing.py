"""Packing by power-of-two decomposition: no sequence crosses documents, and none is padded.

A document's tokens are cut into pieces of binary lengths, the longest first.
Every piece is a sequence of its own; sequences of one length form a bucket,
and a batch is drawn from one bucket.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts_of
from tidemark.llm.units import BYTE_BPE_PATH, ByteBpe, UnitMemory, known_units

#: Tokens of the longest sequence, a power of two.
LONGEST = 1024
#: Id that ends every document.
END_ID = 0

PIECES = "start long, length int, doc_tokens long, ids_crc32 long, ids array<int>"


def binary_lengths(tokens: int, longest: int = LONGEST) -> list[int]:
    """Powers of two that add up to ``tokens``, none above ``longest``, descending."""
    whole, rest = divmod(tokens, longest)
    bits = (1 << k for k in reversed(range(longest.bit_length() - 1)))
    return [longest] * whole + [b for b in bits if rest & b]


_ENCODERS: dict[bytes, UnitMemory] = {}


def _encoder(data: str) -> UnitMemory:
    """Packed ids of units, made once per worker."""
    key = hashlib.sha256(data.encode()).digest()
    if key not in _ENCODERS:
        bpe = ByteBpe(data, special_as_text=False)

        def learn(memory, new):
            for unit, ids in zip(new, bpe.encode(new), strict=True):
                memory[unit] = ids.astype("<u4", copy=False).tobytes()

        _ENCODERS.clear()
        _ENCODERS[key] = UnitMemory(learn)
    return _ENCODERS[key]


def _encoded(texts, memory: UnitMemory):
    """Packed ids of every text, the end id last."""
    end = np.array([END_ID], "<u4").tobytes()
    coded = bytearray()
    for units, last in known_units(texts, memory):
        coded += b"".join(map(memory.__getitem__, units))
        if last:
            yield bytes(coded + end)
            coded.clear()


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str = BYTE_BPE_PATH,
    longest: int = LONGEST,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, ids_crc32, ids, sequence_id, offset``.

    ``start`` counts the document's ids before the piece, ``doc_tokens`` all of
    them, the end id included.  A piece fills its sequence from offset 0, so
    ``sequence_id`` names the piece; ids are unique in one run over the table.
    A null or empty text is the end id alone.  Every row is packed, those that
    repeat an id or a text too; other columns are ignored; no rows give none.
    A very long text is read in slices: a task holds its ids, not more.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    with open(tokenizer_path, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        memory = _encoder(shared.value)
        for batch in batches:
            waiting: list[tuple[int, bytes]] = []
            size = 0
            for row, coded in enumerate(_encoded(texts_of(batch, 1), memory)):
                waiting.append((row, coded))
                size += len(coded)
                if size > 8 << 20:
                    yield _pieces(batch.column(0), waiting, longest)
                    waiting, size = [], 0
            yield _pieces(batch.column(0), waiting, longest)

    pieces = rows.mapInArrow(run, f"doc_id {id_type}, {PIECES}")
    return pieces.withColumns(
        {"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")}
    )


def _pieces(ids: pa.Array, coded: list[tuple[int, bytes]], longest: int) -> pa.RecordBatch:
    """The pieces of some documents, given by row number and packed ids."""
    row, start, length, total, crc = [], [], [], [], []
    for k, data in coded:
        at, tokens = 0, len(data) // 4
        for n in binary_lengths(tokens, longest):
            row.append(k)
            start.append(at)
            length.append(n)
            total.append(tokens)
            crc.append(zlib.crc32(memoryview(data)[4 * at : 4 * (at + n)]))
            at += n
    values = np.frombuffer(b"".join(data for _, data in coded), "<i4")
    offsets = np.r_[0, np.cumsum(length, dtype=np.int64)].astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(row, pa.int64())),
            pa.array(start, pa.int64()),
            pa.array(length, pa.int32()),
            pa.array(total, pa.int64()),
            pa.array(crc, pa.int64()),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32())),
        ],
        ["doc_id", *(column.split()[0] for column in PIECES.split(", "))],
    )


def write_buckets(packed: DataFrame, path: str) -> None:
    """Sequences as one folder per length; Spark splits large buckets and joins small ones."""
    packed.hint("rebalance", "length").write.partitionBy("length").parquet(path)
