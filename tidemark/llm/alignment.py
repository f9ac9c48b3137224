"""Cross-tokenizer alignment with corpus-wide link counts by external spill counting.

Two tokenizers cut the same bytes; two tokens are linked where their byte
ranges overlap.  A task reads documents in blocks and spills a block's
pair-document records as zstandard runs, one for each radix partition of the
second tokenizer's ids, sorted by pair.  A heap merges the runs of a partition
in order of the second id, so that the counts of one id pass together and
yield its maximum; what is counted streams back along the runs of the same
partition into sums per document.

Pairs are summed within a block before they are exchanged, and runs are merged
in rounds of bounded width: a pair that stands in every document is one entry
per block, then one per round.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged, texts_of
from tidemark.llm.units import BYTE_BPE_PATH, ByteBpe, UnitMemory, known_units

PIECE_PATH = "/opt/tokenizers/piece_bpe_32k.model"
WORD_MARK = "▁"
#: Bytes of text and number of documents that close a block.
BLOCK_BYTES, BLOCK_DOCS = 8 << 20, 50_000
#: Radix partitions, by the low bits of the second id.
PARTS = 64
#: Runs that one heap merges, and runs that one task of the way back takes, on average.
FAN_IN, TASK_RUNS = 512, 4096

#: A pair as one number: the second id above, the first one in the low bits.
LOW = 20

DIGEST = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
RUN = "block long, part int, pairs binary, records binary"


class Alignment(NamedTuple):
    """Documents with their sums, and the corpus-wide links of every id pair."""

    documents: DataFrame
    pairs: DataFrame


# -- runs --------------------------------------------------------------------


def _pack(*columns: np.ndarray) -> bytes:
    """Sorted first column as gaps, all columns in narrow types, compressed."""
    first, *rest = columns
    gaps = np.diff(first, prepend=0)
    parts = []
    for values in (gaps, *rest):
        size = next((s for s in (1, 2, 4) if values.max(initial=0) < 1 << 8 * s), 8)
        parts.append(bytes([size]) + values.astype(f"<u{size}").tobytes())
    head = np.array([len(columns), *map(len, parts)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(parts))


def _unpack(data: bytes) -> list[np.ndarray]:
    """The columns that ``_pack`` was given."""
    data = zstandard.ZstdDecompressor().decompress(data)
    count = int(np.frombuffer(data, "<i8", 1)[0])
    sizes = np.frombuffer(data, "<i8", count, 8)
    at, out = 8 * (count + 1), []
    for size in sizes.tolist():
        out.append(np.frombuffer(data, f"<u{data[at]}", (size - 1) // data[at], at + 1).astype(np.int64))
        at += size
    out[0] = np.cumsum(out[0])
    return out


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][: len(keys)])
    return keys[start], np.add.reduceat(counts[order], start) if len(start) else counts[:0]


# -- units -------------------------------------------------------------------


class UnitAligner:
    """Both tokenizations of text units and the links between their tokens."""

    def __init__(self, byte_bpe: str, piece_model: bytes):
        self.a = ByteBpe(byte_bpe, special_as_text=True)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if " " in piece.replace(WORD_MARK, " ").lstrip(" "):
                raise ValueError("a piece crosses a unit border")
            own = bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else None
            self.bytes_b.append(own or piece.replace(WORD_MARK, " ").encode())
        # a unit is encoded behind a word that it cannot join, as inside a text
        self.lead = "a"
        if len(self.b.encode(self.lead)) != 1 or max(map(len, (self.a.bytes, self.bytes_b))) > 1 << LOW:
            raise ValueError("the vocabularies do not fit")
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.clear()
        self.memory = UnitMemory(self.learn)

    def clear(self) -> None:
        """Forget all units."""
        self.groups: list[str | None] = []
        self.sums: list[np.ndarray] = []
        self.links: list[np.ndarray] = []

    def learn(self, memory: UnitMemory, new: list[str]) -> None:
        """Number new units; a unit that does not come back as it was has no groups."""
        if not memory:
            self.clear()
        first = len(self.groups)
        codes_a = self.a.encode(new)
        codes_b = [x[1:] for x in self.b.encode([self.lead + u for u in new], num_threads=1)]
        whole = []
        for k, (unit, a, b) in enumerate(zip(new, codes_a, codes_b, strict=True)):
            memory[unit] = first + k
            raw = unit.encode()
            same = raw == b"".join([self.a.bytes[i] for i in a.tolist()])
            whole.append(same and raw == b"".join([self.bytes_b[i] for i in b]))
        a = np.concatenate(codes_a).astype(np.int64)
        b = np.array([i for c in codes_b for i in c], np.int64)
        of_a = np.repeat(np.arange(len(new)), [len(c) for c in codes_a])
        of_b = np.repeat(np.arange(len(new)), [len(c) for c in codes_b])
        good = np.array(whole, bool)
        a, of_a, b, of_b = a[good[of_a]], of_a[good[of_a]], b[good[of_b]], of_b[good[of_b]]
        end_a, end_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.size_b[b])
        start_b = end_b - self.size_b[b]
        # tokens of the first side under each token of the second
        lo = np.searchsorted(end_a, start_b, "right")
        hi = np.searchsorted(end_a - self.a.sizes[a], end_b, "left")
        count = hi - lo
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        linked = np.repeat(b << LOW, count) | a[np.repeat(lo, count) + at]
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        unit_of = of_a[np.searchsorted(end_a, common)]
        n = len(new)
        sums = [np.bincount(x, minlength=n) for x in (of_a, of_b, unit_of)]
        sums.append(np.bincount(of_b, count, minlength=n).astype(np.int64))
        self.sums.append(np.column_stack(sums))
        cuts = np.cumsum(sums[3])[:-1]
        self.links.extend(np.split(linked, cuts))
        # group text, unit by unit
        in_a = np.r_[0, np.searchsorted(end_a, common) + 1]
        in_b = np.r_[0, np.searchsorted(end_b, common) + 1]
        text_a, text_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        one = [
            f"{','.join(text_a[i:j])}|{','.join(text_b[p:q])}"
            for i, j, p, q in zip(
                in_a[:-1].tolist(), in_a[1:].tolist(), in_b[:-1].tolist(), in_b[1:].tolist(), strict=True
            )
        ]
        ends = np.cumsum(sums[2]).tolist()
        for k in range(n):
            own = one[ends[k - 1] if k else 0 : ends[k]]
            self.groups.append(";".join(own) if whole[k] else None)

    def totals(self) -> np.ndarray:
        """Per unit: tokens of both sides, groups, links."""
        if len(self.sums) > 1:
            self.sums = [np.concatenate(self.sums)]
        return self.sums[0] if self.sums else np.zeros((0, 4), np.int64)


_ALIGNERS: dict[bytes, UnitAligner] = {}


def _aligner(byte_bpe: str, piece_model: bytes) -> UnitAligner:
    """Made once per worker."""
    key = hashlib.sha256(byte_bpe.encode() + piece_model).digest()
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = UnitAligner(byte_bpe, piece_model)
    return _ALIGNERS[key]


class _Document:
    """What is known of a document while its units pass."""

    def __init__(self):
        self.sums = np.zeros(4, np.int64)
        self.digest, self.begun, self.whole = hashlib.sha256(), False, True
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def take(self, units: list[str], aligner: UnitAligner) -> None:
        number = np.fromiter(map(aligner.memory.__getitem__, units), np.int64, len(units))
        own, count = np.unique(number, return_counts=True)
        groups = aligner.groups
        if not self.whole or None in {groups[k] for k in own.tolist()}:
            self.whole = False
            return
        text = ";".join([groups[k] for k in number.tolist()])
        self.digest.update(f";{text}".encode() if self.begun else text.encode())
        self.begun = True
        self.sums += count @ aligner.totals()[own]
        parts = [aligner.links[k] for k in own.tolist()]
        keys, n = _summed(np.concatenate(parts), np.repeat(count, [len(p) for p in parts]))
        self.keys.append(keys)
        self.counts.append(n)

    def row(self) -> tuple:
        if not (self.whole and self.begun):
            return 0, 0, 0, 0, ""
        return (*self.sums.tolist(), self.digest.hexdigest())

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.whole or not self.keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if len(self.keys) == 1:
            return self.keys[0], self.counts[0]
        return _summed(np.concatenate(self.keys), np.concatenate(self.counts))


def _documents(texts, aligner: UnitAligner) -> Iterator[tuple[int, _Document]]:
    """Each text's size and document; null and empty texts have no units."""
    doc, size = _Document(), 0
    led = (f" {t}" if t else None for t in texts)
    for units, last in known_units(led, aligner.memory):
        if units:
            doc.take(units, aligner)
            size += sum(map(len, units))
        if last:
            yield size, doc
            doc, size = _Document(), 0


def _runs(docs: list[_Document]) -> Iterator[tuple[int, bytes, bytes]]:
    """A block's records by radix partition: pairs with their sums; documents and counts by pair."""
    found = [d.pairs() for d in docs]
    sizes = [len(keys) for keys, _ in found]
    if not sum(sizes):
        return
    keys = np.concatenate([k for k, _ in found])
    counts = np.concatenate([n for _, n in found])
    doc = np.repeat(np.arange(len(docs)), sizes)
    part = (keys >> LOW) % PARTS
    order = np.lexsort((keys, part))  # stable: documents stay in order
    keys, counts, doc, part = keys[order], counts[order], doc[order], part[order]
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sums, of = np.add.reduceat(counts, start), np.diff(np.r_[start, len(keys)])
    edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    for lo, hi in zip(edges.tolist(), [*edges[1:].tolist(), len(keys)], strict=True):
        i, j = np.searchsorted(start, (lo, hi))
        pairs = _pack(keys[start[i:j]], sums[i:j], of[i:j])
        zero = np.zeros(hi - lo, np.int64)
        yield int(part[lo]), pairs, _pack(zero, doc[lo:hi], counts[lo:hi])


def _spill(docs: DataFrame, byte_bpe, piece_model, id_col: str, text_col: str) -> DataFrame:
    """Digest rows of documents (part null) and runs of blocks, in one table."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = [c.split()[0] for c in f"{DIGEST}, {RUN}".split(", ")]
    kinds = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches):
        aligner = _aligner(byte_bpe.value, piece_model.value)
        task, blocks = TaskContext.get().partitionId(), 0
        held: list[_Document] = []
        ids: list[pa.Array] = []
        size = 0

        def block():
            number = (task << 24) + blocks
            runs = list(_runs(held))
            rows = [(*d.row(), number, None, None, None) for d in held]
            rows += [(None,) * 5 + (number, *r) for r in runs]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            own = pa.concat_arrays([*ids, pa.nulls(len(runs), ids[0].type)])
            place = pa.array([*range(len(held)), *[None] * len(runs)], pa.int32())
            return pa.RecordBatch.from_arrays([own, place, *columns], ["doc_id", "place", *names])

        for batch in batches:
            begin = 0
            for k, (chars, doc) in enumerate(_documents(texts_of(batch, 1), aligner)):
                held.append(doc)
                size += chars
                if size >= BLOCK_BYTES or len(held) >= BLOCK_DOCS:
                    ids.append(batch.column(0).slice(begin, k + 1 - begin))
                    yield block()
                    blocks, begin, size = blocks + 1, k + 1, 0
                    held, ids = [], []
            if begin < batch.num_rows:
                ids.append(batch.column(0).slice(begin))
        if held:
            yield block()

    return rows.mapInArrow(run, f"doc_id {id_type}, place int, {DIGEST}, {RUN}")


# -- counting ----------------------------------------------------------------


def _merged(runs: list[list[np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """k-way heap merge of sorted (pairs, sums): all pairs of one second id at a time."""
    cuts, heap = [], []
    for k, (keys, *_) in enumerate(runs):
        side = keys >> LOW
        start = np.flatnonzero(np.r_[True, side[1:] != side[:-1]][: len(keys)])
        cuts.append([*start.tolist(), len(keys)])
        if len(keys):
            heap.append((int(side[0]), k, 0))
    heapq.heapify(heap)
    while heap:
        side, own = heap[0][0], []
        while heap and heap[0][0] == side:
            _, k, at = heap[0]
            lo, hi = cuts[k][at], cuts[k][at + 1]
            own.append((runs[k][0][lo:hi], runs[k][1][lo:hi]))
            if hi < len(runs[k][0]):
                heapq.heapreplace(heap, (int(runs[k][0][hi] >> LOW), k, at + 1))
            else:
                heapq.heappop(heap)
        if len(own) == 1:
            yield own[0]
        else:
            yield _summed(np.concatenate([x for x, _ in own]), np.concatenate([n for _, n in own]))


def _merge_runs(pdf: pd.DataFrame) -> pd.DataFrame:
    """One run out of many, with a mark at the largest counts of each second id."""
    found = list(_merged([_unpack(x)[:2] for x in pdf["pairs"]]))
    best = np.concatenate([(n == n.max()).astype(np.int64) for _, n in found])
    keys, sums = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    return pd.DataFrame(
        {"part": pdf["part"].iloc[:1], "slot": pdf["slot"].iloc[:1], "pairs": [_pack(keys, sums, best)]}
    )


def _counted(runs: DataFrame, blocks: int) -> DataFrame:
    """``part, counted``: one run per radix partition with the corpus-wide sums."""
    slots = -(-blocks // FAN_IN) or 1
    now = runs.select("part", F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int").alias("slot"), "pairs")
    while True:
        now = now.groupBy("part", "slot").applyInPandas(_merge_runs, "part int, slot int, pairs binary")
        now = staged(now, "alignment-merged")
        if slots == 1:
            return now.select("part", F.col("pairs").alias("counted"))
        slots = -(-slots // FAN_IN)
        now = now.withColumn("slot", F.pmod("slot", F.lit(slots)).cast("int"))


def _back(batches):
    """Contributions of counted pairs to the documents of each run."""
    last, counted = None, []
    for batch in batches:
        out = []
        for block, part, pairs, records, total in zip(*batch.columns, strict=True):
            if part.as_py() != last:
                last, counted = part.as_py(), _unpack(total.as_py())
            keys, _, of = _unpack(pairs.as_py())
            _, doc, n = _unpack(records.as_py())
            at = np.repeat(np.searchsorted(counted[0], keys), of)
            sums = np.zeros((2, doc.max() + 1), np.int64)
            np.add.at(sums[0], doc, counted[1][at] * n)
            np.add.at(sums[1], doc, counted[2][at] * n)
            used = np.flatnonzero(sums[0])
            out.append((block.as_py(), _pack(used, sums[0][used], sums[1][used])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([b for b, _ in out], pa.int64()), pa.array([s for _, s in out], pa.binary())],
            ["block", "sums"],
        )


def _by_document(pdf: pd.DataFrame) -> pd.DataFrame:
    """Sums of a block's documents over all radix partitions."""
    parts = [_unpack(x) for x in pdf["sums"]]
    size = max(int(p[0][-1]) for p in parts) + 1
    sums = np.zeros((2, size), np.int64)
    for used, count, best in parts:
        sums[0][used] += count
        sums[1][used] += best
    return pd.DataFrame(
        {"block": pdf["block"].iloc[0], "place": np.arange(size), "n_best": sums[1], "count_sum": sums[0]}
    )


def align_corpus(
    docs: DataFrame,
    byte_bpe_path: str = BYTE_BPE_PATH,
    piece_path: str = PIECE_PATH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Alignment:
    """Both tokenizations of every text, aligned, with counts over the corpus.

    ``documents`` holds, one row per document: ``doc_id, n_a, n_b, n_groups,
    n_links, groups_sha256, n_best, count_sum``; ``pairs`` one row per linked
    pair of ids: ``a_id, b_id, links, best`` (whether no other partner of the
    second id has more links).  A null or empty text, or one whose tokens do
    not spell a space and the text, has no tokens: zeros and an empty digest.
    Repeated rows and ids are documents of their own and all count; ties for
    the most links are all best; other columns are ignored; an empty table
    gives two empty ones.  A very long text is read in slices, and a task holds
    its distinct pairs, not its tokens.
    """
    spark = docs.sparkSession
    with open(byte_bpe_path, encoding="utf-8") as f:
        byte_bpe = spark.sparkContext.broadcast(f.read())
    with open(piece_path, "rb") as f:
        piece_model = spark.sparkContext.broadcast(f.read())
    spilled = staged(_spill(docs, byte_bpe, piece_model, id_col, text_col), "alignment-runs")
    runs = spilled.filter("part is not null")
    blocks = runs.select("block").distinct().count()
    counted = _counted(runs, blocks)

    # a radix partition of the way back is dealt to as many tasks as its runs need
    salts = -(-blocks // TASK_RUNS) or 1
    salt = F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt")
    every = counted.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    joined = runs.select("block", "part", "pairs", "records", salt).join(every, ["part", "salt"])
    joined = joined.select("block", "part", "pairs", "records", "counted")
    sums = joined.mapInArrow(_back, "block long, sums binary").groupBy("block")
    sums = sums.applyInPandas(_by_document, "block long, place int, n_best long, count_sum long")
    zero = F.lit(0).cast("long")
    documents = spilled.filter("part is null").join(sums, ["block", "place"], "left")
    documents = documents.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
    return Alignment(documents, counted.mapInArrow(_pair_rows, "a_id int, b_id int, links long, best boolean"))


def _pair_rows(batches):
    for batch in batches:
        for data in batch.column("counted"):
            keys, links, best = _unpack(data.as_py())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((keys & ((1 << LOW) - 1)).astype(np.int32)),
                    pa.array((keys >> LOW).astype(np.int32)),
                    pa.array(links),
                    pa.array(best.astype(bool)),
                ],
                ["a_id", "b_id", "links", "best"],
            )
