"""Repeated substrings by distributed prefix doubling over names.

The name of the string of length 2k at a position is made of the names of
length k there and k further on: 8 bytes are their own name, and pairs at
offsets 8, 9 and 25 give the names of 16, 25 and 50 bytes.  After each round
only positions that are not unique go on, until the threshold of 50 bytes:

1. Every 50-byte window stands for the smallest 25-byte name inside it.
   Neighbouring windows with the same one form a run; a run whose 25-byte name
   occurs in one document alone is unique and done.
2. The others are ranked by whole runs.  A run that also stands, byte for byte,
   in a document with a smaller id is repeated in all its windows.
3. What is left, the first of several different runs around the same 25 bytes,
   is ranked window by window.

Each round sends sorted names to their owners, Golomb coded, and gets back
marks.  Texts stay where they are, packed in blocks of a bucketed table; only
names travel.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemark.llm import golomb
from tidemark.llm.common import staged, texts_of, whole_text
from tidemark.session import scratch_folder

LENGTH, HALF = 50, 25
#: Windows that share one smallest name at most.
REACH = LENGTH - HALF + 1
#: Bytes of text in a block, and of the blocks in a bucket, on average.
BLOCK_BYTES, BUCKET_BYTES = 8 << 20, 16 << 20
#: Names that one owner holds, on average; fixes the number of owners, not the result.
OWNER_NAMES = 1_500_000
#: Bits of the names that are exchanged for runs and for windows.
RUN_BITS, WINDOW_BITS = 48, 62
#: Places that are hashed at once, so that the arrays stay in a core's cache.
PORTION = 1 << 14
#: Kind of the rows that hold a block's own groups.
OWN_RUNS = 9
#: Stands for a null id: before all others.
NO_ID = -(1 << 63)

MESSAGE = "src long, owner int, n int, width int, unary binary, rest binary"


def _mix(x: np.ndarray) -> np.ndarray:
    """Every bit of the result hangs on every bit of ``x``, one to one; works in place."""
    high = x >> np.uint64(30)
    x ^= high
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= np.right_shift(x, np.uint64(27), out=high)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= np.right_shift(x, np.uint64(31), out=high)
    return x


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit names of pairs of mixed names."""
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x ^= b
    return _mix(x)


def _words(data: bytes) -> np.ndarray:
    """The 8 bytes at every position, as numbers."""
    return np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))


def _mixed(words: np.ndarray) -> np.ndarray:
    # raw bytes differ in few bits: mixed one by one, or two changes could cancel
    return _mix(words + np.uint64(0x9E3779B97F4A7C15))


def _halves(eight: np.ndarray) -> np.ndarray:
    """Names of the 25-byte strings over a row of mixed words."""
    sixteen = _pair(eight[:-8], eight[8:])
    return _pair(sixteen[: 16 - HALF], sixteen[HALF - 16 :])


def names(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Names of all 25-byte and of all 50-byte strings of a text of 50 bytes or more."""
    half = _halves(_mixed(_words(data)))
    return half, _pair(half[:-HALF], half[HALF:])


#: Places and factors of the words in the second hash of a 50-byte string.
CHECKED = tuple(
    (k, np.uint64(factor))
    for k, factor in zip(
        (*range(0, LENGTH - 8, 8), LENGTH - 8),
        (
            0xD6E8FEB86659FD93,
            0xC2B2AE3D27D4EB4F,
            0xA0761D6478BD642F,
            0xE7037ED1A0B428DB,
            0x8EBC6AF09C88C6E3,
            0x589965CC75374CC3,
            0x1D8E4E27C47D124F,
        ),
        strict=True,
    )
)


def checks(data: bytes, at: np.ndarray) -> np.ndarray:
    """A second hash of the 50-byte strings at some positions, made without their names."""
    words, x = _words(data), np.zeros(len(at), np.uint64)
    for k, factor in CHECKED:
        x += _mixed(words[at + k]) * factor
    return x


def hashes_at(data: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and second hashes of the 50-byte strings at some positions, in ascending order.

    Strings that overlap share their words, as in ``names``; what lies between is left out.
    """
    reach = LENGTH - 8
    full, check = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    if not len(at):
        return full, check
    words = _words(data)
    # stretches of words, one behind the other: a slot is a place less the bytes left out before it
    new = np.flatnonzero(np.diff(at) > reach) + 1
    starts, stops = at[np.r_[0, new]], at[np.r_[new - 1, len(at) - 1]] + reach + 1
    sizes = stops - starts
    ends = np.cumsum(sizes)
    skipped = starts - (ends - sizes)
    slot = at - np.repeat(skipped, np.diff(np.r_[0, new, len(at)]))
    lo = 0
    while lo < len(at):
        hi = int(np.searchsorted(slot, slot[lo] + PORTION))
        begin, end = int(slot[lo]), int(slot[hi - 1]) + reach + 1
        a, b = np.searchsorted(ends, (begin, end - 1), "right")
        if a == b:
            eight = _mixed(words[begin + skipped[a] : end + skipped[a]])
        else:
            parts = np.minimum(ends[a : b + 1], end) - np.maximum((ends - sizes)[a : b + 1], begin)
            eight = _mixed(words[np.arange(begin, end) + np.repeat(skipped[a : b + 1], parts)])
        half, own = _halves(eight), slot[lo:hi] - begin
        full[lo:hi] = _pair(half[:-HALF], half[HALF:])[own]
        for k, factor in CHECKED:
            check[lo:hi] += (eight[k : k + len(eight) - reach] * factor)[own]
        lo = hi
    return full, check


def names_at(data: bytes, at: np.ndarray) -> np.ndarray:
    """Names of the 50-byte strings at some positions of a text, in ascending order."""
    return hashes_at(data, at)[0]


def runs(data: bytes, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text, first window, last window, smallest 25-byte name (mixed), and name of the bytes
    of each run, of texts that lie in ``data`` without gaps."""
    half = _halves(_mixed(_words(data)))
    least, width = half, 1
    while width < REACH:
        step = min(width, REACH - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    new = np.empty(len(least), bool)
    new[0], new[1:] = True, least[1:] != least[:-1]
    # what begins near a text's end reaches into the next text
    any_ = ends > begins
    none = np.maximum(ends[any_, None] - np.arange(1, LENGTH), begins[any_, None])
    new[none[none < len(new)]] = False
    some = np.flatnonzero(ends - begins >= LENGTH)
    new[begins[some]] = True
    first = np.flatnonzero(new)
    doc = some[np.searchsorted(begins[some], first, "right") - 1]
    last = np.minimum(np.r_[first[1:], len(new)], ends[doc] - LENGTH + 1) - 1
    # where a text repeats itself a run can be long: cut so that two names cover it
    if (last - first >= LENGTH).any():
        parts = (last - first) // LENGTH + 1
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first = np.repeat(first, parts) + nth * LENGTH
        last = np.minimum(np.repeat(last, parts), first + LENGTH - 1)
        doc = np.repeat(doc, parts)
    whole = _pair(*(_pair(half[x], half[x + HALF]) for x in (first, last)))
    # the smallest of many are small: mixed again, so that all owners get as many
    return doc, first, last, _mix(least[first]), whole ^ (last - first).astype(np.uint64)


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of some ranges, one range after the other, and the range of each."""
    count = last - first + 1
    own = np.repeat(np.arange(len(count)), count)
    return np.arange(len(own)) + (first - (np.cumsum(count) - count))[own], own


class Texts:
    """The texts of one block, one behind the other; places are those in the block."""

    def __init__(self, row):
        self.data = zstandard.ZstdDecompressor().decompress(row["payload"])
        sizes = np.frombuffer(row["sizes"], np.int32).astype(np.int64)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes

    def windows(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Name and second hash of every window of some runs, one run after the other."""
        order = np.argsort(first)
        at, _ = _spread(first[order], last[order])
        count = last - first + 1
        place, _ = _spread((np.cumsum(count) - count)[order], np.cumsum(count)[order] - 1)
        full, check = np.empty(len(at), np.uint64), np.empty(len(at), np.uint64)
        full[place], check[place] = hashes_at(self.data, at)
        return (full >> np.uint64(64 - WINDOW_BITS)).astype(np.int64), check


class Block(Texts):
    """The texts of one block with their runs."""

    def __init__(self, row):
        super().__init__(row)
        found, lo = [], 0
        while lo < len(self.ends):
            begin = int(self.begins[lo])
            hi = max(lo + 1, int(np.searchsorted(self.ends, begin + PORTION, "right")))
            end = int(self.ends[hi - 1])
            if end - begin >= LENGTH:
                own = slice(lo, hi)
                doc, first, last, *rest = runs(
                    self.data[begin:end], self.begins[own] - begin, self.ends[own] - begin
                )
                found.append((doc + lo, first + begin, last + begin, *rest))
            lo = hi
        join = lambda i, kind: (
            np.concatenate([f[i] for f in found]) if found else np.zeros(0, kind)
        )
        self.doc, self.first, self.last = (join(i, np.int64) for i in range(3))
        self.name = (join(3, np.uint64) >> np.uint64(64 - RUN_BITS)).astype(np.int64)
        self.whole = join(4, np.uint64)
        self.doc_id = self.ids[self.doc]

    def groups(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Some runs sorted by name, bytes and id, and the start of each group of equal runs."""
        order = own[np.lexsort((self.doc_id[own], self.whole[own], self.name[own]))]
        return order, np.flatnonzero(_changes(self.name[order], self.whole[order]))

    def checks(self, chosen: np.ndarray) -> np.ndarray:
        """Second hashes of the bytes of some runs."""
        out = np.empty(len(chosen), np.uint64)
        order = np.argsort(chosen)
        for lo in range(0, len(order), PORTION):
            part = order[lo : lo + PORTION]
            first, last = self.first[chosen[part]], self.last[chosen[part]]
            both = checks(self.data, first) * np.uint64(0x9E3779B97F4A7C15)
            both ^= checks(self.data, last)
            out[part] = _mix(both + (last - first).astype(np.uint64))
        return out


class Members:
    """Runs of a block whose name is common, by groups of equal runs, in order of ids."""

    def __init__(self, payload: bytes, texts: Texts):
        data = zstandard.ZstdDecompressor().decompress(payload)
        groups = int(np.frombuffer(data, np.int64, 1)[0])
        numbers = np.frombuffer(data, np.int32, offset=8)
        sizes = numbers[:groups].astype(np.int64)
        self.doc, self.first, self.last = numbers[groups:].reshape(3, -1).astype(np.int64)
        self.first += texts.begins[self.doc]
        self.last += texts.begins[self.doc]
        self.start = np.cumsum(sizes) - sizes
        self.group = np.repeat(np.arange(groups), sizes)
        self.doc_id = texts.ids[self.doc]

    @staticmethod
    def packed(block: Block, order: np.ndarray, start: np.ndarray) -> bytes:
        """A block's groups of runs, with places in their own texts."""
        sizes, begins = np.diff(np.r_[start, len(order)]), block.begins[block.doc[order]]
        columns = (sizes, block.doc[order], block.first[order] - begins, block.last[order] - begins)
        data = np.int64(len(sizes)).tobytes() + b"".join(c.astype(np.int32).tobytes() for c in columns)
        return zstandard.compress(data, 3)


def pack(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Blocks of about ``BLOCK_BYTES`` of text: ``block, ids, sizes, payload``."""
    if not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise ValueError("ids must be whole numbers: the smaller one keeps its text")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("t"))

    def run(batches):
        part, count = TaskContext.get().partitionId(), 0
        ids: list[int] = []
        texts: list[bytes] = []
        size = 0

        def block():
            row = pa.RecordBatch.from_pydict(
                {
                    "block": [(part << 24) + count],
                    "ids": [np.array(ids, np.int64).tobytes()],
                    "sizes": [np.array([len(t) for t in texts], np.int32).tobytes()],
                    "payload": [zstandard.ZstdCompressor(level=3).compress(b"".join(texts))],
                }
            )
            ids.clear()
            texts.clear()
            return row

        for batch in batches:
            for key, text in zip(batch.column(0), texts_of(batch, 1), strict=True):
                ids.append(NO_ID if not key.is_valid else key.as_py())
                texts.append(text.encode("utf-8", "replace"))
                size += len(texts[-1]) + 64
                if size >= BLOCK_BYTES:
                    yield block()
                    count, size = count + 1, 0
        if ids:
            yield block()

    return rows.mapInArrow(run, "block long, ids binary, sizes binary, payload binary")


def _shares(names_sorted: np.ndarray, bits: int, owners: int) -> list[tuple[int, int, int, int]]:
    """(owner, from, to, smallest name) of every owner with a part of a sorted list."""
    slots = -(-(1 << bits) // owners)
    bounds = np.searchsorted(names_sorted, np.arange(1, owners, dtype=np.int64) * slots)
    bounds = np.r_[0, bounds, len(names_sorted)]
    full = np.flatnonzero(np.diff(bounds))
    return [(int(o), int(bounds[o]), int(bounds[o + 1]), int(o) * slots) for o in full]


def _messages(src: int, names_sorted: np.ndarray, bits: int, owners: int, extra=lambda lo, hi: ()):
    """Rows for the owners of a sorted list of names."""
    for owner, lo, hi, least in _shares(names_sorted, bits, owners):
        part = golomb.encode(names_sorted[lo:hi] - least)
        yield (src, owner, hi - lo, *part, *extra(lo, hi))


def _flags(names_sorted: np.ndarray, bits: int, owners: int, replies: dict[int, bytes]):
    """The owners' answers, one for each name of a sorted list."""
    parts = [
        np.unpackbits(np.frombuffer(replies[owner], np.uint8))[: hi - lo]
        for owner, lo, hi, _ in _shares(names_sorted, bits, owners)
    ]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)


def _lists(pdf: pd.DataFrame):
    """The lists of names that an owner got, one after the other."""
    for sent in pdf[["n", "width", "unary", "rest"]].itertuples(index=False):
        yield golomb.decode(*sent)


def _decoded(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All names of an owner and the row of ``pdf`` that each came with."""
    return np.concatenate(list(_lists(pdf))), np.repeat(np.arange(len(pdf)), pdf["n"])


def _among(found: np.ndarray, listed: np.ndarray) -> np.ndarray:
    """Which values stand in a sorted list."""
    if not len(listed):
        return np.zeros(len(found), bool)
    return listed[np.minimum(np.searchsorted(listed, found), len(listed) - 1)] == found


def _column(pdf: pd.DataFrame, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in pdf[name]])


def _ids(pdf: pd.DataFrame, row: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Document ids of entries, from the id list that came with each row."""
    lists = [np.frombuffer(x, np.int64) for x in pdf["ids"]]
    base = np.cumsum([0, *(len(x) for x in lists)])[:-1]
    return np.concatenate(lists)[base[row] + doc]


def _used_ids(ids: np.ndarray, doc: np.ndarray) -> tuple[bytes, bytes]:
    """Documents renumbered to those used, with their ids."""
    used, at = np.unique(doc, return_inverse=True)
    return at.astype(np.int32).tobytes(), ids[used].tobytes()


def _list_of_names(block: Block) -> np.ndarray:
    """Names of the block's runs, twice where two documents of the block have them."""
    if not len(block.name):
        return block.name
    order = np.argsort(block.name)
    name, doc_id = block.name[order], block.doc_id[order]
    start = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
    several = np.minimum.reduceat(doc_id, start) != np.maximum.reduceat(doc_id, start)
    return np.repeat(name[start], 1 + several)


def _sorted(name: np.ndarray, check: np.ndarray) -> np.ndarray:
    """Order by name and second hash; only names with several of these are sorted by both."""
    order = np.argsort(name)
    s_name, s_check = name[order], check[order]
    mixed = s_name[1:][(s_name[1:] == s_name[:-1]) & (s_check[1:] != s_check[:-1])]
    if len(mixed):
        at = np.flatnonzero(_among(s_name, mixed))
        order[at] = order[at][np.lexsort((s_check[at], s_name[at]))]
    return order


def find_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans``.

    A byte is removed when a 50-byte string over it also starts in a document
    with a smaller id; strings are those of the input.  ``spans`` packs the
    maximal removed runs as pairs of 64-bit byte positions.  Null counts as
    empty; texts under 50 bytes lose nothing; rows that repeat an id do not
    count as smaller than each other; a null id is smaller than any other.
    Strings are compared by hashes, not byte by byte: in runs by 48 + 64 bits of
    names, in windows by 62; between blocks, and for windows also inside one,
    by 64 bits of a second hash beside them.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    owners = max(1, -(-size // (HALF // 2 * OWNER_NAMES)))
    view = f"repeats_{uuid.uuid4().hex}"
    writer = pack(docs, id_col, text_col).write.format("parquet").option("compression", "none")
    writer = writer.bucketBy(max(1, -(-size // BUCKET_BYTES)), "block")
    writer.option("path", scratch_folder(spark, "repeats-blocks")).saveAsTable(view)
    blocks = spark.table(view)
    try:
        again = staged(_first_round(blocks, owners), "repeats-names")
        marks = staged(_second_round(blocks, again, owners), "repeats-runs")
        replies = staged(_third_round(blocks, marks, owners), "repeats-windows")
        return staged(_removed(blocks, replies, owners), "repeats")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {view}")


def _first_round(blocks: DataFrame, owners: int) -> DataFrame:
    """Which run names occur in several documents: ``src, owner, bits`` in the order sent."""

    def send(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                listed = _list_of_names(Block(row))
                out.extend(_messages(row["block"], listed, RUN_BITS, owners))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["src", "owner", "n", "width", "unary", "rest"],
            )

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        everything = np.sort(np.concatenate(list(_lists(pdf))))
        common = everything[1:][everything[1:] == everything[:-1]]
        del everything
        bits = [np.packbits(_among(x, common)).tobytes() for x in _lists(pdf)]
        return pd.DataFrame({"src": pdf["src"], "owner": pdf["owner"], "bits": bits})

    messages = blocks.mapInArrow(send, MESSAGE)
    return messages.groupBy("owner").applyInPandas(answer, "src long, owner int, bits binary")


def _second_round(blocks: DataFrame, again: DataFrame, owners: int) -> DataFrame:
    """By block (src, kind, runs): 0 groups of runs repeated as a whole, 1 groups to be
    ranked by windows, both by their number in the block, and 9 the block's own groups."""

    def send(own: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in own.to_dict("records"):
            block = Block(row)
            listed = _list_of_names(block)
            bits = dict(zip(replies["owner"], replies["bits"], strict=True))
            common = listed[_flags(listed, RUN_BITS, owners, bits)]
            order, start = block.groups(np.flatnonzero(_among(block.name, common)))
            first = order[start]
            own_runs = Members.packed(block, order, start)
            # on the way with the messages, to nobody else: owners below zero are blocks
            nobody = -1 - row["block"] % (1 << 30)
            out.append((row["block"], nobody, 0, 0, b"", own_runs, b"", b"", b"", b"", b""))
            name, whole, doc = block.name[first], block.whole[first], block.doc[first]
            check = block.checks(first)

            def extra(lo, hi, whole=whole, check=check, doc=doc, block=block):
                part = slice(lo, hi)
                docs, ids = _used_ids(block.ids, doc[part])
                runs_ = np.arange(lo, hi, dtype=np.int32).tobytes()
                return whole[part].tobytes(), check[part].tobytes(), runs_, docs, ids

            out.extend(_messages(row["block"], name, RUN_BITS, owners, extra))
        columns = [c.split()[0] for c in MESSAGE.split(", ")]
        columns += ["whole", "check", "run", "doc", "ids"]
        return pd.DataFrame(out, columns=columns)

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["owner"].iloc[0] < 0:
            return pd.DataFrame({"src": pdf["src"], "kind": OWN_RUNS, "runs": pdf["rest"]})
        name, row = _decoded(pdf)
        whole, run = _column(pdf, "whole", np.uint64), _column(pdf, "run", np.int32)
        check = _column(pdf, "check", np.uint64)
        ids = _ids(pdf, row, _column(pdf, "doc", np.int32))
        order = np.lexsort((ids, check, whole, name))
        s_name, s_whole, s_ids = name[order], whole[order], ids[order]
        new_name = np.r_[True, s_name[1:] != s_name[:-1]]
        new = new_name | np.r_[True, s_whole[1:] != s_whole[:-1]]
        new[1:] |= check[order][1:] != check[order][:-1]
        start = np.flatnonzero(new)
        later = s_ids > s_ids[start][np.cumsum(new) - 1]
        kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_name))
        open_ = ~later & (kinds[np.cumsum(new_name) - 1] > 1)
        out = []
        for chosen, kind in ((order[later], 0), (order[open_], 1)):
            own = row[chosen]
            by_row = np.argsort(own, kind="stable")
            cuts = np.searchsorted(own[by_row], np.arange(len(pdf) + 1))
            for k in np.flatnonzero(np.diff(cuts)):
                part = run[chosen[by_row[cuts[k] : cuts[k + 1]]]]
                out.append((pdf["src"].iloc[k], kind, np.sort(part).tobytes()))
        return pd.DataFrame(out, columns=["src", "kind", "runs"])

    schema = MESSAGE + ", whole binary, check binary, run binary, doc binary, ids binary"
    grouped = blocks.groupBy("block").cogroup(again.groupBy("src"))
    messages = grouped.applyInPandas(send, schema)
    return messages.groupBy("owner").applyInPandas(answer, "src long, kind int, runs binary")


def _members(replies: pd.DataFrame, texts: Texts) -> Members:
    (payload,) = replies["runs"][replies["kind"] == OWN_RUNS]
    return Members(payload, texts)


def _marked(replies: pd.DataFrame, kind: int) -> np.ndarray:
    """Numbers of groups that replies name for a block."""
    parts = [np.frombuffer(x, np.int32) for x in replies["runs"][replies["kind"] == kind]]
    return np.sort(np.concatenate(parts)).astype(np.int64) if parts else np.zeros(0, np.int64)


def _window_list(block: Texts, runs_: Members, chosen: np.ndarray):
    """Distinct windows of the chosen groups: sorted names, second hashes and smallest ids;
    for every window of these groups, run by run, which of them it is and the id of its text."""
    one = runs_.start[chosen]
    name, check = block.windows(runs_.first[one], runs_.last[one])
    doc_id = np.repeat(runs_.doc_id[one], runs_.last[one] - runs_.first[one] + 1)
    order = _sorted(name, check)
    new = _changes(name[order], check[order])
    start = np.flatnonzero(new)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(doc_id[order], start) if len(order) else doc_id
    return name[order[start]], check[order[start]], least, which, doc_id


def _changes(name: np.ndarray, check: np.ndarray) -> np.ndarray:
    """Where a sorted list of names and second hashes has a new string."""
    new = (name[1:] != name[:-1]) | (check[1:] != check[:-1])
    return np.r_[True, new][: len(name)]


def _third_round(blocks: DataFrame, marks: DataFrame, owners: int) -> DataFrame:
    """All replies a block needs: ``src, kind, owner, runs`` (kind 2: bits of windows in order)."""

    def send(own: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out = []
        chosen = _marked(replies, 1)
        for row in own.to_dict("records") if len(chosen) else ():
            block = Texts(row)
            listed, check, least, *_ = _window_list(block, _members(replies, block), chosen)

            def extra(lo, hi, check=check, least=least):
                ids, at = np.unique(least[lo:hi], return_inverse=True)
                return check[lo:hi].tobytes(), at.astype(np.int32).tobytes(), ids.tobytes()

            out.extend(_messages(row["block"], listed, WINDOW_BITS, owners, extra))
        columns = [c.split()[0] for c in MESSAGE.split(", ")] + ["check", "doc", "ids"]
        return pd.DataFrame(out, columns=columns)

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        name, row = _decoded(pdf)
        ids = _ids(pdf, row, _column(pdf, "doc", np.int32))
        check = _column(pdf, "check", np.uint64)
        order = _sorted(name, check)
        new = _changes(name[order], check[order])
        least = np.minimum.reduceat(ids[order], np.flatnonzero(new))
        later = np.zeros(len(name), bool)
        later[order] = ids[order] > least[np.cumsum(new) - 1]
        parts = np.split(later, np.flatnonzero(np.diff(row)) + 1)
        bits = [np.packbits(x).tobytes() for x in parts]
        return pd.DataFrame({"src": pdf["src"], "kind": 2, "owner": pdf["owner"], "runs": bits})

    grouped = blocks.groupBy("block").cogroup(marks.groupBy("src"))
    messages = grouped.applyInPandas(send, MESSAGE + ", check binary, doc binary, ids binary")
    replies = messages.groupBy("owner").applyInPandas(
        answer, "src long, kind int, owner int, runs binary"
    )
    return replies.unionByName(marks.withColumn("owner", F.lit(0)))


def _removed(blocks: DataFrame, replies: DataFrame, owners: int) -> DataFrame:
    """Removed spans and what is left of every document."""

    def judge(own: pd.DataFrame, replies: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        for row in own.to_dict("records"):
            block = Texts(row)
            cuts, begins, ends = _joined(block, *_repeated(block, replies, owners))
            for k, text in enumerate(zip(block.begins.tolist(), block.ends.tolist(), strict=True)):
                part = slice(cuts[k], cuts[k + 1])
                out.append((block.ids[k], *_cut(block.data, *text, begins[part], ends[part])))
        names_ = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
        pdf = pd.DataFrame(out, columns=names_)
        pdf["doc_id"] = pdf["doc_id"].astype("Int64").mask(pdf["doc_id"] == NO_ID)
        return pdf

    grouped = blocks.groupBy("block").cogroup(replies.groupBy("src"))
    return grouped.applyInPandas(
        judge,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans binary",
    )


def _repeated(block: Texts, replies: pd.DataFrame, owners: int):
    """Text, first byte and end, in places of the block, of everything repeated in it."""
    runs_ = _members(replies, block)
    groups = len(runs_.start)
    named = np.zeros(groups, bool)
    named[_marked(replies, 0)] = True
    gone = (runs_.doc_id > runs_.doc_id[runs_.start][runs_.group]) | named[runs_.group]
    doc, at, end = runs_.doc[gone], runs_.first[gone], runs_.last[gone] + LENGTH
    chosen = _marked(replies, 1)
    if not len(chosen):
        return doc, at, end
    listed, _, least, which, doc_id = _window_list(block, runs_, chosen)
    bits = replies[replies["kind"] == 2]
    bits = dict(zip(bits["owner"], bits["runs"], strict=True))
    later = _flags(listed, WINDOW_BITS, owners, bits)[which] | (doc_id > least[which])
    # equal runs of the same text share the fate of the chosen one
    one = runs_.start[chosen]
    sizes = runs_.last[one] - runs_.first[one] + 1
    begin = np.full(groups, -1)
    begin[chosen] = np.cumsum(sizes) - sizes
    equal = np.flatnonzero((begin[runs_.group] >= 0) & ~gone)
    w_at, own = _spread(runs_.first[equal], runs_.last[equal])
    own = equal[own]
    out = later[begin[runs_.group[own]] + w_at - runs_.first[own]]
    return (
        np.r_[doc, runs_.doc[own[out]]],
        np.r_[at, w_at[out]],
        np.r_[end, w_at[out] + LENGTH],
    )


def _joined(block: Texts, doc: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Maximal runs of what is repeated: where those of each text begin, first bytes, ends."""
    order = np.argsort(start)
    doc, start = doc[order], start[order]
    # a gap between the texts keeps their runs apart
    reach = np.maximum.accumulate(end[order] + doc)
    new = np.flatnonzero(np.r_[True, start[1:] + doc[1:] > reach[:-1]][: len(start)])
    last = np.r_[new[1:], len(start)][: len(new)] - 1
    cuts = np.searchsorted(doc[new], np.arange(len(block.ends) + 1))
    return cuts, start[new], reach[last] - doc[new]


def _cut(data: bytes, at: int, stop: int, begins: np.ndarray, ends: np.ndarray) -> tuple:
    """Sizes, digest of the rest, and maximal removed runs of the text at some place of a block."""
    size = stop - at
    if not len(begins):
        return size, 0, 0, hashlib.sha256(data[at:stop]).hexdigest(), b""
    spans = (np.column_stack((begins, ends)) - at).astype(np.int64).tobytes()
    digest = hashlib.sha256()
    for b, e in zip(begins.tolist(), ends.tolist(), strict=True):
        digest.update(data[at:b])
        at = e
    digest.update(data[at:stop])
    return size, int((ends - begins).sum()), len(begins), digest.hexdigest(), spans
