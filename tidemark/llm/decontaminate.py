"""Benchmark decontamination by Wu-Manber search over words.

The alphabet is words, not characters: a block is two neighbouring words.  The
shift table says how far the next place can be at which a benchmark window
could end; only where the shift is zero are the windows with that last block and
with the first block found there compared word by word.  A window that several
items have, or one item several times, is stored once with the set of its items.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import fresh, staged, texts_of

WINDOW = 13
#: A document is contaminated when at least one word in so many is hit.
ONE_IN = 20
#: Bytes of benchmark text searched for in one pass; more text means more passes.
PASS_BYTES = 2_000_000
#: Windows are searched for in classes of similar length; these are the shortest of each.
CLASSES = (1, 2, 4, 8, 13)

#: UTF-8 bytes of words: digits, lower-case letters, everything beyond ASCII.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)

SCHEMA = (
    "doc_id {id}, n_words long, n_hit long, n_items long, items_sha256 string, "
    "contaminated boolean, items array<string>, spans binary"
)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; null has none."""
    return text.encode("utf-8", "replace").translate(_WORDS).split() if text else []


class Matcher:
    """Shift, suffix and prefix tables for distinct windows of at least ``m`` words."""

    def __init__(self, m: int, windows: Iterable[tuple[str, list[bytes], int, int]]):
        self.m, self.width = m, min(m, 2)
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, words, start, size in windows:
            owners.setdefault(tuple(words[start : start + size]), set()).add(item)
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.ends: dict[tuple, dict[tuple, list[tuple[list[bytes], frozenset[str]]]]] = {}
        shared: dict[frozenset[str], frozenset[str]] = {}
        for window, found in owners.items():
            items = frozenset(found)
            items = shared.setdefault(items, items)
            for end in range(self.width, m + 1):
                block = window[end - self.width : end]
                left = m - end
                if left < self.shift.get(block, m):
                    self.shift[block] = left
            same_end = self.ends.setdefault(window[m - self.width : m], {})
            same_start = same_end.setdefault(window[: self.width], [])
            same_start.append((list(window), items))

    def hits(self, words: list[bytes]) -> Iterable[tuple[int, int, frozenset[str]]]:
        """(start, end, items) of every occurrence of a window."""
        m, width, shift, n = self.m, self.width, self.shift, len(words)
        most = m - width + 1
        i = m
        while i <= n:
            block = (words[i - 2], words[i - 1]) if width == 2 else (words[i - 1],)
            step = shift.get(block, most)
            if step:
                i += step
                continue
            start = i - m
            for window, items in self.ends[block].get(tuple(words[start : start + width]), ()):
                if words[start : start + len(window)] == window:
                    yield start, start + len(window), items
            i += 1

    def find(self, words: list[bytes]) -> Iterable[tuple[int, int, str]]:
        """(start, end, item) of every occurrence."""
        for start, end, items in self.hits(words):
            for item in items:
                yield start, end, item


def matchers(items: Iterable[tuple[str, str]], window: int = WINDOW) -> list[Matcher]:
    """Matchers for all windows of the items, one for each class of lengths."""
    by_class: dict[int, list] = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        if size:
            least = max(c for c in CLASSES if c <= size)
            starts = range(len(words) - size + 1)
            by_class.setdefault(least, []).extend((item, words, s, size) for s in starts)
    return [Matcher(m, found) for m, found in sorted(by_class.items())]


def _passes(benchmark: DataFrame) -> tuple[int, Callable[[int], list[tuple[str, str]]]]:
    """How many portions of about ``PASS_BYTES`` the benchmark has, and a reader of each."""
    rows = benchmark.filter("text is not null").select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text"
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // PASS_BYTES))

    def portion(k: int) -> list[tuple[str, str]]:
        own = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k)
        return [tuple(r) for r in own.distinct().collect()]

    return count, portion


def merged(spans: np.ndarray) -> np.ndarray:
    """Sorted spans without overlaps or touching neighbours, as rows (start, end)."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.r_[True, spans[1:, 0] > reach[:-1]])
    return np.column_stack((spans[first, 0], reach[np.r_[first[1:] - 1, len(spans) - 1]]))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per document with its hit words and the items found in it.

    Columns: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``,
    ``items`` (found item ids, sorted as strings) and ``spans`` (pairs of 32-bit
    word positions, start and end, merged).  ``benchmark`` holds ``item_id`` and
    ``text``.  Null and wordless texts on either side match nothing; an item
    that repeats counts once; a null item id counts as the empty string.  Rows
    that repeat a doc_id are judged one by one.  An empty table of documents gives
    no rows, an empty benchmark finds nothing.  Other columns are ignored.
    """
    state = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = state.schema["doc_id"].dataType.simpleString()
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    sc = docs.sparkSession.sparkContext
    count, portion = _passes(benchmark)
    for k in range(count):
        last = k == count - 1
        items = sc.broadcast(portion(k))
        state = _search(state, items, window, k > 0, last, id_type)
        if not last:
            state = staged(state, "decontaminate-pass")
            items.destroy()
    return state.select(*columns)


def _search(state: DataFrame, items, window: int, resumed: bool, last: bool, id_type: str):
    schema = SCHEMA.format(id=id_type) + ("" if last else ", text string")

    def run(batches):
        tables = matchers(items.value, window)
        for batch in batches:
            names = batch.schema.names
            old = batch.column(names.index("spans")) if resumed else None
            old_items = batch.column(names.index("items")) if resumed else None
            out = []
            for row, text in enumerate(texts_of(batch, names.index("text"))):
                words = words_of(text)
                spans, found, sets = [], set(), set()
                for m in tables:
                    for start, end, own in m.hits(words):
                        spans.append((start, end))
                        if own not in sets:
                            sets.add(own)
                            found |= own
                if resumed:
                    spans += np.frombuffer(old[row].as_py(), np.int32).reshape(-1, 2).tolist()
                    found |= set(old_items[row].as_py())
                out.append(_verdict(len(words), spans, found))
            arrays = [batch.column(names.index("doc_id"))]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            types += (pa.list_(pa.string()), pa.binary())
            columns = zip(*out, strict=True) if out else [[]] * len(types)
            arrays += [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            keys = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
            keys += ["items", "spans"]
            if not last:
                arrays.append(batch.column(names.index("text")))
                keys.append("text")
            yield pa.RecordBatch.from_arrays(arrays, keys)

    return state.mapInArrow(run, schema)


def _verdict(n_words: int, spans: list[tuple[int, int]], found: set[str]) -> tuple:
    covered = merged(np.array(spans, dtype=np.int32).reshape(-1, 2))
    n_hit = int((covered[:, 1] - covered[:, 0]).sum())
    items = sorted(found)
    digest = hashlib.sha256(",".join(items).encode()).hexdigest()
    dirty = n_hit > 0 and ONE_IN * n_hit >= n_words
    return n_words, n_hit, len(items), digest, dirty, items, covered.astype(np.int32).tobytes()


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    Portions of the benchmark are searched for one after the other, each in a
    pass of its own; what one portion finds counts for all, so that a document
    hit a little by each goes.
    """
    state, spans = docs, fresh(docs, "_spans")
    sc = docs.sparkSession.sparkContext
    count, portion = _passes(benchmark)
    for k in range(count):
        last = k == count - 1
        items = sc.broadcast(portion(k))
        state = _sift(state, items, docs.columns.index(text_col), spans, window, k > 0, last)
        if not last:
            state = staged(state, "decontaminate-sift")
            items.destroy()
    return state


def _sift(state: DataFrame, items, at: int, spans: str, window: int, resumed: bool, last: bool):
    """Adds a portion's hits to the column ``spans``; the last pass judges and takes it away."""
    schema = T.StructType([f for f in state.schema if f.name != spans])
    own = len(schema)
    if not last:
        schema = schema.add(spans, T.BinaryType())

    def run(batches):
        tables = matchers(items.value, window)
        for batch in batches:
            out = []
            for row, text in enumerate(texts_of(batch, at)):
                words = words_of(text)
                hits = [(s, e) for m in tables for s, e, _ in m.hits(words)]
                if resumed:
                    old = np.frombuffer(batch.column(own)[row].as_py(), np.int32)
                    hits += old.reshape(-1, 2).tolist()
                if last:
                    out.append(not _verdict(len(words), hits, set())[4] if hits else True)
                else:
                    found = merged(np.array(hits, dtype=np.int32).reshape(-1, 2))
                    out.append(found.astype(np.int32).tobytes())
            given = pa.RecordBatch.from_arrays(batch.columns[:own], batch.schema.names[:own])
            if last:
                yield given.filter(pa.array(out, pa.bool_()))
            else:
                names = [*batch.schema.names[:own], spans]
                yield pa.RecordBatch.from_arrays(
                    [*given.columns, pa.array(out, pa.binary())], names
                )

    return state.mapInArrow(run, schema)
