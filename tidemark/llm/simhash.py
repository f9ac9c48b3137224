"""Near-duplicate documents: SimHash fingerprints linked through vantage-point trees.

Distinct fingerprints are dealt to shards by a vantage-point tree that is
fitted on a bounded sample: a node sends a fingerprint inward when its Hamming
distance to the vantage point is at most the radius.  A fingerprint within
``RADIUS`` of the boundary also visits the other side, so every close pair
meets in some shard.  A shard that comes out larger than one task should hold is
dealt again by a tree of its own, so the number of shards grows with the rows.
Inside a shard the same recursion goes on down to small leaves, where distances
are compared outright.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep_once, staged, texts_of
from tidemark.llm.components import connected_components

SHINGLE = 3
SEED = 42
#: Fingerprints with at most this many differing bits are linked.
RADIUS = 2
#: Fingerprints that a shard is meant to store, and those sampled to fit the shards.
SHARD_ROWS, SAMPLE = 4_000, 8_192
#: Sampled fingerprints behind each shard boundary, at least.
LEAST_SAMPLE = 16
#: Rows that one task compares; a larger shard is dealt again by a tree of its own.
SHARD_LIMIT = 1_000_000
#: Leaves of at most so many stored fingerprints are compared outright.
LEAF = 48
#: Stored fingerprints compared with all visitors at once.
BLOCK = 1_024


def fingerprint(text: str | None) -> int:
    """Bits set in over half the shingle hashes; zero for no words."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)
    hashes = np.array([digest(line[a:b], SEED) for a, b in spans], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    set_bits = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id, fp`` (64 bits as a signed long) and a hash of the text."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("mark"),
        F.col(text_col).alias("t"),
    )
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            prints = np.array([fingerprint(t) for t in texts_of(batch, 2)], dtype=np.uint64)
            columns = [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "mark", "fp"])

    return rows.mapInArrow(run, f"id {id_type}, mark long, fp long")


class Node:
    """A vantage point with its radius, or a shard."""

    __slots__ = ("point", "radius", "inside", "outside", "shard")

    def __init__(self, point=None, radius=None, inside=None, outside=None, shard=None):
        self.point, self.radius = point, radius
        self.inside, self.outside, self.shard = inside, outside, shard


def distances(prints: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(prints ^ point)


def split(prints: np.ndarray) -> tuple[np.uint64, int] | None:
    """A vantage point and the radius that halves ``prints`` best, out of a few points."""
    best = None
    for point in prints[:: max(1, len(prints) // 4)][:5]:
        d = distances(prints, point)
        for radius in {int(np.median(d)), int(np.median(d)) - 1}:
            share = abs(int((d <= radius).sum()) * 2 - len(prints))
            if share < len(prints) and (best is None or share < best[0]):
                best = (share, point, radius)
    return best and best[1:]


def fit_tree(sample: np.ndarray, leaf: int) -> tuple[Node, int]:
    """A tree whose shards hold at most ``leaf`` of the sampled fingerprints, and their number."""
    count = 0

    def grow(prints: np.ndarray) -> Node:
        nonlocal count
        cut = split(prints) if len(prints) > leaf else None
        if cut is None:
            count += 1
            return Node(shard=count - 1)
        inward = distances(prints, cut[0]) <= cut[1]
        return Node(*cut, grow(prints[inward]), grow(prints[~inward]))

    return grow(sample), count


def sides(prints: np.ndarray, stored: np.ndarray, point, radius) -> Iterator[tuple]:
    """For the inner and the outer side: who goes there, and who is stored there.

    Who is stored goes to its own side and visits the inner one from just
    outside; who visits goes wherever a stored fingerprint can be close.  That
    is enough: of two stored ones on both sides, the outer one visits.
    """
    d = distances(prints, point).astype(np.int16)
    inward = d <= radius
    yield (d <= radius + RADIUS), stored & inward
    yield np.where(stored, ~inward, d > radius - RADIUS), stored & ~inward


def route(
    tree: Node, prints: np.ndarray, stored: np.ndarray
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, positions, stored) for all shards that the fingerprints go to."""
    todo = [(tree, np.arange(len(prints)), stored)]
    while todo:
        node, at, stored = todo.pop()
        if not len(at):
            continue
        if node.shard is not None:
            yield node.shard, at, stored
            continue
        cut = sides(prints[at], stored, node.point, node.radius)
        for child, (goes, stays) in zip((node.inside, node.outside), cut, strict=True):
            todo.append((child, at[goes], stays[goes]))


class Groups:
    """Union-find over positions, on arrays."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        up = self.parent[at]
        while True:
            above = self.parent[up]
            if (above == up).all():
                self.parent[at] = up
                return up
            up = above

    def join(self, at: np.ndarray) -> None:
        roots = self.roots(at)
        self.parent[roots] = roots.min()


def link_close(prints: np.ndarray, stored: np.ndarray) -> np.ndarray:
    """For each position a position of its group, equal for linked fingerprints."""
    groups = Groups(len(prints))
    todo = [(np.arange(len(prints)), stored)]
    while todo:
        at, own = todo.pop()
        held = int(own.sum())
        if not held or len(at) < 2:
            continue
        cut = split(prints[at[own]]) if held > LEAF else None
        if cut is None:
            compare(prints, at, own, groups)
            continue
        for goes, stays in sides(prints[at], own, *cut):
            todo.append((at[goes], stays[goes]))
    return groups.roots(np.arange(len(prints)))


def compare(prints: np.ndarray, at: np.ndarray, own: np.ndarray, groups: Groups) -> None:
    """Link every stored fingerprint of a leaf with all close ones there."""
    held, all_prints = at[own], prints[at]
    for i in range(0, len(held), max(1, BLOCK * LEAF // max(len(at), BLOCK))):
        part = held[i : i + max(1, BLOCK * LEAF // max(len(at), BLOCK))]
        close = np.bitwise_count(prints[part][:, None] ^ all_prints[None, :]) <= RADIUS
        for row in close[close.sum(axis=1) > 1]:
            groups.join(at[row])


DEALT = "shard long, fp long, stored boolean"


def _fitted(signed: np.ndarray, leaf: int) -> tuple[Node, int]:
    sample = np.sort(signed).view(np.uint64)
    np.random.default_rng(SEED).shuffle(sample)
    return fit_tree(sample, leaf)


def _sampled(prints: DataFrame, share) -> DataFrame:
    """Fingerprints picked by a hash of their own, about ``share`` of them."""
    spot = F.pmod(F.xxhash64("fp"), F.lit(1 << 30))
    return prints.filter(spot < F.least(share, F.lit(1.0)) * F.lit(float(1 << 30)))


def _deal(rows: DataFrame, trees: dict[int, tuple[Node, int]]) -> DataFrame:
    """Rows of the shards in ``trees`` dealt on; a tree comes with its first new shard's number."""
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        for batch in batches:
            shards, signed = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            stored = batch.column(2).to_numpy(zero_copy_only=False)
            for old in np.unique(shards).tolist():
                tree, first = shared.value[old]
                own = np.flatnonzero(shards == old)
                for shard, at, stays in route(tree, signed[own].view(np.uint64), stored[own]):
                    columns = [
                        pa.array(np.full(len(at), first + shard, np.int64)),
                        pa.array(signed[own[at]]),
                        pa.array(stays),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["shard", "fp", "stored"])

    return rows.mapInArrow(run, DEALT)


def _second_trees(
    rows: DataFrame, large: DataFrame, first: int
) -> tuple[dict[int, tuple[Node, int]], int]:
    """A tree for each shard named in ``large`` (shard, n, held), fitted on its stored rows.

    New shards are numbered from ``first``; the next free number is given back.

    Each is fitted in a task of its own on a sample of about ``SAMPLE``; the
    trees are small, and there is one for every ``SHARD_LIMIT`` rows at most.
    """
    sized = rows.filter("stored").join(F.broadcast(large), "shard")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        wanted = SHARD_LIMIT / 2 / pdf["n"].iloc[0]
        leaf = max(LEAST_SAMPLE, int(len(pdf) * wanted))
        tree, count = _fitted(pdf["fp"].to_numpy(), leaf)
        return pd.DataFrame(
            {"shard": [pdf["shard"].iloc[0]], "tree": [pickle.dumps(tree)], "count": [count]}
        )

    sample = _sampled(sized, SAMPLE / F.col("held"))
    found = sample.groupBy("shard").applyInPandas(fit, "shard long, tree binary, count long")
    trees = {}
    for shard, tree, count in sorted(tuple(r) for r in found.collect()):
        if count > 1:
            trees[shard] = (pickle.loads(bytes(tree)), first)
            first += count
    return trees, first


def shards_of(prints: DataFrame) -> DataFrame:
    """Distinct fingerprints ``fp`` dealt to shards: ``shard, fp, stored``.

    Every fingerprint is stored in one shard and visits all where a close one
    may be stored.  Shards of more than ``SHARD_LIMIT`` rows are dealt again
    until there are none, or only such whose sample of stored fingerprints has
    at most ``LEAST_SAMPLE``, which a tree cannot split.
    """
    total = prints.count()
    sample = _sampled(prints, F.lit(SAMPLE / max(1, total)))
    sample = np.array([r[0] for r in sample.select("fp").collect()], dtype=np.int64)
    leaf = max(LEAST_SAMPLE, int(SHARD_ROWS * len(sample) / max(1, total)))
    tree, count = _fitted(sample, leaf)
    whole = prints.select(F.lit(0).cast("long").alias("shard"), "fp", F.lit(True).alias("stored"))
    dealt = staged(_deal(whole, {0: (tree, 0)}), "simhash-shards")
    done = []
    while True:
        sizes = dealt.groupBy("shard").agg(
            F.count(F.lit(1)).alias("n"), F.count_if("stored").alias("held")
        )
        large = sizes.filter((F.col("n") > SHARD_LIMIT) & (F.col("held") > LEAST_SAMPLE))
        large = staged(large, "simhash-large")
        if large.isEmpty():
            break
        trees, count = _second_trees(dealt, large, count)
        if not trees:
            break
        names = dealt.sparkSession.createDataFrame([(x,) for x in trees], "shard long")
        done.append(dealt.join(F.broadcast(names), "shard", "left_anti"))
        again = dealt.join(F.broadcast(names), "shard", "left_semi").select("shard", "fp", "stored")
        dealt = staged(_deal(again, trees), "simhash-shards")
    for part in done:
        dealt = dealt.unionByName(part)
    return dealt


def close_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that join exactly the distinct fingerprints ``fp`` that are close.

    A shard gives one link per member of a group found in it, to the group's
    smallest fingerprint, never all pairs.
    """

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("fp", ignore_index=True)
        signed = pdf["fp"].to_numpy()
        roots = link_close(signed.view(np.uint64), pdf["stored"].to_numpy())
        moved = roots != np.arange(len(roots))
        return pd.DataFrame({"a": signed[moved], "b": signed[roots[moved]]})

    return shards_of(prints).groupBy("shard").applyInPandas(link, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id, text_hash``.

    Words are runs without ASCII white space, A-Z lower-cased; shingles are three
    words (a shorter text is one shingle).  Null and wordless texts have
    fingerprint zero and are linked like any others.  ``component_id`` is the
    smallest doc_id reachable over links; null ids count only where a component
    has no other.  Rows that repeat an id are documents of their own.  Texts of any
    length are read whole; an empty table gives no rows; other columns are ignored.
    """
    return _in_components(docs, id_col, text_col).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        F.col("mark").alias("text_hash"),
    )


def _in_components(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: ``id, mark, fp, root, component_id``.

    ``root`` is a fingerprint of the component, so unlike ``component_id`` no
    two components share it.
    """
    rows = staged(fingerprints(docs, id_col, text_col), "simhash")
    distinct = staged(rows.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    links = connected_components(close_links(distinct))
    labelled = distinct.join(links, distinct["fp"] == links["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    labelled = staged(labelled, "simhash-roots")
    smallest = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = labelled.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(classes, "fp").select("id", "mark", "fp", "root", "component_id")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The document with the smallest id of each component, with all its columns.

    Where several rows have that id, the one with the smallest text hash stays,
    and of rows that repeat both, one.  A null id is chosen only where a
    component has no other.
    """
    first = _in_components(docs, id_col, text_col)
    first = first.filter(F.col("id").eqNullSafe(F.col("component_id")))
    same = first.groupBy("root", "id", "mark").agg(F.count(F.lit(1)).alias("n"))
    first = same.groupBy("root").agg(F.min(F.struct("mark", "id", "n")).alias("r"))
    # named twice where rows repeat, so that one of them goes
    first = first.select("r.*", F.explode(F.sequence(F.lit(1), F.least("r.n", F.lit(2)))))
    return keep_once(
        docs,
        first.select("id", "mark"),
        id_col,
        F.xxhash64(F.coalesce(docs[text_col], F.lit(""))),
        "simhash-kept",
    )
