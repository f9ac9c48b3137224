"""Prefix trie of conversations, summed by time-forward processing.

A node is a sequence of turns with which conversations begin.  Its name is a
sum of hashes of (depth, turn) over the sequence, so names of all prefixes come
from running sums of numbers; equal names are proven to be equal sequences by
their parents and last turns.  Conversations that are equal throughout count
as one with a weight before anything is shuffled by node.

The trie is cut at the highest nodes below which few turns lie.  Within a
shard, nodes pass in reverse level order, and each sends its totals forward to
its parent through a priority queue that spills.  What the shards' roots send
is added up by parent, and the nodes above the cuts pass in the same way.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

#: Turns below a node that becomes the root of a shard, at most, and turns that a task takes.
SHARD_TURNS, TASK_TURNS = 100_000, 500_000
#: Messages that a queue holds before it spills, and messages of one spilled part.
QUEUE_LIMIT, SPILL_PART = 200_000, 4_096
#: 32-bit parts of a node's name.
NAME_PARTS = 4

TOTALS = "n_children long, n_leaves long, saved_tokens long"


# -- conversations -------------------------------------------------------------


def shared_history(c: Column) -> tuple[Column, Column]:
    """The conversation that opens conversation ``c``, and how many of its turns do."""
    return c - c % 100, (F.crc32(c.cast("string").cast("binary")) % 6).cast("int")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Turns of rebuilt conversations: ``conv, depth, role, text``; depth 0 stands for every one.

    A conversation begins with the first turns of another one and goes on with
    its own after as many.  Turns go by number, null first, then by role and
    text; null role or text is empty; rows without a conversation id belong to
    none and are left out.
    """
    blank = F.lit("")
    given = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    turns = given.select("conv", "role", "text", F.row_number().over(order).alias("nth"))
    turns = staged(turns, "prefix-turns")
    base, history = shared_history(F.col("conv"))
    heads = turns.groupBy("conv").agg(F.max("nth").alias("n"))
    heads = heads.select("conv", "n", base.alias("base"), history.alias("h"))
    lengths = heads.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    heads = heads.join(lengths, "base", "left")
    shift = F.least("h", F.coalesce("base_n", F.lit(0))) - F.col("h")
    heads = staged(heads.select("conv", "base", "h", shift.alias("shift")), "prefix-heads")
    openings = turns.filter("nth < 6").withColumnRenamed("conv", "base")
    first = heads.join(openings, "base").filter("nth <= h")
    rest = turns.join(heads, "conv").filter("nth > h")
    parts = [
        first.select("conv", F.col("nth").alias("depth"), "role", "text"),
        rest.select("conv", (F.col("nth") + F.col("shift")).alias("depth"), "role", "text"),
        heads.select("conv", F.lit(0).alias("depth"), blank.alias("role"), blank.alias("text")),
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def paths(turns: DataFrame) -> DataFrame:
    """``conv, depth, name, parent, last, size`` for every prefix of every conversation.

    Only numbers go through the window: a turn is its digest and its size.
    """
    role, text = F.col("role"), F.col("text")
    last = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    parts = []
    for k in range(0, NAME_PARTS, 2):
        h = F.xxhash64(last, F.col("depth"), F.lit(k))
        parts += [F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF))]
    named = turns.select(
        "conv",
        "depth",
        last.alias("last"),
        F.length(text).cast("long").alias("size"),
        *[F.when(F.col("depth") > 0, p).otherwise(0).alias(f"p{i}") for i, p in enumerate(parts)],
    )
    along = Window.partitionBy("conv").orderBy("depth")
    sums = [F.sum(f"p{i}").over(along).cast("string") for i in range(NAME_PARTS)]
    name = F.md5(F.concat_ws(":", F.col("depth").cast("string"), *sums))
    named = named.select("conv", "depth", "last", "size", name.alias("name"))
    return named.withColumn("parent", F.lag("name").over(along))


# -- priority queue -------------------------------------------------------------


class SpillingQueue:
    """Messages (level, name, leaves, saved) by level, deepest first, then name.

    A full queue gives its messages away as compressed sorted parts, which are
    opened one after the other while messages are taken.
    """

    def __init__(self, limit: int | None = None):
        self.limit = limit or QUEUE_LIMIT
        self.heap: list[tuple] = []
        self.runs: list[tuple[tuple, int, Iterator[tuple]]] = []

    def put(self, depth: int, name: bytes, leaves: int, saved: int) -> None:
        heapq.heappush(self.heap, (-depth, name, leaves, saved))
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        self.heap.sort()
        packed = []
        for at in range(0, len(self.heap), SPILL_PART):
            part = self.heap[at : at + SPILL_PART]
            numbers = np.array([(d, x, y) for d, _, x, y in part], np.int64).tobytes()
            packed.append(zstandard.compress(numbers + b"".join(n for _, n, _, _ in part), 1))
        self.heap = []
        self._open(self._read(packed))

    @staticmethod
    def _read(packed: list[bytes]) -> Iterator[tuple]:
        for data in packed:
            data = zstandard.decompress(data)
            count = len(data) // 40
            numbers = np.frombuffer(data, np.int64, 3 * count).reshape(count, 3).tolist()
            for k, (depth, leaves, saved) in enumerate(numbers):
                at = 24 * count + 16 * k
                yield depth, data[at : at + 16], leaves, saved

    def _open(self, run: Iterator[tuple]) -> None:
        message = next(run, None)
        if message is not None:
            heapq.heappush(self.runs, (message, id(run), run))

    def take(self, depth: int, name: bytes) -> tuple[int, int, int]:
        """Children, leaves and savings sent to a node; it must be the next in order."""
        children = leaves = saved = 0
        to = (-depth, name)
        while self.heap and self.heap[0][:2] == to:
            message = heapq.heappop(self.heap)
            children, leaves, saved = children + 1, leaves + message[2], saved + message[3]
        while self.runs and self.runs[0][0][:2] == to:
            message, _, run = heapq.heappop(self.runs)
            children, leaves, saved = children + 1, leaves + message[2], saved + message[3]
            self._open(run)
        return children, leaves, saved


def _time_forward(batches):
    """Totals of nodes that come in reverse level order: children before their parents.

    Columns: name, parent, depth, own savings, whether the parent comes here
    too, and what children elsewhere sent.
    """
    queue = SpillingQueue()
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in batch.schema.names]
        out = []
        for name, parent, depth, own, linked, far_children, far_leaves, far_saved in zip(*columns, strict=True):
            key = bytes.fromhex(name)
            children, leaves, saved = queue.take(depth, key)
            children, leaves, saved = children + far_children, leaves + far_leaves, saved + far_saved + own
            leaves = leaves or 1
            if linked:
                queue.put(depth - 1, bytes.fromhex(parent), leaves, saved)
            out.append((name, children, leaves, saved))
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        columns = list(zip(*out, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["name", "n_children", "n_leaves", "saved_tokens"],
        )


# -- trie -----------------------------------------------------------------------


def _ends(batches):
    """Digest of the ids that end at each node; they come sorted by node and id."""
    last, digest = None, None

    def row(name, digest):
        return pa.RecordBatch.from_arrays(
            [pa.array(name, pa.string()), pa.array(digest, pa.string())], ["name", "ends_sha256"]
        )

    for batch in batches:
        names, digests = [], []
        for name, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if name != last:
                if digest is not None:
                    names.append(last)
                    digests.append(digest.hexdigest())
                last, digest = name, hashlib.sha256(str(conv).encode())
            else:
                digest.update(b",%d" % conv)
        yield row(names, digests)
    if digest is not None:
        yield row([last], [digest.hexdigest()])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    ``conv_id`` is the smallest member, which with ``depth`` names the node;
    ``parent_conv_id`` is the parent's (null for the root); ``n_convs`` members,
    ``n_children``, ``n_leaves`` below (a leaf counts itself), ``saved_tokens``:
    code points that storing each node once saves in the subtree;
    ``ends_sha256``: digest of the ids of the members that end here.  Other
    columns are ignored; equal turn numbers and repeated rows are turns of
    their own; no conversations give no rows.
    """
    every = staged(paths(rebuilt(conversations)), "prefix-paths")

    # equal conversations go on as their smallest one, with a weight
    final = every.groupBy("conv").agg(F.max_by("name", "depth").alias("name"), F.max("depth").alias("turns"))
    final = staged(final, "prefix-ends")
    ordered = final.select("name", "conv").repartition("name").sortWithinPartitions("name", "conv")
    ends = ordered.mapInArrow(_ends, "name string, ends_sha256 string")
    sole = final.groupBy("name").agg(F.min("conv").alias("conv"), F.count("*").alias("weight"), F.max("turns").alias("turns"))
    steps = every.join(sole.select("conv", "weight", "turns"), "conv")
    nodes = steps.groupBy("name").agg(
        F.min("conv").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.sum("weight").alias("n_convs"),
        F.max("parent").alias("parent"),
        F.max("size").alias("size"),
        F.sum(F.col("turns") - F.col("depth") + 1).alias("below"),
        ((F.min("parent") != F.max("parent")) | (F.min("last") != F.max("last"))).alias("mixed"),
    )
    nodes = staged(nodes, "prefix-nodes")
    if not nodes.filter("mixed").isEmpty():
        raise ArithmeticError("different prefixes share a name")

    totals = _totals(nodes, steps.select("conv", "name"))
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    found = nodes.join(totals, "name").join(ends, "name", "left").join(parents, "parent", "left")
    return found.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def _totals(nodes: DataFrame, steps: DataFrame) -> DataFrame:
    """``name`` and totals of every node: those within shards first, then those above the cuts.

    ``steps`` holds the nodes on the way of every conversation.
    """
    small = F.col("below") <= SHARD_TURNS
    above = nodes.select(F.col("name").alias("parent"), small.alias("inside"))
    marked = nodes.join(above, "parent", "left").select(
        "name",
        "parent",
        "depth",
        "conv_id",
        "below",
        ((F.col("n_convs") - 1) * F.col("size")).alias("own"),
        small.alias("small"),
        F.coalesce("inside", F.lit(False)).alias("linked"),
    )
    marked = staged(marked, "prefix-marked")
    roots = marked.filter("small and not linked")
    tasks = -(-(roots.agg(F.sum("below")).first()[0] or 0) // TASK_TURNS) or 1
    # a conversation's way crosses one shard root at most; all nodes below lie in its shard
    shard_of = steps.join(roots.select("name", F.col("name").alias("shard")), "name")
    shard_of = shard_of.select(F.col("conv").alias("conv_id"), "shard")
    zero = F.lit(0).cast("long")
    far = ("far_children", "far_leaves", "far_saved")
    inside = marked.filter("small").join(shard_of, "conv_id").repartition(tasks, "shard")
    inside = inside.sortWithinPartitions(F.desc("depth"), "name")
    inside = inside.select("name", "parent", "depth", "own", "linked", *[zero.alias(c) for c in far])
    inside = staged(inside.mapInArrow(_time_forward, f"name string, {TOTALS}"), "prefix-shards")

    sent = roots.join(inside, "name").groupBy(F.col("parent").alias("name")).agg(
        F.count("*").alias(far[0]), F.sum("n_leaves").alias(far[1]), F.sum("saved_tokens").alias(far[2])
    )
    top = marked.filter("not small").join(sent, "name", "left").select(
        "name",
        "parent",
        "depth",
        "own",
        F.col("parent").isNotNull().alias("linked"),
        *[F.coalesce(c, zero).alias(c) for c in far],
    )
    # the nodes above all cuts are few: each has more than a shard below it
    top = top.repartition(1).sortWithinPartitions(F.desc("depth"), "name")
    return inside.unionByName(top.mapInArrow(_time_forward, f"name string, {TOTALS}"))
