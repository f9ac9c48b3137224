"""The prefix trie against a plain dictionary of prefixes, and its queue against a sorted list."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import prefixes

NAMES = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
]
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """Every prefix as a key of a dictionary."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, ids in members.items():
        worth = (len(ids) - 1) * len(path[-1][1]) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += worth
            leaves[path[:d]] += path not in children
    out = []
    for path, ids in members.items():
        parent = members[path[:-1]][0] if path else None
        digest = hashlib.sha256(",".join(map(str, ends.get(path, ()))).encode()).hexdigest()
        out.append((ids[0], len(path), parent, len(ids), children.get(path, 0), leaves[path], saved[path], digest))
    return sorted(out, key=str)


def as_rows(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=str)


@pytest.fixture(scope="module")
def awkward_turns():
    rows = [
        (0, 0, "system", "same"), (0, 1, "user", "a"), (0, 2, "assistant", "b"),
        (1, 0, "user", "x"), (1, None, None, None), (1, 5, "user", "x"), (1, 5, "user", "x"), (1, 5, "a", "x"),
        (None, 0, "user", "nobody's"), (None, None, None, None),
        (205, 3, "", ""), (205, 1, None, "é\U0001f389"), (-7, 0, "user", "neg"), (-7, 1, "a", None),
        (-250, 0, "user", "neg"), (12345678901, 0, "user", "far"), (7, 9, "user", "long " * 60_000),
    ]
    rows += [(300 + i, t, "user", f"turn {t}") for i in range(100) for t in range(8)]
    rows += [(i, t, "user", f"t{t}") for i in (401, 402) for t in range(60)]
    return rows


def test_awkward_rows(spark, awkward_turns):
    df = spark.createDataFrame(awkward_turns, SCHEMA).repartition(3)
    want = plain(awkward_turns)
    assert as_rows(prefixes.prefix_trie(df)) == want
    clashing = df.select("*", *[F.lit(i).alias(c) for i, c in enumerate("name parent depth conv base n h".split())])
    assert as_rows(prefixes.prefix_trie(clashing)) == want


def test_empty_table(spark):
    assert prefixes.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    only_null = spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)
    assert prefixes.prefix_trie(only_null).count() == 0


@pytest.mark.parametrize("turns", [1, 20, 300])
def test_cuts_and_spills_change_nothing(spark, sf, awkward_turns, monkeypatch, turns):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select(*[c.split()[0] for c in SCHEMA.split(", ")]).collect()]
    rows += [(c + 10_000 if c is not None else c, *rest) for c, *rest in awkward_turns]
    want = plain(rows)
    monkeypatch.setattr(prefixes, "SHARD_TURNS", turns)
    monkeypatch.setattr(prefixes, "TASK_TURNS", 100)
    df = spark.createDataFrame(rows, SCHEMA)
    assert as_rows(prefixes.prefix_trie(df)) == want


def test_rebuilt_turns_are_gapless(spark, awkward_turns):
    turns = prefixes.rebuilt(spark.createDataFrame(awkward_turns, SCHEMA))
    per = turns.groupBy("conv").agg(F.max("depth").alias("d"), F.count("*").alias("n"), F.countDistinct("depth").alias("k"))
    assert per.filter("n <> d + 1 or k <> n").isEmpty()


MESSAGE = st.tuples(st.integers(0, 6), st.integers(0, 9), st.integers(0, 99), st.integers(0, 99))


@given(st.lists(MESSAGE, max_size=60), st.integers(1, 8))
def test_queue_gives_each_node_its_messages(messages, limit):
    queue, want = prefixes.SpillingQueue(limit), defaultdict(lambda: [0, 0, 0])
    for depth, node, leaves, saved in messages:
        name = bytes([node]) * 16
        queue.put(depth, name, leaves, saved)
        for i, x in enumerate((1, leaves, saved)):
            want[-depth, name][i] += x
    for depth, name in sorted(want):
        assert list(queue.take(-depth, name)) == want[depth, name]
    assert queue.take(0, b"z" * 16) == (0, 0, 0) and not queue.heap and not queue.runs
