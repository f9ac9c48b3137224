import hashlib
import random

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import exact, golomb, simhash
from tidemark.llm.common import staged
from tidemark.llm.components import connected_components

LONG = "the quick brown fox jumps over the lazy dog and runs to the hills " * 4000


@given(st.lists(st.integers(0, 2**62), max_size=60))
@settings(max_examples=60, deadline=None)
def test_golomb_round_trip(values):
    values = np.sort(np.array(values, dtype=np.int64))
    assert (golomb.decode(len(values), *golomb.encode(values)) == values).all()


def test_exact_groups(awkward, clashing):
    for docs in (awkward, clashing):
        got = {}
        for r in exact.duplicate_groups(docs).collect():
            got.setdefault(r.doc_id, []).append(tuple(r)[1:4])
        assert got[1] == [(2, 3, False)]
        assert got[2] == [(2, 3, True)] * 2
        assert got[3] == [(4, 3, False)] and got[4] == [(4, 3, True)]
        assert sorted(got[None]) == [(4, 3, False), (9, 2, False)]
        assert got[7] == [(7, 1, True)]
    row = exact.duplicate_groups(awkward).filter("doc_id = 9").first()
    assert row.text_sha256 == hashlib.sha256(b"one").hexdigest()


def test_exact_keeps_one_row_and_all_columns(clashing):
    kept = exact.drop_duplicates(clashing)
    assert kept.columns == clashing.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6, 7, 8, 9, 10]


def test_exact_collisions_are_settled_by_bytes(spark, monkeypatch):
    """With one fingerprint value per row every row is a suspect; the groups stay exact."""
    monkeypatch.setattr(exact, "SPREAD", 1)
    monkeypatch.setattr(exact, "OWNER_ROWS", 40)
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('t', id % 170) AS text")
    got = exact.duplicate_groups(docs.repartition(5)).collect()
    assert len(got) == 300
    for r in got:
        twin = r.doc_id + 170 if r.doc_id + 170 < 300 else r.doc_id
        assert (r.keep_id, r.kept) == (twin, twin == r.doc_id)
        assert r.group_size == (2 if r.doc_id < 130 or r.doc_id >= 170 else 1)


def test_exact_texts_move_for_suspects_only(spark):
    """Before the byte comparison nothing is exchanged, and few rows without a twin get there."""
    docs = spark.range(20_000).selectExpr(
        "id", "concat('text ', IF(id < 1000, id % 500, id)) AS t"
    ).repartition(6)
    base = docs.withColumn("h", F.xxhash64("t"))
    rows = staged(base.select("h", F.spark_partition_id().alias("src")), "test-rows")
    found = staged(exact.suspects(rows, 20_000), "test-suspects")
    twins = {r.h for r in base.filter("id < 1000").select("h").distinct().collect()}
    got = {r.h for r in found.collect()}
    assert twins <= got and len(got - twins) < 20_000 * 2 / exact.SPREAD
    passed = exact.named(staged(base, "test-texts"), found)
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan.split("BroadcastExchange")[0]
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert passed.filter("id < 1000").count() == 1000
    assert passed.count() < 1000 + 19_000 // 8


def test_exact_copies_of_one_text_everywhere(spark, monkeypatch):
    """Many copies in many partitions, a bitmap of one word: each partition sends one fingerprint."""
    monkeypatch.setattr(exact, "FILTER_WORDS", 1)
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "IF(id % 3 = 0, 'the same', concat('own ', id)) AS text"
    )
    got = {r.doc_id: tuple(r)[1:4] for r in exact.duplicate_groups(docs.repartition(7)).collect()}
    assert len(got) == 3000
    for i, row in got.items():
        assert row == ((2997, 1000, i == 2997) if i % 3 == 0 else (i, 1, True))


def test_empty_tables(no_docs):
    assert exact.duplicate_groups(no_docs).count() == 0
    assert exact.drop_duplicates(no_docs).count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_first(no_docs).count() == 0


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", "  ", "a", "A b", "a b c", "É a\x0bB c d e f", "x " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def plain_components(prints):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= simhash.RADIUS:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(prints))]


def clustered(n, seed):
    """Fingerprints in chains around a few centres, some far ones, all distinct."""
    r = random.Random(seed)
    centres = [r.getrandbits(64) for _ in range(12)]
    out = set()
    while len(out) < n:
        x = r.choice(centres)
        for _ in range(r.randint(0, 9)):
            x ^= 1 << r.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("leaf,shard_rows", [(48, 20_000), (4, 60)])
def test_close_links_lose_nothing(spark, monkeypatch, leaf, shard_rows):
    monkeypatch.setattr(simhash, "LEAF", leaf)
    monkeypatch.setattr(simhash, "SHARD_ROWS", shard_rows)
    prints = clustered(700, 3)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    found = {r.node: r.root for r in connected_components(simhash.close_links(frame)).collect()}
    want = plain_components(prints)
    groups = {}
    for x, w in zip(signed, want, strict=True):
        groups.setdefault(w, set()).add(found.get(x, x))
    assert all(len(g) == 1 for g in groups.values())
    assert len({g.pop() for g in groups.values()}) == len(groups)


def test_shards_grow_with_the_rows(spark, monkeypatch):
    """Large shards are dealt again: none stays above the limit, and no link is lost."""
    for name, value in (("SAMPLE", 64), ("LEAST_SAMPLE", 8), ("SHARD_ROWS", 50)):
        monkeypatch.setattr(simhash, name, value)
    r = random.Random(5)
    prints = {r.getrandbits(64) for _ in range(1500)}
    prints = sorted(prints | {x ^ (1 << r.randrange(64)) for x in sorted(prints)[:300]})
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    shards = {}
    for limit in (100_000, 250):
        monkeypatch.setattr(simhash, "SHARD_LIMIT", limit)
        sizes = simhash.shards_of(frame).groupBy("shard").agg(
            F.count(F.lit(1)).alias("n"), F.count_if("stored").alias("held")
        )
        rows = sizes.collect()
        assert sum(x.held for x in rows) == len(prints)
        assert all(x.n <= limit or x.held <= 8 for x in rows)
        shards[limit] = len(rows)
    assert shards[250] > 2 * shards[100_000]
    found = {x.node: x.root for x in connected_components(simhash.close_links(frame)).collect()}
    groups = {}
    for x, w in zip(signed, plain_components(prints), strict=True):
        groups.setdefault(w, set()).add(found.get(x, x))
    assert all(len(g) == 1 for g in groups.values())
    assert len({g.pop() for g in groups.values()}) == len(groups)


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    assert {r.root for r in connected_components(edges).collect()} == {0}


def test_near_duplicates(awkward, spark):
    got = {}
    for r in simhash.near_duplicates(awkward).collect():
        got.setdefault(r.doc_id, []).append((r.fingerprint, r.component_id))
    assert {c for k in (3, 4, 5) for _, c in got[k]} == {3}
    assert got[4][0][0] == "0" * 16
    assert {c for k in (1, 2) for _, c in got[k]} == {1}
    assert got[7][0] == (f"{plain_fingerprint(LONG):016x}", 7)
    kept = sorted(r.doc_id for r in simhash.keep_first(awkward).collect())
    assert [k for k in kept if k != 8] == [1, 3, 6, 7, 9, 10]


def test_near_duplicates_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    ids = sorted(got)
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = [plain_fingerprint(texts[i]) for i in ids]
    for i, p, root in zip(ids, prints, plain_components(prints), strict=True):
        assert got[i].fingerprint == f"{p:016x}"
        assert got[i].component_id == ids[root]


def test_clashing_columns_survive(clashing):
    assert simhash.keep_first(clashing).columns == clashing.columns



FAR = [
    "alpha beta gamma delta epsilon zeta eta theta",
    "one two three four five six seven eight nine",
    "the quick brown fox jumps over the lazy dog",
]


def kept_texts(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((r.doc_id or 0, r.text) for r in simhash.keep_first(docs).collect())


def test_components_without_an_id_keep_one_each(spark):
    rows = [(None, t) for t in FAR] + [(None, FAR[0])]
    assert kept_texts(spark, rows) == sorted((0, t) for t in FAR)


def test_components_with_the_same_smallest_id_keep_one_each(spark):
    rows = [(1, FAR[0]), (1, FAR[1]), (2, FAR[1]), (3, FAR[2]), (3, FAR[2])]
    assert kept_texts(spark, rows) == sorted([(1, FAR[0]), (1, FAR[1]), (3, FAR[2])])
