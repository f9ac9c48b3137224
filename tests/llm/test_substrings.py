import hashlib
import random
import tracemalloc

import numpy as np
import pytest
import zstandard

from tidemark.llm import golomb, substrings


def plain(rows):
    """Removed bytes by comparing all 50-byte strings."""
    first = {}
    data = [(-(2**63) if i is None else i, (t or "").encode()) for i, t in rows]
    for i, t in data:
        for s in range(len(t) - 49):
            first[t[s : s + 50]] = min(first.get(t[s : s + 50], i), i)
    out = []
    for (i, t), (given, _) in zip(data, rows, strict=True):
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - 49):
            if first[t[s : s + 50]] < i:
                gone[s : s + 50] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((given, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


def made(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abé ") for _ in range(r.randint(1, 9)))
    base = ["".join(word() for _ in range(60)) for _ in range(4)]
    rows = []
    for i in range(40):
        t = r.choice(base)
        cut = r.randrange(len(t))
        t = t[cut:] + r.choice(["", "x" * r.randint(40, 300), word()]) + t[: r.randrange(len(t))]
        rows.append((r.choice([i, i, i, None, 7]), t if r.random() < 0.95 else None))
    rows += [(90, "ab" * 200), (91, "ba" * 180), (92, "x" * 49), (93, "x" * 50), (94, "")]
    return rows + rows[:3]


@pytest.mark.parametrize("seed,block", [(1, 8 << 20), (2, 3000), (3, 500)])
def test_against_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(substrings, "BLOCK_BYTES", block)
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 2 * block)
    monkeypatch.setattr(substrings, "OWNER_NAMES", block)
    rows = made(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = substrings.find_repeats(docs).drop("spans").collect()
    assert sorted(str(tuple(r)) for r in found) == plain(rows)


def test_awkward_rows(awkward, clashing, no_docs):
    rows = [(r.doc_id, r.text) for r in awkward.collect() if r.doc_id not in (7, 8)]
    found = substrings.find_repeats(clashing).drop("spans").collect()
    small = [str(tuple(r)) for r in found if r.doc_id not in (7, 8)]
    assert sorted(small) == plain(rows)
    long = {r.doc_id: r for r in found if r.doc_id in (7, 8)}
    assert long[7].n_removed == 0 and long[8].n_removed == long[8].n_bytes - 1
    assert substrings.find_repeats(no_docs).count() == 0


def templated():
    """Texts of 50 bytes that differ in the bytes at 16 and 24 alone."""
    text = "entry of the ledger number 0 and then the rest: ok"
    return [text[:16] + a + text[17:24] + b + text[25:] for a in "0123456789" for b in "0123456789"]


def test_names_of_two_changed_bytes_eight_apart():
    made_ = [substrings.names(t.encode()) for t in templated()]
    assert len({int(full[0]) for _, full in made_}) == 100
    assert len({int(half[0]) for half, _ in made_}) == 100
    at = np.zeros(1, np.int64)
    assert len({int(substrings.checks(t.encode(), at)[0]) for t in templated()}) == 100


def test_two_changed_bytes_eight_apart_remove_nothing(spark):
    rows = list(enumerate(templated()))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = substrings.find_repeats(docs).drop("spans").collect()
    assert sorted(str(tuple(r)) for r in found) == plain(rows)
    assert not any(r.n_removed for r in found)


def test_clashing_window_names_are_settled_by_the_second_hash(spark, monkeypatch):
    """With names of windows of very few bits only the second hash tells them apart."""
    monkeypatch.setattr(substrings, "WINDOW_BITS", 3)
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 3000)
    rows = made(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = substrings.find_repeats(docs).drop("spans").collect()
    assert sorted(str(tuple(r)) for r in found) == plain(rows)


def test_names_at_some_positions_equal_those_at_all():
    r = random.Random(5)
    data = bytes(r.randrange(256) for _ in range(400))
    at = np.array([0, 3, 7, 200, 350])
    assert np.array_equal(substrings.names_at(data, at), substrings.names(data)[1][at])


def test_ids_must_have_an_order_of_numbers(spark):
    docs = spark.createDataFrame([("a", "x" * 60)], "doc_id string, text string")
    with pytest.raises(ValueError, match="whole numbers"):
        substrings.find_repeats(docs)


def packed(texts):
    """A block as ``pack`` makes it."""
    return {
        "ids": np.arange(len(texts), dtype=np.int64).tobytes(),
        "sizes": np.array([len(t) for t in texts], np.int32).tobytes(),
        "payload": zstandard.compress(b"".join(texts)),
    }


def awkward_texts(seed):
    r = random.Random(seed)
    base = bytes(r.randrange(97, 101) for _ in range(900))
    sizes = [0, 0, 1, 49, 50, 51, 0, 24, 74, 75, 76, 900, 300, 49, 7, 0, 260, 50, 0]
    texts = [base[r.randrange(900 - n + 1) :][:n] for n in sizes]
    return [*texts, b"z" * 400, b"", b"z" * 60, b"ab" * 130, b"", b"x" * 20]


def plain_runs(texts):
    """Text, first and last window, name and bytes of each run, from one text at a time."""
    out, base = [], 0
    for k, t in enumerate(texts):
        if len(t) >= 50:
            half, full = substrings.names(t)
            least = [min(half[p : p + 26].tolist()) for p in range(len(t) - 49)]
            edges = [0, *(p for p in range(1, len(least)) if least[p] != least[p - 1]), len(least)]
            for a, b in zip(edges, edges[1:], strict=False):
                step = 50 if b - a > 50 else b - a
                for first in range(a, b, step):
                    last = min(first + step, b) - 1
                    both = substrings._pair(full[first : first + 1], full[last : last + 1])
                    whole = int(both[0]) ^ (last - first)
                    out.append((k, base + first, base + last, least[first], whole))
        base += len(t)
    return out


@pytest.mark.parametrize("portion", [1, 64, 1000, 1 << 14])
def test_runs_of_texts_hashed_together_are_those_of_each_text(monkeypatch, portion):
    monkeypatch.setattr(substrings, "PORTION", portion)
    for texts in (awkward_texts(1), awkward_texts(2), [b""] * 9, [b"x" * 30] * 3, []):
        block, wanted = substrings.Block(packed(texts)), plain_runs(texts)
        shift = np.uint64(64 - substrings.RUN_BITS)
        assert block.doc.tolist() == [w[0] for w in wanted]
        assert block.first.tolist() == [w[1] for w in wanted]
        assert block.last.tolist() == [w[2] for w in wanted]
        name = substrings._mix(np.array([w[3] for w in wanted], np.uint64)) >> shift
        assert block.name.tolist() == name.tolist()
        assert block.whole.tolist() == [w[4] for w in wanted]


@pytest.mark.parametrize("portion", [1, 64, 1000, 1 << 14])
def test_hashes_of_windows_are_those_of_their_bytes(monkeypatch, portion):
    monkeypatch.setattr(substrings, "PORTION", portion)
    data = b"".join(awkward_texts(3))
    full = substrings.names(data)[1]
    r = random.Random(3)
    far = sorted(r.sample(range(len(full)), 40))
    for at in (np.arange(len(full)), np.array(far), np.array([0, 42, 85, len(full) - 1]), np.zeros(0, int)):
        name, check = substrings.hashes_at(data, at)
        assert np.array_equal(name, full[at])
        assert np.array_equal(check, substrings.checks(data, at))


def test_windows_come_run_by_run_whatever_the_order_of_the_runs():
    texts = awkward_texts(4)
    block = substrings.Block(packed(texts))
    own = np.random.default_rng(4).permutation(len(block.first))
    name, check = block.windows(block.first[own], block.last[own])
    at = np.concatenate([np.arange(block.first[k], block.last[k] + 1) for k in own])
    data = b"".join(texts)
    assert name.tolist() == [int(x) >> 2 for x in substrings.names(data)[1][at]]
    assert np.array_equal(check, substrings.checks(data, at))


def test_equal_names_are_ordered_by_the_second_hash():
    r = np.random.default_rng(5)
    name, check = r.integers(0, 40, 500), r.integers(0, 3, 500).astype(np.uint64)
    check[name < 20] = 7
    order = substrings._sorted(name, check)
    assert sorted(order.tolist()) == list(range(500))
    found = list(zip(name[order].tolist(), check[order].tolist(), strict=True))
    assert found == sorted(found)
    assert substrings._sorted(name[:0], check[:0]).tolist() == []


def test_hashing_is_shared_by_neighbouring_strings(monkeypatch):
    """What is hashed follows the bytes of a block, not its windows times their words."""
    mix, sizes = substrings._mix, []
    monkeypatch.setattr(substrings, "_mix", lambda x: (sizes.append(x.size), mix(x))[1])
    r = random.Random(6)
    texts = [bytes(r.randrange(256) for _ in range(500)) for _ in range(400)]
    substrings.Block(packed(texts))
    assert sum(sizes) < 3.5 * 500 * 400
    assert len(sizes) < 400
    sizes.clear()
    data = b"".join(texts)
    at = np.concatenate([np.arange(k, k + 26) for k in range(0, len(data) - 100, 60)])
    substrings.names_at(data, at)
    assert sum(sizes) < 12 * len(at)


def test_owners_get_as_many_names():
    """Names of runs are the smallest of many, which must not all go to the first owner."""
    r = random.Random(9)
    block = substrings.Block(packed([r.randbytes(200_000)]))
    listed = substrings._list_of_names(block)
    sizes = [hi - lo for _, lo, hi, _ in substrings._shares(listed, substrings.RUN_BITS, 28)]
    assert len(sizes) == 28 and max(sizes) < 1.5 * len(listed) / 28


def test_golomb_codes_of_every_width():
    r = np.random.default_rng(7)
    for most in (0, 1, 2, 100, 1 << 20, 1 << 41, (1 << 62) - 1):
        for n in (0, 1, 7, 100):
            values = np.sort(r.integers(0, most, n, endpoint=True))
            width, unary, rest = golomb.encode(values)
            assert np.array_equal(golomb.decode(n, width, unary, rest), values)
            gaps = np.diff(values, prepend=0).tolist()
            bits = [g >> k & 1 for g in gaps for k in range(width)]
            assert rest == np.packbits(np.array(bits, np.uint8)).tobytes()


def test_golomb_coding_holds_bits_not_numbers():
    values = np.sort(np.random.default_rng(8).integers(0, 1 << 60, 50_000))
    tracemalloc.start()
    coded = golomb.encode(values)
    golomb.decode(len(values), *coded)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 250 * len(values)
