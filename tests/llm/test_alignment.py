"""Alignment against plain loops over whole texts, and its defined results on awkward rows."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import alignment, units
from tidemark.llm.queries import QUERIES

NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def pair():
    a = Tokenizer.from_file(units.BYTE_BPE_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_PATH)


def spelled(pair, text):
    """Tokens of both sides with their bytes, or None."""
    a, b = pair
    values, names = units._byte_values(), {i: t for t, i in a.get_vocab().items()}
    left = [(i, bytes(values[c] for c in names[i])) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    raw = (" " + text).encode()
    same = all(b"".join(x for _, x in side) == raw for side in (left, right))
    return (left, right) if same else None


def spans(side):
    at, out = 0, []
    for i, raw in side:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain(pair, docs):
    """Rows by comparing every token with its neighbours, document by document."""
    found = []
    total = Counter()
    for text in docs:
        sides = spelled(pair, text) if text else None
        if sides is None:
            found.append(None)
            continue
        a, b = map(spans, sides)
        links = Counter((i, j) for i, s, e in a for j, p, q in b if s < q and p < e)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, begin = [], 0
        for end in ends:
            own = [",".join(str(i) for i, s, e in side if begin <= s and e <= end) for side in (a, b)]
            groups.append("|".join(own))
            begin = end
        found.append((len(a), len(b), len(groups), links, ";".join(groups)))
        total.update(links)
    most = defaultdict(int)
    for (_, j), n in total.items():
        most[j] = max(most[j], n)
    rows = []
    for x in found:
        if x is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, text = x
        best = sum(n for p, n in links.items() if total[p] == most[p[1]])
        summed = sum(n * total[p] for p, n in links.items())
        digest = hashlib.sha256(text.encode()).hexdigest()
        rows.append((n_a, n_b, n_groups, sum(links.values()), best, summed, digest))
    return rows, total, most


def as_rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", *NAMES).collect()), key=str)


def short(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return docs.filter("n_chars < 1500")


def test_equals_plain_loops(spark, sf, pair):
    docs = short(spark, sf)
    rows = docs.select("doc_id", "text").collect()
    want, total, most = plain(pair, [r.text for r in rows])
    found = alignment.align_corpus(docs)
    assert as_rows(found.documents) == sorted(((r.doc_id, *w) for r, w in zip(rows, want)), key=str)
    pairs = {(r.a_id, r.b_id): (r.links, r.best) for r in found.pairs.collect()}
    assert pairs == {p: (n, n == most[p[1]]) for p, n in total.items()}


def test_small_blocks_rounds_and_salts_change_nothing(spark, sf, monkeypatch):
    docs = short(spark, sf)
    want = as_rows(alignment.align_corpus(docs).documents)
    monkeypatch.setattr(alignment, "FAN_IN", 2)
    monkeypatch.setattr(alignment, "TASK_RUNS", 3)
    spread = docs.repartition(7)
    assert as_rows(alignment.align_corpus(spread).documents) == want


def test_query_covers_the_whole_table(spark, sf):
    got = QUERIES["op11_align_tokenizers"](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert got.filter("n_a = 0 or n_links < n_a or n_best > n_links").isEmpty()


def test_awkward_rows(awkward, clashing, no_docs, pair):
    # the very long texts are too long for the plain loops: cut here, whole below
    docs = [r for r in awkward.select("doc_id", "text").collect() if len(r.text or "") < 10_000]
    want, *_ = plain(pair, [r.text for r in docs])
    small = awkward.filter("text is null or length(text) < 10000")
    want = sorted(((r.doc_id, *w) for r, w in zip(docs, want)), key=str)
    assert as_rows(alignment.align_corpus(small).documents) == want
    assert as_rows(alignment.align_corpus(clashing).documents) == as_rows(
        alignment.align_corpus(awkward).documents
    )
    none = alignment.align_corpus(no_docs)
    assert none.documents.count() == 0 and none.pairs.count() == 0


def test_a_word_mark_in_the_text_leaves_no_tokens(spark, pair):
    rows = [("x", "under ▁ score"), ("y", "<|endoftext|> plain <s> <0x41>"), (None, "\x00 \x1c nul")]
    got = as_rows(alignment.align_corpus(spark.createDataFrame(rows, "doc_id string, text string")).documents)
    want, *_ = plain(pair, [t for _, t in rows])
    assert got == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=str)
    assert [r for r in got if r[0] == "x"] == [("x", 0, 0, 0, 0, 0, 0, "")]


def test_slices_of_a_long_text_add_up(spark, awkward, monkeypatch):
    aligner = alignment.UnitAligner(
        open(units.BYTE_BPE_PATH, encoding="utf-8").read(), open(alignment.PIECE_PATH, "rb").read()
    )
    text = awkward.filter("doc_id = 8").first().text[:60_000]
    (_, whole), = alignment._documents([text], aligner)
    monkeypatch.setattr(units, "SLICE_CHARS", 5_000)
    monkeypatch.setattr(units, "REMEMBERED", 20)  # and units are forgotten on the way
    (_, parts), = alignment._documents([text], aligner)
    assert whole.row() == parts.row() and len(parts.keys) > 5
    for x, y in zip(whole.pairs(), parts.pairs()):
        assert np.array_equal(x, y)


@given(st.lists(st.tuples(st.integers(0, 1 << 40), st.integers(0, 70_000)), max_size=50))
def test_runs_unpack_to_what_was_packed(rows):
    rows = sorted(rows)
    keys, counts = (np.array([r[i] for r in rows], np.int64) for i in (0, 1))
    back = alignment._unpack(alignment._pack(keys, counts))
    assert np.array_equal(back[0], keys) and np.array_equal(back[1], counts)


RUN = st.dictionaries(st.tuples(st.integers(0, 5), st.integers(0, 9)), st.integers(1, 9), max_size=20)


@given(st.lists(RUN, max_size=6))
def test_heap_merge_counts_every_pair(runs):
    coded = []
    for run in runs:
        keys = sorted(run, key=lambda p: (p[1] << alignment.LOW) | p[0])
        number = np.array([(b << alignment.LOW) | a for a, b in keys], np.int64)
        coded.append([number, np.array([run[k] for k in keys], np.int64)])
    total = sum(map(Counter, runs), Counter())
    merged = list(alignment._merged(coded))
    got = {(int(k) & ((1 << alignment.LOW) - 1), int(k) >> alignment.LOW): int(n) for ks, ns in merged for k, n in zip(ks, ns)}
    assert got == dict(total)
    sides = [int(ks[0]) >> alignment.LOW for ks, _ in merged]
    assert sides == sorted(set(sides))
