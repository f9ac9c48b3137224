"""Packing against a plain loop over whole texts, and its defined results on awkward rows."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import units
from tidemark.llm.packing import binary_lengths, pack_documents, write_buckets
from tidemark.llm.queries import QUERIES

NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(units.BYTE_BPE_PATH)


def plain(tokenizer, docs):
    """Pieces by encoding every text whole."""
    out = []
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        at, size = 0, 1024
        while at < len(ids):
            while size > len(ids) - at:
                size //= 2
            piece = np.array(ids[at : at + size], "<u4").tobytes()
            out.append((doc_id, at, size, zlib.crc32(piece), len(ids)))
            at += size
    return out


def as_rows(df):
    return sorted((tuple(r) for r in df.select(*NAMES).collect()), key=str)


def test_query_equals_whole_text_encoding(spark, sf, tokenizer):
    got = QUERIES["op12_pack_documents"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert as_rows(got) == sorted(plain(tokenizer, docs), key=str)
    sums = got.agg(F.count("*"), F.countDistinct("sequence_id"), F.max("offset")).first()
    assert sums[0] == sums[1] and sums[2] == 0
    full = got.filter("length & (length - 1) <> 0 OR length > 1024").count()
    assert full == 0


def test_awkward_rows(awkward, clashing, no_docs, tokenizer):
    docs = [(r.doc_id, r.text) for r in awkward.collect()]
    want = sorted(plain(tokenizer, docs), key=str)
    assert as_rows(pack_documents(awkward)) == want
    assert as_rows(pack_documents(clashing)) == want
    assert pack_documents(no_docs).count() == 0


def test_string_ids_and_special_strings(spark, tokenizer):
    docs = [("a", "x <|endoftext|> y<|endoftext|>"), (None, "  two  spaces \n\n\t tab "), ("b", None)]
    df = spark.createDataFrame(docs, "doc_id string, text string")
    assert as_rows(pack_documents(df)) == sorted(plain(tokenizer, docs), key=str)


def test_ids_rebuild_the_document(awkward, tokenizer):
    by_doc = defaultdict(list)
    for r in pack_documents(awkward.filter("doc_id = 7")).collect():
        by_doc[r.doc_id].append((r.start, r.ids))
    ids = [i for _, part in sorted(by_doc[7]) for i in part]
    text = awkward.filter("doc_id = 7").first().text
    assert ids[-1] == 0 and tokenizer.decode(ids[:-1], skip_special_tokens=False) == text


def test_buckets_are_written_by_length(spark, awkward, tmp_path):
    packed = pack_documents(awkward)
    write_buckets(packed, str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert as_rows(back) == as_rows(packed)
    assert back.filter("size(ids) <> length").count() == 0


@given(st.integers(1, 10_000), st.integers(0, 11))
def test_binary_lengths_add_up(n, k):
    found = binary_lengths(n, 1 << k)
    assert sum(found) == n and found == sorted(found, reverse=True)
    rest = [x for x in found if x < 1 << k]
    assert len(set(rest)) == len(rest) and all(x & (x - 1) == 0 for x in found)


DATA = open(units.BYTE_BPE_PATH, encoding="utf-8").read()
BPE = {special: units.ByteBpe(DATA, special) for special in (False, True)}
TEXT = st.text(st.sampled_from("ab'sZ9 \n\t\u3000\u00a0é▁漢\x1c.,<|ß½²"), max_size=40)


@pytest.mark.parametrize("special", [False, True])
@given(TEXT)
def test_units_encode_like_the_whole(special, text):
    bpe, text = BPE[special], text.replace("<", "<|endoftext|>")
    parts = units.UNIT.findall(text)
    assert "".join(parts) == text
    coded = [i for ids in bpe.encode(parts) for i in ids.tolist()]
    assert coded == bpe.tokenizer.encode(text, add_special_tokens=False).ids


def test_latin_letters_are_encoded_alike_by_both_libraries():
    words = [f"{a}{chr(c)}{b}" for c in range(0x250) for a in ("", " ", "x", " x1") for b in ("", "y", " ")]
    bpe = BPE[True]
    want = [c.ids for c in bpe.tokenizer.encode_batch(words, add_special_tokens=False)]
    assert [bpe.quick.encode_ordinary(w) for w in words] == want


def test_slices_end_at_units(monkeypatch):
    monkeypatch.setattr(units, "SLICE_CHARS", 10)
    text = "alpha beta\n gamma  delta epsilonzetaetatheta \n\n iota " * 3
    parts = list(units.slices(text))
    assert len(parts) > 3 and "".join(parts) == text
    assert [u for p in parts for u in units.UNIT.findall(p)] == units.UNIT.findall(text)
