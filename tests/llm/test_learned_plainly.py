"""Language and toxicity predictions against plain loops over whole texts."""

import math

import zstandard
from pyspark.sql import functions as F

from tidemark.llm import language, toxicity
from tidemark.llm.common import table
from tidemark.llm.queries import QUERIES, language_model


def test_language_is_the_smallest_whole_text(spark, sf):
    model = language_model(spark, sf)
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    found = {r.doc_id: (r.lang_pred, r.score) for r in QUERIES["op4_language_id"](spark, sf).collect()}
    assert len(found) == len(docs)
    for doc_id, text in docs:
        if not any(c.isalpha() for c in text or ""):
            assert found[doc_id] == ("und", 0.0)
            continue
        words = language.plain_words(text)
        sizes = []
        for lang in sorted(model):
            content = zstandard.ZstdCompressionDict(model[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            coder = zstandard.ZstdCompressor(
                level=language.LEVEL, dict_data=content, write_content_size=False, write_dict_id=False
            )
            size, at = 0, 0
            while at < len(words):
                size += len(coder.compress(words[at : at + language.PIECE]))
                at += language.PIECE
            sizes.append((size, lang))
        sizes.sort()
        assert found[doc_id] == (sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0])


def test_dictionaries_hold_passages_of_whole_distinct_texts(spark):
    word = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    long = " ".join(f"w{word(i)}" for i in range(30_000))
    rows = [(i, long, "aa") for i in range(400)] + [(1000, "short but different words", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    (content,) = language.learn(docs).values()
    assert b"short but different words" in content  # copies did not crowd it out
    assert 60_000 < len(content) <= language.DICTIONARY_BYTES
    passages = language.learn(docs.filter(F.col("doc_id") == 0))["aa"]
    assert passages.decode().split()[-2] in long[-2_000:]  # the end of the text is read too


def test_toxicity_is_the_sum_of_its_words(spark, sf):
    docs = table(spark, sf, "documents")
    chain = toxicity.learn_chain(docs, table(spark, sf, "labels"))
    found = {r.doc_id: r for r in toxicity.score_toxicity(docs, chain).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        earlier = []
        for name, weights, dense, bias in chain.links:
            total = bias + sum(w * p for w, p in zip(dense, earlier, strict=True))
            for word in set(toxicity.WORDS.findall((text or "").lower())):
                total += sum(weights.get(f, 0.0) for f in toxicity.features_of(word))
            earlier.append(1 / (1 + math.exp(-total)))
        got = found[doc_id].asDict()
        assert any(abs(v - earlier[-1]) < 1e-9 for v in got.values() if isinstance(v, float))
        assert bool(got["toxic"]) == (earlier[-1] >= toxicity.THRESHOLD)
