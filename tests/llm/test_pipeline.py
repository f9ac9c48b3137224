"""Stages of the pipeline on awkward rows, and the whole against each stage's own check."""

import corpus_pipeline
import pytest

from tidemark.llm import decontaminate, exact, language, simhash
from tidemark.llm.common import staged, table
from tidemark.llm.queries import language_model


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_takes_awkward_rows(spark, sf, clashing, no_docs, name, stage):
    out = stage(spark, clashing, sf)
    if name != corpus_pipeline.STAGES[-1][0]:
        assert out.columns == clashing.columns
    assert out.count() > 0
    assert stage(spark, no_docs, sf).count() == 0


def test_pipeline_keeps_what_each_operator_keeps(spark, sf):
    docs = table(spark, sf, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    classify = language.classifier(language_model(spark, sf))
    left = {
        i for i, t in texts.items() if (p := classify(t))[0] != "und" and p[1] >= language.MIN_MARGIN
    }
    last = {}
    for i in sorted(left):
        last[texts[i]] = i
    left = set(last.values())
    prints = {i: simhash.fingerprint(texts[i]) for i in sorted(left)}
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if root[b] < root[a] and (prints[a] ^ prints[b]).bit_count() <= simhash.RADIUS:
                    root[a], changed = root[b], True
    left = {i for i in left if root[i] == i}
    items = [(str(r.item_id), r.text) for r in table(spark, sf, "benchmark").collect()]
    tables = decontaminate.matchers(items)

    def clean(text):
        words = decontaminate.words_of(text)
        hit = {p for m in tables for s, e, _ in m.find(words) for p in range(s, e)}
        return not (hit and 20 * len(hit) >= len(words))

    left = {i for i in left if clean(texts[i])}
    got = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in got} == left and len(got) == len(left)
    assert all(r.round_trip for r in got)
    assert len(left) < len(texts)


def test_exact_stage_keeps_the_largest_id(spark, sf):
    docs = table(spark, sf, "documents")
    kept = staged(exact.drop_duplicates(docs), "test-kept")
    want = {}
    for r in docs.collect():
        want[r.text] = max(r.doc_id, want.get(r.text, r.doc_id))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want.values())
