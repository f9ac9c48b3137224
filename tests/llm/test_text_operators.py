import itertools
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, decontaminate, language, licenses, pieces, toxicity, webtext
from tidemark.llm.common import table
from tidemark.llm.queries import language_model

LONG = "the quick brown fox jumps over the lazy dog and runs to the hills " * 4000
IDS = [1, 2, 2, 3, 4, 5, 6, 7, 8, 9, None, None, 10]


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda x: (x is None, x))


ALL = sorted(IDS, key=lambda x: (x is None, x))


# -- language ---------------------------------------------------------------------


def test_language_accuracy_on_held_out(spark, sf):
    docs = table(spark, sf, "documents")
    found = language.identify(docs, language_model(spark, sf)).join(
        docs.select("doc_id", "lang"), "doc_id"
    )
    held = found.filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in held) > 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_language_of_awkward_rows(awkward, clashing, no_docs):
    model = language.learn(awkward.filter("text is not null"))
    assert set(model) == {"en", "fr", "de"}
    found = language.identify(clashing, model)
    assert ids(found) == ALL
    for r in found.collect():
        if r.doc_id in (3, 4, 5, 6):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        if r.doc_id in (1, 7, 8):
            assert r.lang_pred == "en"
    kept = language.keep_identified(clashing, model)
    assert kept.columns == clashing.columns
    assert not set(ids(kept)) & {3, 4, 5, 6}
    assert language.learn(no_docs) == {}
    assert language.identify(no_docs, {}).count() == 0
    assert {r.lang_pred for r in language.identify(awkward, {}).collect()} == {"und"}


# -- contamination ----------------------------------------------------------------


def plain_hits(words, items, size=13):
    hit, found = set(), set()
    for item, own in items:
        k = min(size, len(own))
        grams = {tuple(own[s : s + k]) for s in range(len(own) - k + 1)} if k else set()
        for s in range(len(words) - k + 1):
            if tuple(words[s : s + k]) in grams:
                hit.update(range(s, s + k))
                found.add(item)
    return hit, found


@pytest.mark.parametrize("seed", range(6))
def test_wu_manber_finds_all(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "b", "c"])
    texts = [(str(i), " ".join(word() for _ in range(r.randint(0, 30)))) for i in range(8)]
    doc = " ".join([word() for _ in range(200)] + [t for _, t in texts] + ["a"] * 20)
    words = decontaminate.words_of(doc)
    hit, found = plain_hits(words, [(i, decontaminate.words_of(t)) for i, t in texts])
    got = [x for m in decontaminate.matchers(texts) for x in m.find(words)]
    assert {p for s, e, _ in got for p in range(s, e)} == hit
    assert {i for _, _, i in got} == found


def test_equal_windows_are_stored_once():
    """A preamble that all items share, and an item of one word over and over."""
    preamble = " ".join(f"p{i}" for i in range(40))
    items = [(str(i), f"{preamble} own{i}") for i in range(300)] + [("again", "word " * 500)]
    (m,) = decontaminate.matchers(items)
    held = [w for same in m.ends.values() for windows in same.values() for w, _ in windows]
    assert len(held) == len(set(map(tuple, held))) == 28 + 300 + 1
    words = decontaminate.words_of(f"x {preamble} y " + "word " * 60)
    got = list(m.hits(words))
    assert len(got) == 28 + 48
    hit, found = plain_hits(words, [(i, decontaminate.words_of(t)) for i, t in items])
    assert {p for s, e, _ in got for p in range(s, e)} == hit
    assert set().union(*(own for _, _, own in got)) == found == {i for i, _ in items}


def test_contamination_in_several_passes(spark, sf, monkeypatch):
    docs, items = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    once = decontaminate.find_contamination(docs, items).collect()
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 2500)
    several = decontaminate.find_contamination(docs, items).collect()
    assert sorted(map(str, once)) == sorted(map(str, several))
    clean = {r.doc_id for r in once if not r.contaminated}
    assert set(ids(decontaminate.drop_contaminated(docs, items))) == clean
    assert 0 < len(clean) < len(once)


def test_one_portion_of_the_benchmark_is_shared_at_a_time(spark, sf, monkeypatch):
    """Also in the stage that drops; a document that each portion hits a little goes."""
    sc, live, most = type(spark.sparkContext), [], []
    share = sc.broadcast

    def counted(self, value):
        out = share(self, value)
        live.append(value)
        most.append(len(live))
        end = out.destroy
        out.destroy = lambda *a: (live.pop(), end(*a))
        return out

    monkeypatch.setattr(sc, "broadcast", counted)
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 20)
    items = [(i, f"w{i}a w{i}b") for i in range(12)]
    text = " ".join(f"w{i}a w{i}b" + " x" * 30 for i in range(12))
    docs = spark.createDataFrame([(1, text), (2, text + " x" * 300)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert ids(decontaminate.drop_contaminated(docs, bench)) == [2]
    assert len(most) > 3 and max(most) == 1
    live.clear(), most.clear()
    found = {r.doc_id: r for r in decontaminate.find_contamination(docs, bench).collect()}
    assert (found[1].n_hit, found[1].contaminated, found[2].contaminated) == (24, True, False)
    assert len(most) > 3 and max(most) == 1


def test_contamination_of_awkward_rows(spark, awkward, clashing, no_docs):
    bench = "item_id long, text string"
    items = [(1, "one"), (2, None), (3, ""), (None, "zeta eta"), (1, "one"), (4, "alpha gamma")]
    items = spark.createDataFrame(items, bench)
    found = decontaminate.find_contamination(awkward, items)
    assert ids(found) == ALL
    by_id = {r.doc_id: r for r in found.collect()}
    assert (by_id[9].n_hit, by_id[9].items, by_id[9].contaminated) == (1, ["1"], True)
    assert (by_id[1].n_hit, by_id[1].items) == (2, [""])
    assert (by_id[3].n_words, by_id[3].contaminated) == (0, False)
    none = spark.createDataFrame([], bench)
    assert decontaminate.find_contamination(awkward, none).filter("n_hit > 0").count() == 0
    assert decontaminate.find_contamination(no_docs, items).count() == 0
    kept = decontaminate.drop_contaminated(clashing, items)
    assert kept.columns == clashing.columns and 9 not in ids(kept)


# -- pieces -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    with open(pieces.MODEL_PATH, "rb") as f:
        return pieces.vocabulary(f.read())


def plain_best(words, text):
    """Best score by comparing all piece ends at every position."""
    scores = {k: words.automaton.get(k)[1] for k in words.automaton.keys()}
    best = [0.0]
    for e in range(1, len(text) + 1):
        ways = [best[s] + scores[text[s:e]] for s in range(max(0, e - 16), e) if text[s:e] in scores]
        if text[e - 1] not in words.single:
            ways.append(best[e - 1] + pieces.BYTE_SCORE * len(text[e - 1].encode()))
        best.append(max(ways))
    return best[-1]


@pytest.mark.parametrize(
    "text", ["Hello  wide\n\n world ", "éçanpa öät", "日本x語 🎉▁▁", "a" * 70, " \r\n\t x", "{}\r\n};\r"]
)
def test_viterbi_is_best_and_reversible(vocabulary, text):
    got = vocabulary.encode(text).tolist()
    assert vocabulary.decode(got) == text
    scores = {k: vocabulary.automaton.get(k)[1] for k in vocabulary.automaton.keys()}
    total = 0.0
    for i in got:
        is_byte = i in vocabulary.byte_ids
        total += pieces.BYTE_SCORE if is_byte else scores[vocabulary.bytes[i].decode()]
    assert total == pytest.approx(plain_best(vocabulary, " " + text))


def test_pieces_of_awkward_rows(clashing, no_docs):
    found = pieces.encode_decode(clashing)
    assert ids(found) == ALL
    for r in found.collect():
        assert r.round_trip and r.n_tokens == len(r.ids)
        assert (r.n_tokens == 0) == (r.decoded == "")
    assert pieces.encode_decode(no_docs).count() == 0


# -- toxicity ---------------------------------------------------------------------


def test_toxicity_on_unseen_labels(spark, sf):
    sf = os.path.join(os.path.dirname(sf), "sf0.1")  # enough labels to learn from
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    seen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    chain = toxicity.learn_chain(docs, labels.filter(seen))
    assert [c for c, *_ in chain.links] == ["quality", "toxic"]
    assert len(chain.links[1][2]) == 1
    rest = labels.filter(~seen).select("doc_id", F.col("toxic").alias("t"))
    found = toxicity.score_toxicity(docs, chain).join(rest, "doc_id").collect()
    wrong = [r for r in found if not r.t and r.toxic]
    assert sum(r.t and r.toxic for r in found) >= 0.9 * sum(r.t for r in found)
    assert len(wrong) <= 0.01 * len(found)


def test_toxicity_of_awkward_rows(spark, awkward, clashing, no_docs):
    labels = "doc_id long, quality int, toxic int"
    none = toxicity.learn_chain(awkward, spark.createDataFrame([], labels))
    assert {r.p_toxic for r in toxicity.score_toxicity(clashing, none).collect()} == {0.5}
    few = spark.createDataFrame([(1, 1, 1), (9, 1, 0), (3, 1, 0), (7, None, 1), (1, 1, 1)], labels)
    found = toxicity.score_toxicity(clashing, toxicity.learn_chain(awkward, few))
    assert ids(found) == ALL
    assert not any(r.toxic for r in found.collect() if r.doc_id in (3, 4))
    assert toxicity.score_toxicity(no_docs, none).count() == 0


def test_toxicity_of_a_large_toxic_group():
    """A word of a third of all rows, all of them toxic, is learned; one of all labels is not."""
    r = random.Random(5)
    texts, y = [], []
    for i in range(600):
        words = {f"{r.choice('bcdfg')}{r.choice('aeiou')}{r.randrange(400)}x" for _ in range(30)}
        words = {"".join(chr(97 + int(c)) if c.isdigit() else c for c in w) for w in words}
        texts.append(words | ({"slur"} if i % 3 == 0 else set()) | ({"often"} if i % 2 else set()))
        y.append(float(i % 3 == 0))
    rows = [np.array(sorted(f for w in t for f in toxicity.features_of(w))) for t in texts]
    none = np.zeros((len(rows), 0))
    model = toxicity.fit_logistic(rows, none, np.array(y))
    weights = model[0]
    assert sum(weights[f] for f in toxicity.features_of("slur")) > 1
    assert not any(weights[f] for f in toxicity.features_of("often"))
    toxic = toxicity.predict(model, rows, none) >= toxicity.THRESHOLD
    assert toxic.tolist() == [v == 1 for v in y]


# -- licenses ---------------------------------------------------------------------


def test_license_notices(spark, awkward, clashing, no_docs):
    filler = " ".join(f"word{i}" for i in range(3000))
    grant = licenses.TEMPLATES["MIT-grant"]
    rows = [(100 + i, f"{filler} {t} {filler}") for i, t in enumerate(licenses.TEMPLATES.values())]
    rows += [(200, "released UNDER  the (mit) license"), (201, "released under the MIT"), (202, grant[:60])]
    rows.append((203, filler + " " + grant.replace("software", "program", 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.licenses.split(",") for r in licenses.scan_licenses(docs).collect()}
    for i, name in enumerate(licenses.TEMPLATES):
        assert name in found[100 + i]
    assert found[200] == ["MIT"] and found[201] == [""] == found[202]
    assert found[203] == ["MIT-grant"]
    assert licenses.scan_licenses(no_docs).count() == 0
    few = {"MIT": licenses.TEMPLATES["MIT"], "empty": " "}
    assert licenses.scan_licenses(awkward, {}).filter("n_licenses = 0").count() == len(ALL)
    clashing = licenses.scan_licenses(clashing, few).collect()
    assert len(clashing) == len(ALL) and not any(r.n_licenses for r in clashing)


def test_native_operators_run_no_python(spark, sf):
    plans = [
        licenses.scan_licenses(table(spark, sf, "documents")),
        chat.read_back(chat.format_windows(table(spark, sf, "conversations"))),
    ]
    for df in plans:
        assert "Python" not in (plan := df._jdf.queryExecution().toString())
        assert "InPandas" not in plan and "Arrow" not in plan


# -- chat -------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, conv int, window int"


def test_chat_windows(spark):
    talk = [(1, 0, "system", "be kind", 0, 0)]
    talk += [(1, i, ("user", "assistant")[i % 2 == 0], f"word {i} " * 60, 0, 0) for i in range(1, 30)]
    talk += [(2, 0, "system", "alone", 0, 0), (3, 5, None, None, 0, 0), (3, None, "a:b", "x", 0, 0)]
    talk += [(4, 1, "user", "long " * 3000, 0, 0), (4, 2, "assistant", r"\### <b>:\l", 0, 0)]
    talk += [(None, 1, "assistant", "n", 0, 0), (4, 2, "assistant", r"\### <b>:\l", 0, 0)]
    frame = spark.createDataFrame(talk, TURNS)
    windows = chat.format_windows(frame, budget=600, history=150)
    back = chat.read_back(windows).orderBy("conv_id", "window").collect()
    order = lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or "")
    for conv in (1, 2, 3, 4, None):
        own = sorted((t for t in talk if t[0] == conv), key=order)
        new = [tuple(t) for r in back if r.conv_id == conv for t in r.new_turns]
        assert new == [(t[2] or "", t[3] or "") for t in own]
        targets = [t for r in back if r.conv_id == conv for t in r.targets]
        assert targets == [t[3] for t in own if t[2] == "assistant"]
    first = [r for r in windows.orderBy("window").collect() if r.conv_id == 1]
    assert len(first) > 3
    for n, r in enumerate(first):
        assert r.text.startswith("### system: be kind </turn>\n")
        assert r.tokens <= 600
        assert (r.repeated > 1) == (n > 0)
    assert chat.format_windows(frame.limit(0)).count() == 0


def test_one_conversation_in_many_chunks(spark):
    turns = spark.range(5000).selectExpr(
        "cast(1 AS long) AS conv_id", "id * 3 AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role",
        "concat('turn ', id, ' says ', repeat('so ', cast(id % 40 AS int))) AS text",
    )
    back = chat.read_back(chat.format_windows(turns)).orderBy("window").collect()
    texts = list(itertools.chain.from_iterable((t.text for t in r.new_turns) for r in back))
    assert [int(t.split()[1]) for t in texts] == list(range(5000))
    assert max(r.turns for r in chat.format_windows(turns).collect()) < 1024


# -- pages ------------------------------------------------------------------------

GOOD = "The cat sat on the mat and it was good for all of us to see that it is so. " * 4


@pytest.mark.parametrize(
    "html,text",
    [
        (None, ""),
        ("", ""),
        ("<p", ""),
        ("plain  text", "plain text"),
        ("<script>x='<p>no'</script>", ""),
        ("<article><h1>T</h1><p>a &lt; b &amp;amp; c&nbsp;d<br>e<p>f</article>", "T\na < b &amp; c d e\nf"),
        ("<nav><a href=x>Home</a></nav><article><p>x</p><form><p>q</p></form></article><footer>f</footer>", "x"),
        (f"<div class=menu><a href=x>Home</a></div><p>{GOOD}<p>Short.<p>{GOOD}", f"{GOOD.strip()}\nShort.\n{GOOD.strip()}"),
        (f"<main><p>{GOOD}</main><div id='comments'><p>{GOOD}</div>", GOOD.strip()),
        ("<article><p>one<!-- hidden <p>two --></p><div class='ad box'>buy</div><p>three", "one\nthree"),
        ("<article><p>cut <b>here</b> and <a hre", "cut here and"),
        ("<article><p>a<p class='share-price'>b<section class='related-work'><p>c</section></article>", "a\nb\nc"),
        ("<article><p>a</p><blockquote class='quote-banner'>b</blockquote><div class='share-links'>c</div>", "a\nb"),
        (f"<nav><a href=x>Home</a><ul><li>More<article><p>{GOOD}</p></article>", GOOD.strip()),
        (f"<article><p>Teaser.</p></article><p>{GOOD}</p><p>{GOOD}</p>", f"Teaser.\n{GOOD.strip()}\n{GOOD.strip()}"),
    ],
)
def test_main_text(html, text):
    assert webtext.main_text(html) == text


def test_pages(spark, sf):
    pages = spark.createDataFrame(
        [(1, "u", None, 1), (1, "u", None, 1), (None, None, "<article>" + "<p>x</p>" * 50_000, 2)],
        "page_id long, url string, html string, text int",
    )
    found = webtext.extract_main_text(pages).collect()
    assert sorted(r.n_chars for r in found) == [0, 0, 99_999]
    given = table(spark, sf, "pages")
    assert webtext.extract_main_text(given).filter("n_chars > 0").count() > 0.9 * given.count()
    assert webtext.extract_main_text(given.limit(0)).count() == 0
