"""Language identification by compression.

Each language is a raw-content zstandard dictionary made of labelled text.  A
text belongs to the language whose dictionary makes it smallest.  Only words
in lower case are compressed: figures, marks and capitals say nothing about the
language and would drown it.  Texts are compressed in pieces, each against the fresh dictionary, so that a long text
cannot outgrow what the dictionary knows; all pieces count.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts_of

#: Bytes of one language's dictionary.
DICTIONARY_BYTES = 110_000
#: Sampled texts of one language, on average, and characters taken from all of them.
SAMPLE_DOCS, SAMPLE_CHARS = 320, 131_072
#: Characters of a passage; the passages of a text are spread over the whole of it.
PASSAGE = 512
#: Languages that may be learned; more is an error, since the driver builds the dictionaries.
MAX_LANGUAGES = 256
#: Bytes compressed at once.
PIECE = 4_096
#: Narrower margins are rejected by ``keep_identified``.
MIN_MARGIN = 0.002

LEVEL = 6

UNDETERMINED = "und"
WORDS = re.compile(r"[^\W\d_]+")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def plain_words(text: str) -> bytes:
    """The words of a text in lower case, one space between, as UTF-8."""
    return " ".join(WORDS.findall(text.lower())).encode("utf-8", "replace")


def learn(
    labelled: DataFrame, lang_col: str = "lang", text_col: str = "text"
) -> dict[str, bytes]:
    """Dictionaries by language from a bounded sample of the texts of ``labelled``.

    Rows without language or text are passed over, and equal texts count once.
    The sample is fixed by a hash of the text and holds about ``SAMPLE_DOCS``
    texts of each language; few texts give more of themselves than many do, in
    passages spread over the whole text, long or short.  A dictionary has at
    most ``DICTIONARY_BYTES`` bytes.
    """
    rows = labelled.select(
        F.col(lang_col).alias("lang"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.col(text_col)).alias("h"),
    ).filter("lang is not null and text is not null")
    # about how many texts there are: it sets the size of the sample only
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).limit(MAX_LANGUAGES + 1)
    counts = {r["lang"]: r["n"] for r in sizes.collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    if not counts:
        return {}
    share, passages = F.lit(0.0), F.lit(1)
    for lang, n in counts.items():
        mine = F.col("lang") == lang
        share = F.when(mine, min(1.0, SAMPLE_DOCS / n)).otherwise(share)
        each = -(-SAMPLE_CHARS // (min(n, SAMPLE_DOCS) * PASSAGE))
        passages = F.when(mine, each).otherwise(passages)
    spot = F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30))
    size = F.length("text")
    k = F.greatest(F.least(F.ceil(size / PASSAGE), passages), F.lit(1)).cast("int")
    spread = F.transform(
        F.sequence(F.lit(0), k - 1),
        lambda i: F.substr(F.col("text"), F.floor(i * size / k).cast("int") + 1, F.lit(PASSAGE)),
    )
    sample = rows.filter(spot < share).select("lang", "h", F.array_join(spread, " ").alias("text"))
    sample = sample.dropDuplicates(["lang", "h", "text"])
    texts: dict[str, dict[bytes, None]] = {lang: {} for lang in counts}
    for lang, _, text in sorted(map(tuple, sample.collect())):
        texts[lang][plain_words(text)] = None
    return {k: b"\n".join(v)[-DICTIONARY_BYTES:] for k, v in texts.items()}


def classifier(model: dict[str, bytes]) -> Callable[[str | None], tuple[str, float]]:
    """A function from a text to its language and the margin of the decision, 0 to 1."""
    langs = sorted(k for k, v in model.items() if v)
    encoders = []
    for lang in langs:
        content = zstandard.ZstdCompressionDict(
            model[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        content.precompute_compress(level=LEVEL)
        encoders.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=content, write_content_size=False, write_dict_id=False
            ).compress
        )

    def classify(text: str | None) -> tuple[str, float]:
        if not text or not langs or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        data = plain_words(text)
        pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
        sizes = [sum(len(encode(x)) for x in pieces) for encode in encoders]
        ranked = sorted(zip(sizes, langs, strict=True))
        best = ranked[0]
        margin = (ranked[1][0] - best[0]) / ranked[1][0] if len(ranked) > 1 else 1.0
        return best[1], margin

    return classify


def identify(
    docs: DataFrame, model: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    Only the text decides.  ``und`` with score 0 stands for a null text, a text
    without a letter, and any text when nothing was learned.  The score is the
    share of bytes that the best language saves over the second.  Of equal
    sizes the first language by name wins.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("t")
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        classify = classifier(model)
        for batch in batches:
            pairs = [classify(t) for t in texts_of(batch, 2)]
            langs = pa.array([x[0] for x in pairs], pa.string())
            scores = pa.array([x[1] for x in pairs], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), langs, scores],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return rows.mapInArrow(
        run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double"
    )


def keep_identified(
    docs: DataFrame,
    model: dict[str, bytes],
    text_col: str = "text",
    min_margin: float = MIN_MARGIN,
) -> DataFrame:
    """The documents whose language is clear, with all their columns.

    Rejected are texts that are null or without a letter, and texts whose best
    language saves less than ``min_margin`` over the second.
    """
    at = docs.columns.index(text_col)

    def run(batches):
        classify = classifier(model)
        for batch in batches:
            pairs = (classify(t) for t in texts_of(batch, at))
            clear = [lang != UNDETERMINED and margin >= min_margin for lang, margin in pairs]
            yield batch.filter(pa.array(clear, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
