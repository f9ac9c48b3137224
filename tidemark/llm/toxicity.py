"""Toxicity by a classifier chain of sparse linear models.

The categories are label columns in a given order.  Each has a logistic model
over hashed words and word beginnings; a later model also gets the
probabilities of the earlier categories.  For training these are out of fold:
a document's probability comes from a model that has not seen it.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts_of

#: Labelled documents used for training, on average; their texts are read whole.
TRAIN_DOCS = 4_000
#: Hashed features; lengths of word beginnings that are features beside the word.
DIMENSIONS = 1 << 20
BEGINNINGS = (3, 4)
#: Features of fewer documents are not learned.
LEAST_DOCS = 2
#: Features of a larger share of the documents are learned if their frequencies with
#: and without the label are at least so many standard errors apart.
COMMON_SHARE, APART = 0.1, 5
FOLDS = 3
#: Weight of the absolute-value penalty, and training steps.
PENALTY, STEPS = 0.001, 200
#: Probability from which a document is toxic; low, since the penalty shrinks all scores.
THRESHOLD = 0.2
#: Word scores a worker remembers.
REMEMBERED = 500_000

WORDS = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[int]:
    """Feature numbers of a word: itself and its beginnings."""
    keys = ["=" + word, *(word[:k] for k in BEGINNINGS if len(word) >= k)]
    return [zlib.crc32(k.encode("utf-8", "replace")) % DIMENSIONS for k in keys]


def words_of(text: str | None) -> set[str]:
    """The distinct words of a text, in lower case."""
    return set(WORDS.findall(text.lower())) if text else set()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(
    rows: list[np.ndarray], extra: np.ndarray, y: np.ndarray
) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights of features and of the dense ``extra`` columns, and the offset.

    Proximal gradient steps with momentum; the penalty on features sets most
    weights to zero, so that long texts do not add up noise.
    """
    n = len(rows)
    owner = np.repeat(np.arange(n), [len(r) for r in rows])
    used, at = np.unique(np.concatenate(rows), return_inverse=True)
    feature, doc = np.divmod(np.unique(at * n + owner), n)
    in_docs = np.bincount(feature, minlength=len(used))
    labelled, rate = np.bincount(feature, y[doc], minlength=len(used)), y.mean()
    error = np.sqrt(in_docs * (1 - in_docs / n) * rate * (1 - rate))
    telling = np.abs(labelled - in_docs * rate) > APART * error
    good = (in_docs >= LEAST_DOCS) & ((in_docs <= max(LEAST_DOCS, COMMON_SHARE * n)) | telling)
    owner, at, used = owner[good[at]], (np.cumsum(good) - 1)[at[good[at]]], used[good]
    lengths, k = np.bincount(owner, minlength=n), len(used)
    w, dense, bias = np.zeros(k), np.zeros(extra.shape[1]), 0.0
    ahead = (w, dense, bias)
    # each coordinate's curvature is bounded by a quarter of its products with row sums
    sums = lengths + np.abs(extra).sum(axis=1) + 1
    step = 4 * n / np.maximum(np.bincount(at, sums[owner], minlength=k), 1e-9)
    dense_step = 4 * n / np.maximum(np.abs(extra).T @ sums, 1e-9)
    bias_step = 4 * n / sums.sum()
    momentum = 1.0
    for _ in range(STEPS):
        aw, ad, ab = ahead
        score = np.bincount(owner, aw[at], minlength=n) + extra @ ad + ab
        error = (_sigmoid(score) - y) / n
        gw = np.bincount(at, error[owner], minlength=k)
        new = aw - step * gw
        new = np.sign(new) * np.maximum(np.abs(new) - step * PENALTY, 0)
        new_dense = ad - dense_step * (extra.T @ error)
        new_bias = ab - bias_step * error.sum()
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        push = (momentum - 1) / following
        ahead = (
            new + push * (new - w),
            new_dense + push * (new_dense - dense),
            new_bias + push * (new_bias - bias),
        )
        w, dense, bias, momentum = new, new_dense, new_bias, following
    weights = np.zeros(DIMENSIONS)
    weights[used] = w
    return weights, dense, float(bias)


def predict(model, rows: list[np.ndarray], extra: np.ndarray) -> np.ndarray:
    weights, dense, bias = model
    return _sigmoid(np.array([weights[r].sum() for r in rows]) + extra @ dense + bias)


@dataclass(frozen=True)
class Chain:
    """Per category its name, sparse feature weights, weights of earlier categories, offset."""

    links: tuple[tuple[str, dict[int, float], tuple[float, ...], float], ...]


def learn_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: tuple[str, ...] = ("quality", "toxic"),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Chain:
    """A chain learned from about ``TRAIN_DOCS`` labelled documents, chosen by a hash of the id.

    Labels are 0 or 1; rows with a null label, id or text are passed over, and
    of repeated labels one counts.  Texts are read whole, however long: the
    driver gets the distinct features of a text.  Repeated rows of a document
    each count; an empty table, like one without labelled rows, gives a chain
    whose probabilities are all one half.
    """
    known = labels.select(F.col("doc_id").alias("_id"), *categories).dropna()
    total = known.count()
    spot = F.pmod(F.xxhash64(F.col("_id").cast("string")), F.lit(1 << 30))
    known = known.filter(spot < int((1 << 30) * min(1.0, TRAIN_DOCS / max(1, total))))
    # about TRAIN_DOCS rows of a few numbers each
    known = F.broadcast(known.dropDuplicates(["_id"]))
    rows = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
    rows = rows.join(known, F.col("_doc") == F.col("_id")).filter("text is not null")
    rows = rows.select("_doc", *categories, "text")

    def run(batches):
        for batch in batches:
            found = [
                sorted(f for w in words_of(t) for f in features_of(w))
                for t in texts_of(batch, 1 + len(categories))
            ]
            arrays = [batch.column(i) for i in range(1 + len(categories))]
            arrays.append(pa.array(found, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, ["id", *categories, "features"])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"id {types['_doc']}, " + "".join(f"{c} {types[c]}, " for c in categories)
    sample = rows.mapInArrow(run, schema + "features array<int>").toPandas()
    sample = sample.sort_values("id", ignore_index=True)
    if sample.empty:
        return Chain(tuple((c, {}, (0.0,) * k, 0.0) for k, c in enumerate(categories)))
    features = [np.asarray(x, dtype=np.int64) for x in sample["features"]]
    fold = np.array([zlib.crc32(str(i).encode()) % FOLDS for i in sample["id"]])
    earlier = np.zeros((len(sample), 0))
    links = []
    for c in categories:
        y = sample[c].to_numpy(dtype=float)
        weights, dense, bias = fit_logistic(features, earlier, y)
        nonzero = np.flatnonzero(weights)
        sparse = dict(zip(nonzero.tolist(), weights[nonzero].tolist(), strict=True))
        links.append((c, sparse, tuple(dense.tolist()), bias))
        if c != categories[-1]:
            unseen = np.zeros(len(sample))
            for k in np.unique(fold):
                out, rest = np.flatnonzero(fold == k), np.flatnonzero(fold != k)
                if len(rest):
                    model = fit_logistic([features[i] for i in rest], earlier[rest], y[rest])
                    unseen[out] = predict(model, [features[i] for i in out], earlier[out])
            earlier = np.column_stack((earlier, unseen))
    return Chain(tuple(links))


class WordScores(dict):
    """Each word's score in every category of a chain, computed on demand."""

    def __init__(self, chain: Chain):
        super().__init__()
        self.weights = [sparse for _, sparse, _, _ in chain.links]

    def __missing__(self, word: str) -> tuple[float, ...]:
        found = features_of(word)
        score = tuple(sum(w.get(f, 0.0) for f in found) for w in self.weights)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = score
        return score


def probabilities(chain: Chain, scores: WordScores, text: str | None) -> list[float]:
    """Probabilities of the categories in chain order."""
    words = sorted(words_of(text))
    known = [s for s in map(scores.__getitem__, words) if any(s)]
    out: list[float] = []
    for k, (_, _, dense, bias) in enumerate(chain.links):
        total = sum(s[k] for s in known) + bias
        total += sum(w * p for w, p in zip(dense, out, strict=True))
        out.append(float(_sigmoid(np.float64(total))))
    return out


def score_toxicity(
    docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id``, ``p_<category>`` for each, and ``toxic``.

    ``toxic`` says whether the last category reaches ``THRESHOLD``; null and
    wordless texts have the offsets' probabilities and are never toxic.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = [f"p_{c}" for c, *_ in chain.links]
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        own = shared.value
        scores = WordScores(own)
        for batch in batches:
            found = [(probabilities(own, scores, t), bool(t)) for t in texts_of(batch, 1)]
            arrays = [batch.column(0)]
            arrays += [pa.array([p[k] for p, _ in found], pa.float64()) for k in range(len(names))]
            arrays.append(pa.array([p[-1] >= THRESHOLD and t for p, t in found], pa.bool_()))
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *names, "toxic"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    columns = "".join(f"{n} double, " for n in names)
    return rows.mapInArrow(run, f"doc_id {id_type}, {columns}toxic boolean")
