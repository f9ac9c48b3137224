"""SentencePiece encoding and decoding with a given vocabulary.

An Aho-Corasick automaton over the pieces reads a text once; at each position
its output links name all pieces that end there, and each relaxes the best
score of that position.  Spaces stand for the word mark of the vocabulary.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterable

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts_of

#: Where the public vocabularies lie; any SentencePiece model with byte pieces will do.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
WORD_MARK = "▁"
#: A byte piece counts less than any piece of the vocabulary.
BYTE_SCORE = -1e10
#: Encodings remembered by a worker, and the longest text unit remembered.
REMEMBERED, LONGEST = 600_000, 40

#: No piece has a space after another character or a line feed, so these units
#: can be scored apart without changing the best path of the whole text.
UNITS = re.compile(r"\n| *[^ \n]+| +")


class Vocabulary(dict):
    """Encodings of text units as packed 32-bit ids, computed on demand."""

    def __init__(self, model: bytes):
        super().__init__()
        source = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.automaton = ahocorasick.Automaton()
        self.bytes: list[bytes] = []
        self.byte_ids = [-1] * 256
        self.longest = 0
        single: set[str] = set()
        for i in range(source.get_piece_size()):
            piece = source.id_to_piece(i)
            text = piece.replace(WORD_MARK, " ")
            self.bytes.append(text.encode())
            if source.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_ids[value] = i
                self.bytes[i] = bytes([value])
            elif source.is_control(i) or source.is_unknown(i):
                self.bytes[i] = b""
            else:
                if "\n" in text or " " in text.lstrip(" "):
                    raise ValueError("a piece crosses a unit border")
                self.automaton.add_word(text, (len(text), source.get_score(i), i))
                if len(text) == 1:
                    single.add(text)
        if min(self.byte_ids) < 0:
            raise ValueError("the vocabulary has no byte pieces")
        self.automaton.make_automaton()
        self.single = single

    def viterbi(self, unit: str) -> list[int]:
        """Ids of the best-scored split of a unit."""
        n = len(unit)
        if self.single.issuperset(unit):
            return self._plain(unit, n)
        best = [0.0] * (n + 1)
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        ready = 0
        single = self.single
        for last, (length, score, piece) in self.automaton.iter(unit):
            end = last + 1
            while ready < end:
                ready += 1
                self._bytes_step(unit, ready, best, back, single)
            start = end - length
            total = best[start] + score
            if total > best[end]:
                best[end] = total
                back[end] = (start, piece)
        while ready < n:
            ready += 1
            self._bytes_step(unit, ready, best, back, single)
        ids: list[int] = []
        at = n
        while at:
            start, piece = back[at]
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(self.byte_ids[b] for b in reversed(unit[start:at].encode()))
            at = start
        ids.reverse()
        return ids

    def _plain(self, unit: str, n: int) -> list[int]:
        """The same where every character is a piece: no position needs bytes."""
        best = [0.0] + [-1e300] * n
        back: list = [None] * (n + 1)
        for last, match in self.automaton.iter(unit):
            total = best[last + 1 - match[0]] + match[1]
            if total > best[last + 1]:
                best[last + 1] = total
                back[last + 1] = match
        ids = []
        while n:
            length, _, piece = back[n]
            ids.append(piece)
            n -= length
        ids.reverse()
        return ids

    @staticmethod
    def _bytes_step(unit, at, best, back, single) -> None:
        """Open a position: reachable over the bytes of its last character."""
        width = len(unit[at - 1].encode()) if unit[at - 1] not in single else 8
        best[at] = best[at - 1] + BYTE_SCORE * width
        back[at] = (at - 1, -1)

    def __missing__(self, unit: str) -> bytes:
        ids = self.viterbi(unit)
        packed = struct.pack(f"{len(ids)}i", *ids)
        if len(unit) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[unit] = packed
        return packed

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text; a word mark is put before it, as is usual."""
        if not text:
            return np.zeros(0, dtype=np.int32)
        units = UNITS.findall(" " + text)
        return np.frombuffer(b"".join(map(self.__getitem__, units)), dtype=np.int32)

    def decode(self, ids: Iterable[int]) -> str:
        """The text behind ids; the inverse of ``encode`` for any text."""
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")[1:]


_LOADED: dict[bytes, Vocabulary] = {}


def vocabulary(model: bytes) -> Vocabulary:
    """The vocabulary of a model, made once per worker."""
    key = hashlib.sha256(model).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Vocabulary(model)
    return _LOADED[key]


def encode_decode(
    docs: DataFrame,
    model_path: str = MODEL_PATH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, ids, decoded, round_trip``.

    The model file is read by the driver and sent to the tasks.  A null or empty
    text has no ids and decodes to the empty text.  ``round_trip`` compares the
    decoded text with the given one (null as empty); characters outside the
    vocabulary, the word mark itself included, travel as bytes.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        words = vocabulary(model.value)
        for batch in batches:
            ids, decoded, same = [], [], []
            for text in texts_of(batch, 1):
                own = words.encode(text)
                back = words.decode(own.tolist())
                ids.append(own)
                decoded.append(back)
                same.append(back == (text or ""))
            counts = np.array([len(x) for x in ids], dtype=np.int64)
            offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
            values = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                    pa.array(decoded, pa.string()),
                    pa.array(same, pa.bool_()),
                ],
                ["doc_id", "n_tokens", "ids", "decoded", "round_trip"],
            )

    return rows.mapInArrow(
        run,
        f"doc_id {id_type}, n_tokens long, ids array<int>, decoded string, round_trip boolean",
    )
