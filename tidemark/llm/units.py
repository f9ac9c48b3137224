"""Text units that tokenizers can encode one by one, and the same ids come out."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import filterfalse

import numpy as np
import tiktoken

#: Where the public vocabularies lie.
BYTE_BPE_PATH = "/opt/tokenizers/byte_bpe_50k.json"
#: Longer texts are handled in slices of about so many characters.
SLICE_CHARS = 1 << 20
#: Units remembered by a worker, and their characters in all.
REMEMBERED, REMEMBERED_CHARS = 600_000, 16 << 20

# Fixed value: the pattern that cuts a text before byte-level merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters on whose kinds all versions of Unicode agree.
LATIN = re.compile(r"[\x00-\u024F]*")

#: A unit ends before a space that follows a visible character.  Byte-level BPE
#: splits there, whatever comes before and after; so does a piece vocabulary
#: without a piece that has a space after another character.
UNIT = re.compile(r".[^ ]*(?:(?<=[\s᠎]) [^ ]*)*", re.DOTALL)
_BORDER = re.compile(r"(?<=[^\s᠎]) ")


def slices(text: str) -> Iterator[str]:
    """The text in parts that end where a unit ends."""
    at = 0
    while len(text) - at > SLICE_CHARS:
        border = _BORDER.search(text, at + SLICE_CHARS)
        if border is None:
            break
        yield text[at : border.start()]
        at = border.start()
    if at < len(text):
        yield text[at:] if at else text


def _parts(texts: Iterable[str | None]) -> Iterator[tuple[str, bool]]:
    for text in texts:
        last = ""
        for n, part in enumerate(slices(text or "")):
            if n:
                yield last, False
            last = part
        yield last, True


def known_units(
    texts: Iterable[str | None], memory: UnitMemory
) -> Iterator[tuple[list[str], bool]]:
    """The units of every text, all known to ``memory`` when they come.

    A long text comes as several lists; the flag tells the last one of a text.
    Null counts as empty.
    """
    group: list[tuple[list[str], bool]] = []
    distinct: set[str] = set()
    size = 0
    for part, last in _parts(texts):
        units = UNIT.findall(part)
        group.append((units, last))
        distinct.update(units)
        size += len(part)
        if size > SLICE_CHARS // 2:
            memory.know(distinct)
            yield from group
            group, distinct, size = [], set(), 0
    memory.know(distinct)
    yield from group


def _byte_values() -> dict[str, int]:
    """Byte-level BPE shows every byte as one character: printable ones as themselves."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """Units by a byte-level BPE vocabulary, given as the text of its ``tokenizers`` file.

    The ids are those of ``tokenizers``.  Units of Latin letters, marks and
    digits are encoded by ``tiktoken`` from the ranks of the same file, which
    gives the same ids in a third of the time; others, those that hold a special
    token, and vocabularies whose ids do not follow their merges go to
    ``tokenizers``.
    """

    def __init__(self, data: str, special_as_text: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data)
        self.tokenizer.encode_special_tokens = special_as_text
        special = self.tokenizer.get_added_tokens_decoder()
        values = _byte_values()
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            if i not in special:
                self.bytes[i] = bytes(map(values.__getitem__, token))
        ranks = {token: i for i, token in enumerate(self.bytes) if token}
        for i, token in special.items():
            self.bytes[i] = token.content.encode()
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)
        self.marks = () if special_as_text else tuple(t.content for t in special.values())
        model = json.loads(data)["model"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        order = [model["vocab"][a + b] for a, b in pairs]
        self.quick = None
        if order == sorted(order):
            self.quick = tiktoken.Encoding(
                "units", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
            )

    def encode(self, units: list[str]) -> list[np.ndarray]:
        """Ids of every unit.

        Units that begin with a space and end visibly are encoded as one text
        and cut again by the sizes of its tokens.
        """
        found: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(units)
        joined, single = [], []
        everything = "".join(units)
        marks = [m for m in self.marks if m in everything]
        for k, unit in enumerate(units):
            quick = self.quick is not None and (unit.isascii() or LATIN.fullmatch(unit) is not None)
            if marks and any(m in unit for m in marks):
                quick = False
            if quick and unit[0] == " " and not unit[-1].isspace():
                joined.append(k)
            elif quick:
                found[k] = np.array(self.quick.encode_ordinary(unit), np.uint32)
            else:
                single.append(k)
        rest = [units[k] for k in single]
        codes = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        for k, code in zip(single, codes, strict=True):
            found[k] = np.array(code.ids, np.uint32)
        if joined:
            own = [units[k] for k in joined]
            ids = np.array(self.quick.encode_ordinary("".join(own)), np.uint32)
            ends = np.cumsum(self.sizes[ids])
            want = np.cumsum([len(u.encode()) for u in own])
            cuts = np.searchsorted(ends, want)
            if not np.array_equal(ends[np.minimum(cuts, len(ends) - 1)], want):
                raise ArithmeticError("a token crosses a unit border")
            begin = 0
            for k, end in zip(joined, (cuts + 1).tolist(), strict=True):
                found[k] = ids[begin:end]
                begin = end
        return found


class UnitMemory(dict):
    """What a worker knows of units; ``learn`` is given the unknown ones together."""

    def __init__(self, learn):
        super().__init__()
        self.learn, self.chars = learn, 0

    def know(self, units: set[str]) -> None:
        """After this, every one of ``units`` is a key."""
        new = list(filterfalse(self.__contains__, units))
        if not new:
            return
        if len(self) + len(new) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self.clear()
            self.chars, new = 0, list(units)
        self.chars += sum(map(len, new))
        self.learn(self, new)
