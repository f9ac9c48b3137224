"""Golomb-Rice codes for sorted integer lists: unary quotients and fixed-width remainders."""

from __future__ import annotations

import numpy as np


def encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """Code a non-decreasing list of non-negative integers as gaps.

    Gives the remainder width, the unary part and the remainder part.  The
    width follows the mean gap, which keeps the unary part under three bits a
    value on average whatever the list holds.
    """
    values = np.asarray(values, dtype=np.int64)
    if not len(values):
        return 0, b"", b""
    gaps = np.diff(values, prepend=0)
    width = int(int(values[-1]) // len(values)).bit_length()
    quotients = gaps >> width
    stops = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(stops[-1]) + 1, dtype=np.uint8)
    unary[stops] = 1
    rest = gaps.astype("<i8").view(np.uint8).reshape(-1, 8)
    bits = np.unpackbits(rest, axis=1, count=width, bitorder="little")
    return width, np.packbits(unary).tobytes(), np.packbits(bits).tobytes()


def decode(count: int, width: int, unary: bytes, rest: bytes) -> np.ndarray:
    """The list that ``encode`` was given."""
    if not count:
        return np.zeros(0, dtype=np.int64)
    stops = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:count]
    gaps = (np.diff(stops, prepend=-1) - 1).astype(np.int64) << width
    if width:
        bits = np.unpackbits(np.frombuffer(rest, np.uint8), count=count * width)
        filled = np.zeros((count, 64), np.uint8)
        filled[:, :width] = bits.reshape(count, width)
        gaps += np.packbits(filled, axis=1, bitorder="little").view("<i8")[:, 0]
    return np.cumsum(gaps)
