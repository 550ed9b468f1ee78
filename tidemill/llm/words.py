"""Words of many texts at once, by numpy over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tidemill.llm.common import mix64

PIECE = 2 << 20  # bytes of text that are split at once, unless a single text has more
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Which of the 256 bytes lie in the ranges given, ends included."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


# White space is space, tab, line feed, vertical tab, form feed and carriage return.
SPACED = ~byte_set((0x20, 0x20), (0x09, 0x0D))
# Letters and digits of ASCII, and everything beyond ASCII.
TERMS = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


@dataclass
class Words:
    """``text`` has the place of each word's text, ``hash`` a 64-bit hash of its bytes with
    A-Z in lower case; words stand in order."""

    text: np.ndarray
    hash: np.ndarray


class Splitter:
    """Splits texts into maximal runs of the bytes given, of which space is none. Words are
    known by their hashes: two of n different words share one with probability n * n / 2**65."""

    def __init__(self, inside: np.ndarray) -> None:
        self.code = np.arange(1, 257, dtype=np.uint64)
        self.code[0x41:0x5B] = self.code[0x61:0x7B]
        self.code[~inside] = 0
        self.inside = inside
        self.power = np.ones(1, np.uint64)

    def __call__(self, texts: list[bytes]) -> Words:
        data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        edge = np.diff(np.concatenate([[False], self.inside[data], [False]]).astype(np.int8))
        starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            return Words(np.zeros(0, np.int64), np.zeros(0, np.uint64))
        length = stops - starts
        longest = int(length.max())
        if longest >= len(self.power):
            self.power = np.full(2 * longest, _BASE)
            self.power[0] = 1
            self.power = np.cumprod(self.power)
        # The bytes between words have code 0, so any power may stand there.
        place = np.arange(starts[0], len(data)) - np.repeat(starts, np.diff(np.append(starts, len(data))))
        code = self.code[data[starts[0] :]]
        code *= self.power[np.minimum(place, longest)]
        total = np.add.reduceat(code, starts - starts[0])
        return Words(np.searchsorted(ends, starts, "right"), mix64(total + length.astype(np.uint64)))


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, list[bytes]]]:
    """Texts of a column, null as empty, with the place of the first: about ``size`` bytes
    at a time."""
    texts, at, total = [], 0, 0
    for i, text in enumerate(column.cast(pa.binary()).to_pylist()):
        if texts and total + len(text or b"") > size:
            yield at, texts
            texts, at, total = [], i, 0
        texts.append(text or b"")
        total += len(texts[-1])
    if texts:
        yield at, texts
