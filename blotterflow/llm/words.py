"""Words of many texts at once: where they lie, and 64-bit hashes of words and word runs.

Texts are taken as UTF-8 bytes. A word is a maximal run of word bytes within one
text; as every byte of a non-ASCII character is 0x80 or more, a class of ASCII
characters is a class of bytes. Hashes are polynomials modulo 2**64, mixed; equal
sequences have equal hashes wherever they stand.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from blotterflow.llm.batches import text_bytes

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Everything but the ASCII blanks 0x09-0x0D and 0x20.
NOT_BLANK = ~byte_class((0x09, 0x0D), (0x20, 0x20))
#: ASCII digits and letters, and everything beyond ASCII.
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: A-Z to a-z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20

_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            step = np.full(size, base, U64)
            step[0] = 1
            _powers[name] = np.multiply.accumulate(step)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(32))
    h = h * U64(0xD6E8FEB86659FD93)
    h = h ^ (h >> U64(29))
    h = h * U64(0xA0761D6478BD642F)
    return h ^ (h >> U64(32))


class Runs:
    """Hashes of runs of a sequence of 64-bit items."""

    def __init__(self, items: np.ndarray):
        self.up, self.down = powers(len(items) + 1)
        self.sums = np.zeros(len(items) + 1, U64)
        np.cumsum(items * self.up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The hash of items ``start`` to ``end`` (not included)."""
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, k: int) -> np.ndarray:
        """The hash of every run of ``k`` items, by its start."""
        n = max(len(self.sums) - k, 0)
        return mix((self.sums[k : k + n] - self.sums[:n]) * self.down[:n])


@dataclass
class Words:
    """Words of the texts of one column, in order.

    ``data``: all bytes; ``start``, ``end``: of each word; ``first``: the number of
    the first word of each text, and at last the number of words.
    """

    data: np.ndarray
    texts: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The number of each word's text."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def last(self) -> np.ndarray:
        """For each word, the number behind the last word of its text."""
        return np.repeat(self.first[1:], self.counts)

    def hashes(self) -> np.ndarray:
        return Runs(self.data.astype(U64) + U64(1)).of(self.start, self.end)

    def strings(self, text: int) -> list[bytes]:
        low, high = self.first[text], self.first[text + 1]
        if low == high:
            return []
        begin = self.start[low]
        data = self.data[begin : self.end[high - 1]].tobytes()
        spans = zip((self.start[low:high] - begin).tolist(), (self.end[low:high] - begin).tolist(), strict=True)
        return [data[a:b] for a, b in spans]


def split_words(column: pa.Array, word: np.ndarray = NOT_BLANK, fold: np.ndarray | None = None) -> Words:
    data, texts = text_bytes(column)
    if fold is not None:
        data = fold[data]
    inside = word[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[texts] = True
    before, after = np.zeros_like(inside), np.zeros_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    start = np.flatnonzero(inside & (~before | cut[:-1]))
    end = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return Words(data, texts, start, end, np.searchsorted(start, texts))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Where the least of every ``width`` neighbours stands; the last of equals."""
    place = np.arange(len(values))
    have = 1
    while have < width and len(values):
        step = min(have, width - have)
        right = values[step:] <= values[:-step] if step < len(values) else np.zeros(0, bool)
        n = len(right)
        place = np.where(right, place[step : step + n], place[:n])
        values = np.where(right, values[step : step + n], values[:n])
        have += step
    return place


def covered(n: int, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Which of ``n`` places lie in a span."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + length, -1)
    return np.cumsum(change[:-1]) > 0
