"""A hierarchical index of 64-bit fingerprints in Gray order, and its self-join.

Values of a group stand in Gray order, so neighbours differ in few bits. Every
``FANOUT`` neighbours form a leaf, every ``FANOUT`` leaves a node, and so on up to one
root for each group. A node keeps the bits all values under it share, less those its
parent keeps already. A search carries the number of differing bits met so far from
node to node, and leaves out the whole node when it exceeds the limit. All groups of a
page and a block of queries go down level by level together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from blotterflow.llm.components import join_roots

U64 = np.uint64
FANOUT = 8
QUERIES = 1024


def gray_rank(values: np.ndarray) -> np.ndarray:
    """The place of each value in the reflected Gray code."""
    for shift in (1, 2, 4, 8, 16, 32):
        values = values ^ (values >> U64(shift))
    return values


def rotate(values: np.ndarray, bits: int) -> np.ndarray:
    return values if bits % 64 == 0 else (values << U64(bits)) | (values >> U64(64 - bits))


def shared(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mask and pattern of the bits that each run of values shares."""
    every = np.bitwise_and.reduceat(values, starts)
    some = np.bitwise_or.reduceat(values, starts)
    mask = ~(every ^ some)
    return mask, every & mask


class GrayIndex:
    def __init__(self, values: np.ndarray, group_starts: np.ndarray):
        self.values, n = values, len(values)
        sizes = np.diff(np.append(group_starts, n))
        within = np.arange(n) - np.repeat(group_starts, sizes)
        self.starts, self.ends, width = [], [], FANOUT
        while True:
            starts = np.flatnonzero(within % width == 0)
            self.starts.append(starts)
            self.ends.append(np.append(starts[1:], n))
            if width >= sizes.max():
                break
            width *= FANOUT
        self.masks, self.patterns = zip(*(shared(values, s) for s in self.starts), strict=True)
        self.children = [np.searchsorted(low, np.append(high, n)) for low, high in zip(self.starts, self.starts[1:])]

    def search(self, queries: np.ndarray, roots: np.ndarray, limit: int, after: np.ndarray) -> Iterator[tuple]:
        """Pairs of query number and place of a value within ``limit`` bits, placed behind ``after``."""
        for low in range(0, len(queries), QUERIES):
            q = np.arange(low, min(low + QUERIES, len(queries)))
            node, level = roots[q], len(self.starts) - 1
            bits = np.bitwise_count((queries[q] ^ self.patterns[level][node]) & self.masks[level][node]).astype(np.int64)
            keep = (bits <= limit) & (self.ends[level][node] > after[q] + 1)
            q, node, bits = q[keep], node[keep], bits[keep]
            while level and len(q):
                first, count = self.children[level - 1][node], np.diff(self.children[level - 1])[node]
                parent = np.repeat(self.masks[level][node], count)
                q, bits, node = np.repeat(q, count), np.repeat(bits, count), _ranges(first, count)
                level -= 1
                own = self.masks[level][node] & ~parent
                bits = bits + np.bitwise_count((queries[q] ^ self.patterns[level][node]) & own)
                keep = (bits <= limit) & (self.ends[level][node] > after[q] + 1)
                q, node, bits = q[keep], node[keep], bits[keep]
            if len(q):
                first, count = self.starts[0][node], (self.ends[0] - self.starts[0])[node]
                rest = np.repeat(~self.masks[0][node], count)
                q, bits, place = np.repeat(q, count), np.repeat(bits, count), _ranges(first, count)
                bits = bits + np.bitwise_count((queries[q] ^ self.values[place]) & rest)
                keep = (bits <= limit) & (place > after[q])
                yield q[keep], place[keep]


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())


def self_roots(values: np.ndarray, group_starts: np.ndarray, limit: int) -> np.ndarray:
    """For each value the first of its linked set in its group; only one link for each value is kept."""
    root = np.arange(len(values))
    if len(values):
        index = GrayIndex(values, group_starts)
        of = np.searchsorted(group_starts, root, side="right") - 1
        for q, place in index.search(values, of, limit, root):
            root = join_roots(root, q, place)
    return root


def cross_roots(left: np.ndarray, right: np.ndarray, limit: int) -> np.ndarray:
    """Roots over ``left`` then ``right``, of the links between a left and a right value."""
    root = np.arange(len(left) + len(right))
    index = GrayIndex(right, np.zeros(1, np.int64))
    none = np.full(len(left), -1)
    for q, place in index.search(left, np.zeros(len(left), np.int64), limit, none):
        root = join_roots(root, q, place + len(left))
    return root
