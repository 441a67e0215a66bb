"""Suffix comparison by prefix hashes, and a merge sort of suffixes built on it.

With polynomial prefix hashes, two suffixes have a common start of length n if the hashes of
their first n bytes are equal; binary search over n finds the longest, so a comparison
takes log(limit) look-ups instead of reading the suffixes. All merges of a level are done at once:
the place of each suffix is its place in its own half plus its rank in the other half.
"""

from __future__ import annotations

import numpy as np

from .bytescan import powers, prefix_hashes


class Suffixes:
    """Suffixes of ``data``, compared by their first ``limit`` bytes."""

    def __init__(self, data: np.ndarray, limit: int):
        self.data, self.limit = data, limit
        self.prefix = prefix_hashes(data)
        self.down = powers(len(data) + 1)[1]

    def same(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        p, d = self.prefix, self.down
        return (p[a + n] - p[a]) * d[a] == (p[b + n] - p[b]) * d[b]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common start, at most ``limit``."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.limit, np.int64)
        while True:
            open_ = low < high
            if not open_.any():
                return low
            middle = (low + high + 1) >> 1
            equal = self.same(a, b, middle)
            low = np.where(equal, middle, low)
            high = np.where(equal, high, middle - 1)

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffix ``a`` sorts before ``b``."""
        n = self.common(a, b)
        last = len(self.data) - 1
        return (n < self.limit) & (self.data[np.minimum(a + n, last)] < self.data[np.minimum(b + n, last)])

    def equal_bytes(self, a: np.ndarray, b: np.ndarray, rows: int = 4096) -> np.ndarray:
        """Whether the first ``limit`` bytes are equal, byte by byte."""
        out = np.zeros(len(a), bool)
        span = np.arange(self.limit)
        for i in range(0, len(a), rows):
            x, y = a[i : i + rows, None] + span, b[i : i + rows, None] + span
            out[i : i + rows] = (self.data[x] == self.data[y]).all(axis=1)
        return out


def merge_sort(suffixes: Suffixes, at: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Indices that sort the suffixes starting ``at`` inside each ``group``; groups stay together."""
    order = np.argsort(group, kind="stable")
    n = len(order)
    if n == 0:
        return order
    own = group[order]
    begins = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    sizes = np.diff(np.r_[begins, n])
    first = np.repeat(begins, sizes)
    end = first + np.repeat(sizes, sizes)
    place = np.arange(n)
    width = 1
    while width < sizes.max():
        # only groups with two halves at this width
        live = np.flatnonzero(end - first > width)
        inside = place[live] - first[live]
        right_half = (inside // width) & 1
        base = first[live] + (inside // (2 * width)) * 2 * width
        middle = np.minimum(base + width, end[live])
        stop = np.minimum(base + 2 * width, end[live])
        low = np.where(right_half == 1, base, middle)
        high = np.where(right_half == 1, middle, stop)
        mine = at[order[live]]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            probe = (low[open_] + high[open_]) >> 1
            other = at[order[probe]]
            # equal suffixes keep their order: the left half's come first
            from_right = right_half[open_] == 1
            forward = np.where(from_right, ~suffixes.before(mine[open_], other), suffixes.before(other, mine[open_]))
            low[open_] = np.where(forward, probe + 1, low[open_])
            high[open_] = np.where(forward, high[open_], probe)
        rank = low - np.where(right_half == 1, base, middle)
        own_place = np.where(right_half == 1, inside - (middle - first[live]), inside - (base - first[live]))
        moved = order.copy()
        moved[base + own_place + rank] = order[live]
        order = moved
        width *= 2
    return order
