"""Vectorised work on the bytes of many texts at once, for use inside tasks.

Texts of an Arrow batch are taken about a megabyte at a time. Substrings are named by polynomial
hashes: with ``P`` the running sum of byte * B^i (mod 2^64), the hash of [s, e) is
(P[e] - P[s]) * B^-s, the same wherever the substring stands.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
IS_BLANK = np.zeros(256, bool)
IS_BLANK[[32, 9, 10, 11, 12, 13]] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^i and B^-i for i below ``n`` at least."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """P[0..n]."""
    up, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = powers(len(prefix))
    return (prefix[end] - prefix[start]) * down[start]


@dataclass
class Chunk:
    """Some texts of a batch: rows [first, last), their bytes, and where each begins (and the end)."""

    batch: pa.RecordBatch
    first: int
    last: int
    data: np.ndarray
    starts: np.ndarray

    def column(self, name: str) -> pa.Array:
        return self.batch.column(self.batch.schema.get_field_index(name)).slice(self.first, self.last - self.first)

    def __len__(self) -> int:
        return self.last - self.first


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if len(column) == 0:
            continue
        wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        i = 0
        while i < len(column):
            j = max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1)
            yield Chunk(batch, i, j, every[at[i] : at[j]], at[i : j + 1] - at[i])
            i = j


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and text number of every word; words never cross texts."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~IS_BLANK[data]
    opens = np.ones(n, bool)
    opens[1:] = ~inside[:-1]
    edge = starts[:-1][starts[:-1] < n]
    opens[edge] = True
    closes = np.ones(n, bool)
    closes[:-1] = opens[1:] | ~inside[1:]
    begin = np.flatnonzero(inside & opens)
    end = np.flatnonzero(inside & closes) + 1
    return begin, end, np.searchsorted(starts, begin, "right") - 1


def word_hashes(chunk: Chunk, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, begin, end and text number of every word."""
    data = LOWERED[chunk.data] if lower else chunk.data
    begin, end, doc = words(data, chunk.starts)
    return mixed(span_hashes(prefix_hashes(data), begin, end) + (end - begin).astype(np.uint64)), begin, end, doc


def grams(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words inside a text, and the number of the first word of each."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(doc[: len(doc) - n + 1] == doc[n - 1 :])
    total = np.zeros(len(first), np.uint64)
    for j in range(n):
        total = total * np.uint64(0xD6E8FEB86659FD93) + hashes[first + j]
    return mixed(total), first
