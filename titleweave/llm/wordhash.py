"""Words and hashes of whole Arrow text columns, vectorised over bytes.

A batch is worked through in runs of documents of a few megabytes, so that memory follows the
longest document rather than the batch. A word's hash is a polynomial over its bytes modulo
2**64, read off running sums; a window's hash is the same over its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

RUN_BYTES = 2 << 20
U = np.uint64


def scatter(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers, so that near inputs land far apart."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(n, base, U), np.full(n, inverse, U)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=U, out=up), np.cumprod(down, dtype=U, out=down)


@lru_cache(maxsize=4)
def _powers_of_a_run(base: int) -> tuple[np.ndarray, np.ndarray]:
    """32 MB a base: enough for a run of ordinary texts, kept as long as the worker lives."""
    return _power_table(base, RUN_BYTES + 1)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers; a table for a text longer than a run is not kept."""
    up, down = _powers_of_a_run(base) if n <= RUN_BYTES + 1 else _power_table(base, n)
    return up[:n], down[:n]


_BYTE = scatter(np.arange(1, 257, dtype=U))
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]


def sums(values: np.ndarray, dtype=U) -> np.ndarray:
    """Running sums with a leading zero."""
    out = np.zeros(len(values) + 1, dtype)
    np.cumsum(values, dtype=dtype, out=out[1:])
    return out


@dataclass
class Run:
    """Consecutive documents: bytes, document bounds, word bounds, first word of each document."""

    first: int
    data: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    word_bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def per_document(self, flags: np.ndarray) -> np.ndarray:
        """Sums of a value per byte over each document."""
        return np.diff(sums(flags, np.int64)[self.bounds])

    def per_document_words(self, flags: np.ndarray) -> np.ndarray:
        return np.diff(sums(flags, np.int64)[self.word_bounds])

    def document_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.word_bounds))

    def hashes(self, lower: bool = False) -> np.ndarray:
        up, down = powers(0x9E3779B97F4A7C15, len(self.data) + 1)
        total = sums((_LOWER if lower else _BYTE)[self.data] * up[1:])
        return scatter((total[self.ends] - total[self.starts]) * down[self.starts])

    def windows(self, hashes: np.ndarray, width: int, base: int = 0xD6E8FEB86659FD93) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of ``width`` words within a document, and their hashes."""
        n = len(hashes)
        if n < width:
            return np.empty(0, np.int64), np.empty(0, U)
        up, down = powers(base, n + 1)
        total = sums(hashes * up[:n])
        last = np.repeat(self.word_bounds[1:], np.diff(self.word_bounds))
        at = np.flatnonzero(np.arange(n) + width <= last)
        return at, scatter((total[at + width] - total[at]) * down[at])


_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True

# White space and ASCII punctuation: what is left are letters, digits and all other scripts.
PUNCTUATION = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def runs(column: pa.Array, limit: int = RUN_BYTES, between: np.ndarray = _WHITE) -> Iterator[Run]:
    """Cut a text column into runs; null texts are empty. ``between`` marks the bytes that part words."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    if column.null_count:
        lengths = np.where(np.asarray(column.is_valid()), np.diff(offsets), 0)
        if lengths.sum() != offsets[-1] - offsets[0]:
            yield from runs(column.fill_null(""), limit, between)
            return
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield _run(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], between)
        first = last


def _run(first: int, data: np.ndarray, bounds: np.ndarray, between: np.ndarray) -> Run:
    n = len(data)
    inside = ~between[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    before = np.empty(n, bool)
    if n:
        before[0] = False
        before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    if n:
        after[-1] = False
        after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Run(first, data, bounds, starts, ends, np.searchsorted(starts, bounds))
