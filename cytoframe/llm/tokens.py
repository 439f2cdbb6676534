"""Words and shingles of whole Arrow batches as 64-bit hashes, without a Python loop per word.

A word's hash is a polynomial over its folded bytes (one fixed random number per byte
value), taken from prefix sums of the batch, then mixed.  Arithmetic wraps at 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """SplitMix64's finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def randoms(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit numbers, the same in every process."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed * 7919 + 1))


def _byte_numbers(lower: bool) -> np.ndarray:
    table = randoms(256, 11)
    if lower:
        table[65:91] = table[97:123]
    return table


_BYTES = {True: _byte_numbers(True), False: _byte_numbers(False)}
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = U(0x9E3779B97F4A7C15)
_BASE_INV = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}
_STEPS = randoms(64, 23) | U(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(size, base, dtype=U)
            p[0] = U(1)
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


@dataclass
class Words:
    """Words of consecutive texts: word w of text d for bounds[d] <= w < bounds[d + 1]."""

    first: int  # number of the first text within the batch
    n_texts: int
    hashes: np.ndarray
    bounds: np.ndarray
    raw: np.ndarray  # the bytes of the texts
    starts: np.ndarray  # where each word starts in raw
    ends: np.ndarray
    text_ends: np.ndarray

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), np.diff(self.bounds))


def slices(column: pa.Array, lower: bool = True) -> Iterator[Words]:
    """The words of a string column, about a megabyte of text at a time; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1)
        yield _words(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], at, lower)
        at = to


def _words(raw: np.ndarray, offsets: np.ndarray, first: int, lower: bool) -> Words:
    n, size = len(offsets) - 1, len(raw)
    if size == 0:
        empty = np.zeros(0, np.int64)
        return Words(first, n, np.zeros(0, U), np.zeros(n + 1, np.int64), raw, empty, empty, offsets[1:])
    solid = ~_IS_BLANK[raw]
    cut = np.zeros(size + 1, bool)  # a text begins here
    cut[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | cut[1:size]
    stops = solid.copy()
    stops[:-1] &= ~solid[1:] | cut[1:size]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    up, down = _powers(size + 1)
    sums = np.zeros(size + 1, U)
    np.cumsum(_BYTES[lower][raw] * up[:size], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    return Words(first, n, hashes, np.searchsorted(starts, offsets), raw, starts, ends, offsets[1:])


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of k words, and bounds per text; a shorter text is one window."""
    counts = np.diff(words.bounds)
    n_windows = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(n_windows)])
    first = np.repeat(words.bounds[:-1] - bounds[:-1], n_windows) + np.arange(bounds[-1])
    width = np.minimum(np.repeat(counts, n_windows), k)
    total = mix(width.astype(U))
    for j in range(k):
        inside = width > j
        total += np.where(inside, words.hashes[np.minimum(first + j, max(len(words.hashes) - 1, 0))] * _STEPS[j], U(0))
    return mix(total), bounds
