"""Texts of an Arrow batch as one flat byte array, cut and hashed with numpy.

Everything here works on the bytes of many documents at once, inside a task. Batches are
handed on in slices of bounded size, so memory does not depend on how many rows arrive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE_BYTES = 2 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LONG_WORD = 256
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_rng = np.random.default_rng(20240607)
_SYMBOLS = _rng.integers(0, 2**64, 256, dtype=np.uint64)
_SYMBOLS_LOWER = _SYMBOLS.copy()
_SYMBOLS_LOWER[65:91] = _SYMBOLS[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)

U64 = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, SLICE_BYTES + (1 << 18))
        inverse = pow(_BASE, -1, 2**64)
        for step in (_BASE, inverse):
            grown = np.full(size, step, U64)
            grown[0] = 1
            np.multiply.accumulate(grown, out=grown)
            if step == _BASE:
                _powers = grown
            else:
                _inverses = grown
    return _powers[:n], _inverses[:n]


def flatten(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of each row in them; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    binary = column.cast(pa.large_binary())
    if binary.null_count:
        binary = pc.fill_null(binary, b"")
    n = len(binary)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = binary.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[binary.offset:binary.offset + n + 1]
    data = (np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None
            else np.zeros(0, np.uint8))
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(data: np.ndarray, offsets: np.ndarray,
           limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of about ``limit`` bytes together: first, past last, bytes, offsets."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(rows, max(last, first + 1))
        yield (first, last, data[offsets[first]:offsets[last]],
               offsets[first:last + 1] - offsets[first])
        first = last


class Words:
    """Words of a slice: ``starts`` and ``ends`` in its bytes, ``rows`` their bounds by row."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE):
        inside = ~gap[data]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        before[edges] = False
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        after[edges[edges > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.rows = np.searchsorted(self.starts, offsets)
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.starts)

    def owner(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))

    def hashes(self, fold: bool = True) -> np.ndarray:
        """A 64-bit hash of each word, A-Z taken as a-z if ``fold``.

        Sums modulo 2**64 are alike for certain long texts, so long words are hashed by xxh3.
        """
        sums = prefix_sums(self.data, _SYMBOLS_LOWER if fold else _SYMBOLS)
        _, inverse = powers(len(self.data) + 1)
        lengths = self.ends - self.starts
        h = mix((sums[self.ends] - sums[self.starts]) * inverse[self.starts] + lengths.astype(U64))
        for i in np.flatnonzero(lengths > LONG_WORD):
            word = self.data[self.starts[i]:self.ends[i]]
            word = _LOWER[word] if fold else word
            h[i] = xxhash.xxh3_64_intdigest(word.tobytes())
        return h


def prefix_sums(data: np.ndarray, symbols: np.ndarray = _SYMBOLS) -> np.ndarray:
    """Sums of symbol times base power before each byte, modulo 2**64."""
    up, _ = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, U64)
    sums[0] = 0
    np.cumsum(symbols[data] * up[:-1], out=sums[1:])
    return sums


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every ``width`` consecutive bytes."""
    if len(data) < width:
        return np.zeros(0, U64)
    sums = prefix_sums(data)
    _, inverse = powers(len(data) + 1)
    return mix((sums[width:] - sums[:-width]) * inverse[:len(data) - width + 1])


def runs(values: np.ndarray) -> np.ndarray:
    """Start of each run of equal neighbours."""
    if not len(values):
        return np.zeros(0, np.int64)
    return np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1))


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` for ``counts[i]`` numbers, one after another."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total) - np.repeat(before - starts, counts)
