"""Texts of an Arrow batch as flat byte arrays: words, hashes and windows without a loop per word.

Hashes are polynomials modulo 2**64 over random values of the units, taken from prefix sums, so
that any stretch costs two lookups; ``mix`` spreads the result over all bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
#: Text bytes worked on at a time; a longer document is a chunk of its own.
CHUNK_BYTES = 1 << 18

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which every input bit moves about half the output bits."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


BYTE_VALUE = mix(np.arange(1, 257, dtype=U64))

_powers = [np.ones(1, dtype=U64), np.ones(1, dtype=U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n - 1 at least of the base and of its inverse."""
    if len(_powers[0]) < n:
        size = max(n, 2 * CHUNK_BYTES)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, U64(base))
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


class Stretches:
    """Hash of any stretch of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray) -> None:
        up, self._down = powers(len(values) + 1)
        self._sums = np.zeros(len(values) + 1, dtype=U64)
        np.cumsum(values * up[: len(values)], out=self._sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        found = (self._sums[end] - self._sums[start]) * self._down[start]
        return mix(found + (end - start).astype(U64))

    def every(self, length: int) -> np.ndarray:
        """Hashes of all stretches of one length, by start."""
        sums = self._sums
        n = len(sums) - length
        if n <= 0:
            return np.empty(0, dtype=U64)
        found = (sums[length:] - sums[:n]) * self._down[:n]
        return mix(found + U64(length))


class Chunk:
    """Consecutive documents of a batch: ``data`` bytes, ``bounds`` of the documents in it."""

    def __init__(self, first: int, data: np.ndarray, bounds: np.ndarray) -> None:
        self.first, self.data, self.bounds = first, data, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def words(self, data: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end bytes of all words, and per document the number of the first word
        (with one entry more, the number of words)."""
        inside = ~SEPARATOR[self.data if data is None else data]
        n = len(inside)
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        first, after = self.bounds[:-1], self.bounds[1:]
        first, after = first[first < n], after[after > 0]
        starts[first] |= inside[first]
        ends[after - 1] |= inside[after - 1]
        starts = np.flatnonzero(starts)
        return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, self.bounds)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts of a string column (null: empty) in chunks of about ``limit`` bytes."""
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    n = len(texts)
    if n == 0:
        return
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[texts.offset: texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        to = min(to, n)
        yield Chunk(at, data[offsets[at]: offsets[to]], offsets[at: to + 1] - offsets[at])
        at = to


def column(values: np.ndarray) -> pa.Array:
    """A numpy array as an Arrow column; unsigned words become signed."""
    return pa.array(values.view(np.int64) if values.dtype == U64 else values)


def as_bytes(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary column of the stretches that ``bounds`` marks in ``data``."""
    return pa.Array.from_buffers(
        pa.binary(), len(bounds) - 1,
        [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))],
    )


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... for each stretch, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours: prefix and suffix minima of blocks of that width."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1: width - 1 + n])
