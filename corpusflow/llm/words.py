"""Words and byte strings of whole Arrow batches as 64-bit hashes, with array arithmetic.

A batch is cut into slices of a few megabytes of text, so the memory of a task does
not depend on the batch size, only on its longest single text. The hash of a byte
range is a polynomial over random byte values, taken from prefix sums and mixed, so
every range of a slice costs the same whatever its length. Two different strings
share a hash with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
# The blanks of [\x20\x09-\x0D].
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

_U = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(_MULTIPLIER))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64, at least `n` of them, kept for the worker's next slices."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, SLICE_BYTES + 4096), base, np.uint64)
        steps[0] = 1
        known = np.cumprod(steps)
        if n <= 2 * SLICE_BYTES:
            _powers[base] = known
    return known


class Ranges:
    """Hashes of byte ranges of one buffer."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[data] * _power(_MULTIPLIER, n + 1)[:n], out=self.sums[1:])
        self.inverse = _power(_INVERSE, n + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(value + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of `batches` in pieces of about `size` bytes of text, one row at least."""
    for batch in batches:
        at, n = 0, batch.num_rows
        ends = np.asarray(offsets(batch.column(column)))[1:] if n else []
        while at < n:
            before = ends[at - 1] if at else 0
            stop = max(int(np.searchsorted(ends, before + size, "right")), at + 1)
            yield batch.slice(at, stop - at)
            at = stop


def offsets(texts: pa.Array) -> np.ndarray:
    """Where each text begins in `data(texts)`, and the end of the last; a null is empty."""
    if not len(texts):
        return np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    raw = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return raw - raw[0]


def data(texts: pa.Array) -> np.ndarray:
    """The UTF-8 bytes of all texts in a row."""
    if not len(texts) or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8)
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    raw = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2], np.uint8)[raw[0] : raw[-1]]


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, and where the words of each text begin among them."""
    at, raw = offsets(texts), data(texts)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = ~_BLANK[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Ranges(_LOWER[raw]).hash(starts, ends), np.searchsorted(starts, at)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of `size` words in a row; fewer words are one shingle, none give none."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    value = np.full(n, size, np.uint64)
    for k in range(size):
        value = mix(value * _U(_MULTIPLIER) + words[k : k + n])
    return value
