"""Texts of an Arrow batch as one byte array, with vectorised words and hashes of any span.

Everything here works on whole texts, in slices of a bounded number of bytes; a longer text is a slice of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_letters: dict[int, np.ndarray] = {}
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def release() -> None:
    """Hand freed memory back to the system: a Python worker outlives its task, and what it keeps idle fills the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one slice hold at most ``limit`` bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        first = 0
        while first < len(ends):
            done = ends[first - 1] if first else 0
            last = max(int(np.searchsorted(ends, done + limit, "right")), first + 1)
            yield batch.slice(first, last - first)
            first = last
    release()


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the bounds between them (one more than rows); null texts are empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    column = pc.fill_null(column.cast(kind), b"")
    _, offsets, data = column.buffers()
    width = np.int64 if kind == pa.large_binary() else np.int32
    if offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word ``[^\\x20\\x09-\\x0D]+``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    starts = np.flatnonzero(word & (np.concatenate(([True], ~word[:-1])) | edge[:-1]))
    ends = np.flatnonzero(word & (np.concatenate((~word[1:], [True])) | edge[1:])) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that every bit depends on all others."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _powers_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 20)
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


class PrefixHash:
    """Prefix polynomial hashes modulo 2^64 over random letter values; the hash of any span in constant time."""

    def __init__(self, data: np.ndarray, seed: int = 20):
        if seed not in _letters:
            _letters[seed] = np.random.Generator(np.random.PCG64(seed)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        powers, self.inverse = _powers_up_to(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_letters[seed][data] * powers[: len(data)], out=self.sums[1:])

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Equal for equal spans, wherever they lie; not mixed."""
        return (self.sums[ends] - self.sums[starts]) * self.inverse[starts]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix(self.raw(starts, ends))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive values; callers drop the runs that cross texts."""
    n = max(len(hashes) - size + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = mix(out + hashes[k : k + n] + np.uint64(k))
    return out


def per_text(values: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Integer sums by text number."""
    return np.bincount(text, weights=values, minlength=texts).astype(np.int64)
