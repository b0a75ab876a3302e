"""Whole-batch text kernels on Arrow buffers: words, 64-bit word hashes and n-grams without a Python object per word.

A word's hash is a polynomial over byte constants modulo 2**64, read off a running sum, so that any stretch of a
text is hashed by two lookups. Positions are byte positions within the batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
_CHUNK = 1 << 18
_MASK = (1 << 64) - 1


def release() -> None:
    """Gives freed memory back to the system; workers live on through stages and keep what earlier ones freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def releasing(kernel: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """A batch kernel whose worker gives back what the task has freed."""

    @wraps(kernel)
    def run(*args, **options):
        try:
            yield from kernel(*args, **options)
        finally:
            release()

    return run


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(32)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_P = _powers(_BASE, _CHUNK)
_Q = _powers(pow(_BASE, -1, 1 << 64), _CHUNK)
_CASED = mix(np.arange(1, 257, dtype=U64))
_LOWER = _CASED.copy()
_LOWER[65:91] = _CASED[97:123]
#: Byte constants of two independent hashes that take letters as they are.
PLAIN, PROOF = _CASED, mix(np.arange(1001, 1257, dtype=U64))
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows and the offsets of each; a null counts as an empty text."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of whole rows with about limit bytes of text each (one row at least)."""
    if not batch.num_rows:
        return
    _, offsets = utf8(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def stretch_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [start, end) of data; stretches ascend and don't overlap."""
    out = np.zeros(len(start), dtype=U64)
    i, n = 0, len(start)
    while i < n:
        a = int(start[i])
        j = int(np.searchsorted(end, a + _CHUNK, "right"))
        if j <= i:  # one stretch longer than the power table
            total = 0
            for k in range(a, int(end[i]), _CHUNK):
                part = data[k : min(k + _CHUNK, int(end[i]))]
                total += int((table[part] * _P[: len(part)]).sum(dtype=U64)) * pow(_BASE, k - a, 1 << 64)
            out[i] = U64(total & _MASK)
            i += 1
            continue
        b = int(end[j - 1])
        sums = np.zeros(b - a + 1, dtype=U64)
        np.cumsum(table[data[a:b]] * _P[: b - a], out=sums[1:])
        s, e = start[i:j] - a, end[i:j] - a
        out[i:j] = (sums[e] - sums[s]) * _Q[s]
        i = j
    return mix(out + (end - start).astype(U64))


class Words:
    """Words between ASCII white space, of each row of a text column."""

    def __init__(self, column: pa.Array, lower: bool = False):
        self.data, self.offsets = utf8(column)
        self.n_docs = len(self.offsets) - 1
        self.table = _LOWER if lower else _CASED
        filled = self.offsets[:-1] < self.offsets[1:]
        blank = SPACE[self.data]
        before = np.ones(len(blank), dtype=bool)
        before[1:] = blank[:-1]
        before[self.offsets[:-1][filled]] = True
        after = np.ones(len(blank), dtype=bool)
        after[:-1] = blank[1:]
        after[self.offsets[1:][filled] - 1] = True
        self.blank = blank
        self.start = np.flatnonzero(~blank & before)
        self.end = np.flatnonzero(~blank & after) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n_docs), self.count)

    def hashes(self) -> np.ndarray:
        return stretch_hashes(self.data, self.start, self.end, self.table)

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Sums over each row's bytes."""
        return sums(flags, self.offsets)


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between successive bounds."""
    kind = np.float64 if values.dtype.kind == "f" else np.int64
    total = np.zeros(len(values) + 1, dtype=kind)
    np.cumsum(values, out=total[1:], dtype=kind)
    return total[bounds[1:]] - total[bounds[:-1]]


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n successive words; the last n - 1 positions have none."""
    size = max(0, len(h) - n + 1)
    out = np.full(size, n, dtype=U64)
    for k in range(n):
        out = mix(out * U64(_BASE) + h[k : k + size])
    return out


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """Of each row the sorted distinct hashes of its n-word shingles; a shorter row is one shingle, an empty one has none."""
    h = words.hashes()
    g = grams(h, n)
    out = []
    for a, c in zip(words.first[:-1].tolist(), words.count.tolist(), strict=True):
        if c >= n:
            out.append(np.unique(g[a : a + c - n + 1]))
        else:
            out.append(grams(h[a : a + c], c) if c else np.zeros(0, dtype=U64))
    return out
