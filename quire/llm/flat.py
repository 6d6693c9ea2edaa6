"""Flat-array helpers for Arrow batches.

The texts of an Arrow batch already lie in one UTF-8 buffer with offsets. The
operators work on slices of that buffer with numpy, so a batch of thousands of
documents costs a fixed number of vector operations. A slice holds about
``SLICE_BYTES`` of text and at least one whole document, which bounds the
memory of a task by the longest document and not by the batch. Operators whose
arrays take many times the text work on slices of ``SMALL_SLICE``: a worker
serves one task after the other and keeps much of the most it ever held.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
SMALL_SLICE = 1 << 17
U64 = np.uint64

#: ASCII white space: space and tab to carriage return.
WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

#: Byte table that lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def buffer_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and ``len + 1`` offsets of a string column; null is empty."""
    pa.default_memory_pool().release_unused()  # of the batch before
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    if len(col) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def slices(data: np.ndarray, offs: np.ndarray, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield ``(first row, last row, bytes, offsets)`` of whole documents."""
    n, i = len(offs) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, "right")) - 1)
        yield i, j, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i]
        i = j


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


class Rolling:
    """Rabin-Karp hashes of arbitrary ranges of a sequence.

    ``H[i] = sum(x[j] * p**j for j < i)`` modulo the prime 2**31 - 1, for two
    bases at once; as ``p`` has an inverse, the hash of ``[s, e)`` is
    ``(H[e] - H[s]) * p**-s`` and does not depend on where the range lies. The
    modulus is prime because a power of two lets some unequal sequences
    collide whatever the base is. Symbols have up to 64 bits: one hash takes
    the lower 31 bits, the other their sum with the upper ones.
    """

    PRIME = U64((1 << 31) - 1)

    def __init__(self, base: int = 0x9E3779B97F4A7C15):
        p = int(self.PRIME)
        self.bases = [base % p, (base >> 31) % p]
        self.pow = self.inv = [np.ones(1, U64)] * 2

    def _grow(self, n: int) -> None:
        if len(self.pow[0]) < n:
            n = max(n, 1 << 16)
            p = int(self.PRIME)
            self.pow = [self._powers(b, n) for b in self.bases]
            self.inv = [self._powers(pow(b, -1, p), n) for b in self.bases]

    def _powers(self, b: int, n: int) -> np.ndarray:
        out = np.ones(n, U64)
        done = 1
        while done < n:   # the next ones are the first ones times b**done
            to = min(2 * done, n)
            out[done:to] = out[:to - done] * U64(pow(b, done, int(self.PRIME))) % self.PRIME
            done = to
        return out

    def prefix(self, x: np.ndarray) -> np.ndarray:
        """Sums of the terms, not reduced: below 2**63 up to 2**32 symbols."""
        self._grow(len(x) + 1)
        if x.dtype == np.uint8:
            low = high = x.astype(U64)
        else:
            x = x.astype(U64)
            low = x & self.PRIME
            high = (low + (x >> U64(31))) % self.PRIME
        out = np.zeros((2, len(x) + 1), U64)
        for o, y, w in zip(out, (low, high), self.pow):
            np.cumsum((y + U64(1)) * w[:len(x)] % self.PRIME, out=o[1:])
        return out

    def ranges(self, h: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Mixed hash of every range ``[s, e)``; equal content, equal hash."""
        self._grow(h.shape[1])
        a, b = ((g[e] - g[s]) % self.PRIME * w[s] % self.PRIME for g, w in zip(h, self.inv))
        return mix((a << U64(31) | b) + (e - s).astype(U64) * U64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without ASCII white space) and the
    first word of every document (``rows + 1`` numbers)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    solid = ~WHITE[data]
    cut = np.zeros(n + 1, bool)
    cut[offs] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | cut[1:n]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | cut[1:n]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offs)


def spans_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The bytes of many spans, one after the other."""
    return data[span_index(starts, ends - starts)]


def span_index(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices ``starts[i], ..., starts[i] + lens[i] - 1`` for every i, flat."""
    total = int(lens.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    at = np.cumsum(lens) - lens
    return np.arange(total, dtype=np.int64) + np.repeat(starts - at, lens)


def string_array(data: np.ndarray, offs: np.ndarray) -> pa.Array:
    """Strings from flat UTF-8 bytes and offsets."""
    return pa.LargeStringArray.from_buffers(
        len(offs) - 1, pa.py_buffer(np.ascontiguousarray(offs, np.int64)), pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())
