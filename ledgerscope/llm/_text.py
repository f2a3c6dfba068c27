"""Vectorised words and hashes over Arrow string columns (helpers for tasks).

A text column is one byte buffer plus offsets, so words of a whole block of documents
are found and hashed with a handful of NumPy passes; there is no per-word Python.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_RNG = np.random.default_rng(20240817)
BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
STEP = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)
BASE = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(int(BASE), -1, 2**64))
BLOCK_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def class_table(excluded: list[tuple[int, int]]) -> np.ndarray:
    """True for the bytes that belong to a word: all but the excluded ranges."""
    t = np.ones(256, bool)
    for lo, hi in excluded:
        t[lo:hi + 1] = False
    return t


#: words [^\x20\x09-\x0D]+ and words of letters, digits and everything beyond ASCII
SPACED = class_table([(0x20, 0x20), (0x09, 0x0D)])
ALNUM = class_table([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64-bit values (wrap-around is meant)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Powers:
    """BASE**i and INVERSE**i, grown on demand to the longest block of this worker."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            m = max(n, BLOCK_BYTES + 1)
            cls.up = np.full(m, BASE, np.uint64)
            cls.down = np.full(m, INVERSE, np.uint64)
            cls.up[0] = cls.down[0] = 1
            np.multiply.accumulate(cls.up, out=cls.up)
            np.multiply.accumulate(cls.down, out=cls.down)
        return cls.up[:n], cls.down[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """S with S[i] = sum of BYTE[b_t] * BASE**t for t < i (mod 2**64)."""
    up, _ = Powers.to(len(data) + 1)
    s = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * up[:-1], out=s[1:])
    return s


def span_hash(s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end), equal for equal bytes anywhere."""
    _, down = Powers.to(len(s))
    return mix((s[end] - s[start]) * down[start] + (end - start).astype(np.uint64) * STEP[63])


def column(array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, valid) of an Arrow string array; nulls are empty and not valid."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if not pa.types.is_large_string(array.type):
        array = array.cast(pa.large_string())
    n = len(array)
    offsets = np.frombuffer(array.buffers()[1], np.int64, n + 1, array.offset * 8) if n else np.zeros(1, np.int64)
    raw = array.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    valid = np.asarray(array.is_valid().to_numpy(zero_copy_only=False), bool)
    if n and not valid.all():   # a null's slot may hold bytes: take them out
        return column(array.fill_null(""))[:2] + (valid,)
    return data, offsets, valid


def blocks(array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows (first, last, bytes, own offsets, valid) of at most ``limit`` bytes;
    a longer single text is a run of its own."""
    data, offsets, valid = column(array)
    n, i = len(valid), 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], valid[i:j]
        i = j


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each row): ``first`` has one entry more than rows."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    opens = inside.copy()
    opens[1:] &= ~inside[:-1] | edge[1:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    start = np.flatnonzero(opens)
    return start, np.flatnonzero(closes) + 1, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the words, computed for about BLOCK_BYTES of text at a time."""
    out, i = np.zeros(len(start), np.uint64), 0
    while i < len(start):
        lo = start[i]
        j = max(i + 1, int(np.searchsorted(end, lo + BLOCK_BYTES, "right")))
        out[i:j] = span_hash(prefix_hash(data[lo:end[j - 1]]), start[i:j] - lo, end[i:j] - lo)
        i = j
    return out


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive words at every start (row borders are not looked at)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out += mix(h[j:j + m] * STEP[j] + STEP[j + 20])
    return mix(out + np.full(1, n, np.uint64) * STEP[62])


def release() -> None:
    """Give memory that this worker has freed back to the system: workers outlive their stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):    # another C library than glibc
        pass


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return h.view(np.int64)
