"""Whole Arrow string columns as numpy byte arrays: words, their hashes, and shingles.

Everything here works on a batch at once; hashes are 64-bit and computed from prefix sums,
so a word of any length costs the same per byte.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def give_back(least: int, most: int = 1 << 20) -> None:
    """glibc: freed arrays of ``least`` bytes go back to the system at once, others from ``most`` free bytes on; workers outlive
    many stages.  Elsewhere nothing happens."""
    with contextlib.suppress(OSError, AttributeError):
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, least)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, most)  # M_TRIM_THRESHOLD


give_back(1 << 20)
pa.set_memory_pool(pa.system_memory_pool())

_P = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Text bytes that are handled at once; a longer text is handled alone.
SLAB = 1 << 18
_pows: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _P)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least n + 1 of them."""
    if not _pows or len(_pows[0]) <= n:
        size = max(n + 1, SLAB + (1 << 16))
        inverse = np.uint64(pow(int(_P), -1, 1 << 64))
        _pows[:] = []
        for base in (_P, inverse):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _pows.append(np.multiply.accumulate(p))
    return _pows[0], _pows[1]


def column_bytes(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; nulls are empty."""
    if pa.types.is_dictionary(a.type):
        a = a.dictionary_decode()
    if a.null_count:
        a = a.fill_null("")
    wide = pa.types.is_large_string(a.type)
    _, offs, data = a.buffers()
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[a.offset : a.offset + len(a) + 1].astype(np.int64)
    b = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return b[o[0] : o[-1]], o - o[0]


def slabs(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about SLAB bytes of text each: (rows, bytes, offsets)."""
    for batch in batches:
        b, o = column_bytes(batch.column(column))
        i = 0
        while i < len(batch):
            j = max(i + 1, int(np.searchsorted(o, o[i] + SLAB, side="right")) - 1)
            yield batch.slice(i, j - i), b[o[i] : o[j]], o[i : j + 1] - o[i]
            i = j


def words(b: np.ndarray, o: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a slab: starts, ends, hashes, and the index of the first word of each row (and the end)."""
    n = len(b)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), np.zeros(len(o), np.int64)
    inside = ~_SPACE[b]
    edge = np.zeros(n + 1, bool)
    edge[o] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    power, inverse = _powers(n)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum((_FOLDED if fold else _BYTE)[b] * power[:n], out=sums[1:])
    h = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    return starts, ends, h, np.searchsorted(starts, o)


def shingles(h: np.ndarray, first: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words within rows, and the row of each; a shorter row gives one."""
    counts = np.diff(first)
    rows = np.repeat(np.arange(len(counts)), counts)
    n = len(h)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if n < k:
        h = np.concatenate([h, np.zeros(k - n, np.uint64)])
    m = len(h) - k + 1
    s = np.zeros(m, np.uint64)
    for i in range(k):
        s = s * _P + h[i : i + m]
    left = first[1:][rows] - np.arange(n)
    full = np.flatnonzero(left >= k)
    out, owner = mix(s[full]), rows[full]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.array(
            [int(_fold(h[first[i] : first[i + 1]])) for i in short], np.uint64
        )
        out, owner = np.concatenate([out, mix(extra)]), np.concatenate([owner, short])
    return out, owner


def _fold(h: np.ndarray) -> np.uint64:
    x = np.uint64(len(h))
    with np.errstate(over="ignore"):
        for y in h:
            x = x * _P + y
    return x


def distinct(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, sorted by row and value."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], owner[new]
