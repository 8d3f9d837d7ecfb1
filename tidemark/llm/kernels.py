"""Vectorised word kernels over the UTF-8 buffers of Arrow string arrays.

A word is a maximal run of bytes other than space and 0x09-0x0D. These
separators are ASCII, so UTF-8 text can be cut at byte level. Work is done in
blocks of a few MB, so memory follows the block and not the batch.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_M64 = (1 << 64) - 1
_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (splitmix64) on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_EXACT = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _FOLDED[97:123]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(BLOCK_BYTES + 4096, n)
    if size > BLOCK_BYTES + 4096:
        return _powers(_P, size), _powers(_P_INV, size)
    if size not in _POW:
        _POW[size] = (_powers(_P, size), _powers(_P_INV, size))
    return _POW[size]


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls become empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    if len(offsets) == 0:
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lengths(column: pa.Array) -> pa.Array:
    """Bytes of each text; of a null 0."""
    return pa.array(np.diff(string_buffers(column)[1]), pa.int64())


def word_bounds(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (with an end mark); ``between`` tells the bytes of no word."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    solid = ~between[data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | cut[:-1]))
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold_case: bool) -> np.ndarray:
    """A 64-bit hash of each word; ``fold_case`` makes A-Z equal to a-z."""
    out = np.empty(len(starts), dtype=np.uint64)
    table = _FOLDED if fold_case else _EXACT
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, side="right")))
        span = int(ends[j - 1] - base)
        power, inverse = _power_tables(span)
        sums = np.zeros(span + 1, dtype=np.uint64)
        np.cumsum(table[data[base : base + span]] * power[:span], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix64((sums[e] - sums[s]) * inverse[s])
        i = j
    return out


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` consecutive words."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    k = np.uint64(0x2545F4914F6CDD1D)
    acc = hashes[: len(hashes) - n + 1].copy()
    for i in range(1, n):
        acc = acc * k + hashes[i : len(hashes) - n + 1 + i]
    return mix64(acc + np.uint64(n))


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingles of a text; a shorter text is one shingle, an empty one has none."""
    if len(hashes) == 0:
        return np.zeros(0, dtype=np.uint64)
    if len(hashes) < n:
        return rolling(hashes, len(hashes))
    return np.unique(rolling(hashes, n))


def trim() -> None:
    """Give memory that a task has freed back to the system: workers stay for the next task, their executor's limit counts them."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only glibc has it
        pass


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes of text each, one row at least."""
    lengths = np.diff(string_buffers(column)[1])
    i = 0
    while i < len(lengths):
        total, j = int(lengths[i]), i + 1
        while j < len(lengths) and total + lengths[j] <= size:
            total += int(lengths[j])
            j += 1
        yield i, j
        i = j
