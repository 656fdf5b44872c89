"""Numpy helpers over Arrow text columns.

A column of texts is one array of UTF-8 bytes with row offsets; nulls count as empty. Everything here works on such
arrays inside a Spark task, a bounded number of bytes at a time (one long text may exceed the bound alone). What a batch took is
given back to the system, as Python workers stay when their task is done, and stand beside later stages that need none.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Numbers made of a chunk take some 50 times its bytes.
CHUNK_BYTES = 1 << 19
_U = np.uint64
#: Polynomial hashes are taken modulo this prime. Modulo 2^64 every base lets Thue-Morse strings collide.
PRIME = (1 << 61) - 1
_BASE = 0x9E3779B97F4A7C15 % PRIME
_INVERSE = pow(_BASE, -1, PRIME)
_powers = np.ones(1, _U)
_inverses = np.ones(1, _U)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets): row i holds bytes[offsets[i]:offsets[i + 1]]."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    binary = pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type)
    column = pc.fill_null(column.cast(pa.large_binary()), b"") if binary else pc.fill_null(column.cast(pa.large_string()), "")
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of consecutive rows, about `most` bytes each."""
    data, offsets = text_bytes(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi
    give_back()


def give_back() -> None:
    """Free memory goes to the system; without this the allocators keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(_U)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME."""
    x = (x & _U(PRIME)) + (x >> _U(61))
    return np.minimum(x, x - _U(PRIME))  # what is below 0 wraps and is the larger


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME of numbers below it, by halves of 31 bits."""
    low = _U((1 << 31) - 1)
    a1, a0, b1, b0 = a >> _U(31), a & low, b >> _U(31), b & low
    middle = a1 * b0 + a0 * b1
    return _reduced(((a1 * b1) << _U(1)) + (middle >> _U(30)) + ((middle & _U((1 << 30) - 1)) << _U(31)) + a0 * b0)


def _stretches(n: int) -> Iterator[slice]:
    """Stretches of an array that stay in a CPU's cache."""
    return (slice(at, min(at + (1 << 13), n)) for at in range(0, n, 1 << 13))


BYTE_VALUES = _reduced(mix(np.arange(1, 257, dtype=_U)))
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True


def _powers_of(base: int, n: int) -> np.ndarray:
    out = np.ones(n, _U)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = _product(out[:more], _U(pow(base, have, PRIME)))
        have += more
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, CHUNK_BYTES + 1)
        _powers, _inverses = _powers_of(_BASE, n), _powers_of(_INVERSE, n)
    return _powers, _inverses


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash modulo PRIME; see span_hash."""
    n = len(values)
    power = powers(n + 1)[0]
    out = np.zeros(n + 1, _U)
    for part in _stretches(n):
        x = _product(_reduced(values[part]), power[part])
        high, low = np.cumsum(x >> _U(31), dtype=_U), np.cumsum(x & _U((1 << 31) - 1), dtype=_U)
        total = (high >> _U(30)) + ((high & _U((1 << 30) - 1)) << _U(31)) + low + out[part.start]
        out[part.start + 1 : part.stop + 1] = _reduced(total)
    return out


def _hashed(upper: np.ndarray, lower: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    gap = upper - lower
    return mix(_product(np.minimum(gap, gap + _U(PRIME)), inverse))


def span_hash(sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hash of values[lo:hi], wherever they stand. Two different spans of n values agree with a chance of about n / 2^61."""
    inverse = powers(len(sums))[1]
    out = np.empty(len(lo), _U)
    for part in _stretches(len(lo)):
        out[part] = _hashed(sums[hi[part]], sums[lo[part]], inverse[lo[part]])
    return out


def window_hash(sums: np.ndarray, width: int) -> np.ndarray:
    """span_hash of every window of `width` values."""
    inverse = powers(len(sums))[1]
    out = np.empty(max(len(sums) - width, 0), _U)
    for part in _stretches(len(out)):
        out[part] = _hashed(sums[part.start + width : part.stop + width], sums[part], inverse[part])
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row and the total): maximal runs of bytes other than space and \\t..\\r."""
    inside = ~_SEPARATOR[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    after = np.empty(n, bool)
    if n:
        before[0] = after[-1] = False
        before[1:] = inside[:-1]
        after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(prefix(BYTE_VALUES[data]), starts, ends)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of `width` values, by block prefixes and suffixes."""
    m = len(values) - width + 1
    if m <= 0:
        return values[:0]
    x = np.concatenate([values, np.full(-len(values) % width, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    left = np.minimum.accumulate(x, axis=1).ravel()
    right = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:m], left[width - 1 : width - 1 + m])


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """data[starts[0]:ends[0]], data[starts[1]:ends[1]], ... joined."""
    sizes = ends - starts
    total = int(sizes.sum())
    if not total:
        return data[:0]
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
    return data[np.arange(total) + shift]


def row_of(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The row that holds each position."""
    return np.searchsorted(offsets, at, "right") - 1
