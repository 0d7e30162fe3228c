"""Vectorised hashing of byte and word sequences with numpy.

A word is hashed from its bytes, eight at a time, each eight mixed into what came before. A sequence of units (bytes or words)
is hashed by prefix sums of unit_value * q**i modulo the prime 2**61 - 1, so that the hash of any stretch is one subtraction
and one multiplication. (Modulo 2**64 there are long periodic words that collide for every q; in a field, two sequences of n
units agree for at most n of all q.) Where only a choice depends on it, `spread` is cheaper. All works in bounded pieces.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
#: Fixed multipliers of the two polynomials and the seed of the byte table.
Q_UNIT, Q_SPREAD, SEED = 0x1A2F5C0D3B97E461, 0x9E3779B97F4A7C13, 20240917
PRIME = U(2**61 - 1)
PIECE = 1 << 18
#: Words of so many bytes at most are hashed in numpy; units whose prefix sums are made at once.
SHORT, CHUNK = 64, 1 << 15

_rng = np.random.default_rng(SEED)
BYTE_VALUE = _rng.integers(1, 2**30, 256, dtype=np.uint32)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_LOW30, _LOW31 = U((1 << 30) - 1), U((1 << 31) - 1)
_powers: dict[int, np.ndarray] = {}


def fold(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME; x is overwritten."""
    high = x >> U(61)
    x &= PRIME
    x += high
    return np.subtract(x, PRIME, out=x, where=x >= PRIME)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number under 2**63 that is a * b modulo PRIME, of numbers under 2**61, by halves of 31 bits; a may have 32-bit units
    under 2**30."""
    bu, bl = b >> U(31), b & _LOW31
    if a.dtype == np.uint32:
        mid, out = a * bu, a * bl
    else:
        au, al = a >> U(31), a & _LOW31
        mid = al * bu
        mid += au * bl
        au *= bu
        au <<= U(1)
        al *= bl
        out = au
        out += al
    out += mid >> U(30)
    mid &= _LOW30
    mid <<= U(31)
    out += mid
    return out


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo PRIME, of numbers under 2**61."""
    return fold(_product(a, b))


def powers(q: int, n: int) -> np.ndarray:
    """q**i modulo PRIME for i < n."""
    have = _powers.get(q, np.ones(1, np.uint64))
    while len(have) < n:
        have = np.concatenate([have, times(have, np.full(1, pow(q, len(have), 2**61 - 1), np.uint64))])
    _powers[q] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (splitmix64's finaliser)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Prefix:
    """Fingerprints of stretches of a unit sequence."""

    def __init__(self, values: np.ndarray, q: int = Q_UNIT):
        n = len(values)
        self.back = pow(q, -1, 2**61 - 1)
        self.sums, forth = np.zeros(n + 1, np.uint64), powers(q, n)
        for lo in range(0, n, CHUNK):
            part = values[lo : lo + CHUNK]
            term = _product(part if part.dtype == np.uint32 else part & PRIME, forth[lo : min(n, lo + CHUNK)])
            high = np.cumsum(term >> U(31))  # under 2**47
            low = np.cumsum(term & _LOW31)
            low += high >> U(30)
            low += (high & _LOW30) << U(31)
            low += self.sums[lo]
            self.sums[lo + 1 : lo + 1 + len(term)] = fold(low)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(times(fold(self.sums[end] + PRIME - self.sums[start]), powers(self.back, len(self.sums))[start]))


@cache
def _wrapping(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Q_SPREAD**i and Q_SPREAD**-i modulo 2**64."""
    forth, back = (np.full(n, U(q)) for q in (Q_SPREAD, pow(Q_SPREAD, -1, 2**64)))
    forth[0] = back[0] = U(1)
    return np.cumprod(forth, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)


def spread(values: np.ndarray, k: int) -> np.ndarray:
    """A number for units i .. i + k - 1 for every i, to choose by: equal stretches have equal numbers, but unequal ones made
    for it may too."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    forth, back = _wrapping(1 << max(12, int(len(values) - 1).bit_length()))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * forth[: len(values)], out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * back[:n])


def raw(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and its len + 1 offsets; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = col.chunk(0)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
    _, offs, data = col.buffers()
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if len(o) == 0:
        o = np.zeros(1, np.int64)
    return d[o[0] : o[-1]], o - o[0]


def groups(offs: np.ndarray, limit: int = PIECE, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `limit` bytes together, at most `rows` of them; a longer row stands alone."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = min(lo + rows, max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1))
        yield lo, min(hi, n)
        lo = min(hi, n)


def in_slices(batches: Iterator[pa.RecordBatch], column: str | int, limit: int = 16 * PIECE) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about `limit` bytes of a column, so that what is made of a slice stays small too."""
    for batch in batches:
        for lo, hi in groups(raw(batch.column(column))[1], limit):
            yield batch.slice(lo, hi - lo)


def tidy(f: Callable) -> Callable:
    """f, a map over batches, giving the memory that it no longer needs back to the system at its end: worker processes live
    on, and what one stage has used would stand beside what the next one needs."""

    def g(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from f(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
                ctypes.CDLL(None).malloc_trim(0)

    return g


def _words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    solid = ~SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    full = np.flatnonzero(offs[1:] > offs[:-1])
    first[offs[:-1][full]] = solid[offs[:-1][full]]
    last[offs[1:][full] - 1] = solid[offs[1:][full] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The fingerprint of each word, from its bytes and its length."""
    size = end - start
    eight = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    full = U(2**64 - 1)
    out = mix(size.astype(np.uint64) + U(SEED))
    open_ = np.flatnonzero(size <= SHORT)
    for at in range(0, SHORT, 8):
        open_ = open_[size[open_] > at]
        if not len(open_):
            break
        rest = np.minimum(size[open_] - at, 8)
        out[open_] = mix(out[open_] ^ (eight[start[open_] + at] & (full >> (U(64) - U(8) * rest.astype(np.uint64)))))
    for i in np.flatnonzero(size > SHORT).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[start[i] : end[i]], SEED)
    return out


def words(data: np.ndarray, offs: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (runs of bytes other than space and \\t \\n \\v \\f \\r) of every row, and each row's first
    word (len + 1). Rows longer than a piece are cut at white space, so memory stays bounded by the piece."""
    out, counts = [], np.zeros(len(offs) - 1, np.int64)
    for lo, hi in groups(offs):
        a, b = int(offs[lo]), int(offs[hi])
        while a < b:
            e = b
            if hi - lo == 1 and b - a > 2 * PIECE:
                gaps = np.flatnonzero(SPACE[data[a + PIECE : b]])
                e = a + PIECE + int(gaps[0]) if len(gaps) else b
            part = data[a:e]
            if lower:
                part = LOWER[part]
            o = offs[lo : hi + 1] - offs[lo] if e == b and a == offs[lo] else np.array([0, e - a])
            s, t, at = _words(part, o)
            out.append(word_hashes(part, s, t))
            counts[lo:hi] += at[1:] - at[:-1]
            a = e
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(counts)])


def sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """min(v[i : i + w]) for every i."""
    p, m = 1, v
    while 2 * p <= w:
        m = np.minimum(m[:-p], m[p:])
        p *= 2
    return np.minimum(m[: len(v) - w + 1], m[w - p : w - p + len(v) - w + 1]) if p < w else m


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
