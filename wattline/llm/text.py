"""Numpy views of text columns: bytes, words and rolling 64-bit hashes.

A word is ``[^\\x20\\x09-\\x0D]+``.  All separators are single ASCII bytes, so
words are found on UTF-8 bytes.  Hashes are 64 bits wide: a random
substitution per byte, a polynomial, then an avalanche mix.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1
CHUNK = 1 << 20  # bytes hashed at once (bounds temporary arrays)


def byte_tables():
    """(separator?, random 64-bit value per byte, the same after lower-casing A-Z)."""
    sep = np.zeros(256, bool)
    sep[[0x20, 9, 10, 11, 12, 13]] = True
    rnd = np.random.default_rng(20240917).integers(0, 2**63, 256, dtype=np.int64).astype(U) * U(2) + U(1)
    low = np.arange(256)
    low[65:91] += 32
    return sep, rnd, rnd[low]


SEP, RND, RND_LOW = byte_tables()
CONT = (np.arange(256) & 0xC0) == 0x80  # UTF-8 continuation bytes


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, U)
    out[:1] = 1
    return np.multiply.accumulate(out)


def power(base: int, n: int) -> np.uint64:
    return U(pow(base, n, 1 << 64))


POW = powers(BASE, CHUNK)
INV = powers(pow(BASE, -1, 1 << 64), CHUNK)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    arr = column.cast(pa.large_binary())
    if arr.null_count:
        arr = arr.fill_null(b"")
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + n + 1]
    data = arr.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return buf, off - off[0]


def slices(off: np.ndarray, limit: int):
    """Ranges of rows holding at most ``limit`` bytes each (one row at least)."""
    a, n = 0, len(off) - 1
    while a < n:
        b = int(np.searchsorted(off, off[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def words(buf: np.ndarray, off: np.ndarray, lower: bool = False):
    """(start, end, row, hash, code points) of every word, in order.

    Works through chunks that end at separators, so that temporary arrays
    stay small for very long texts."""
    n, table = len(buf), RND_LOW if lower else RND
    first = np.zeros(n + 1, bool)
    first[off[:-1]] = True
    out, a = [], 0
    while a < n:
        b = min(a + CHUNK, n)
        while b < n:  # end at a separator or at a row's start
            tail = buf[b:b + 4096]
            stop = np.flatnonzero(SEP[tail] | first[b:b + len(tail)])
            if len(stop):
                b += int(stop[0])
                break
            b += len(tail)
        out.append(_chunk(buf, a, b, first, table))
        a = b
    if out:
        s, e, h, c = (np.concatenate(x) for x in zip(*out, strict=True))
    else:
        s, e, h, c = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U), np.zeros(0, np.int64)
    return s, e, np.searchsorted(off, s, "right") - 1, h, c


def _chunk(buf, a, b, first, table):
    x = buf[a:b]
    word = ~SEP[x]
    begin = word.copy()
    begin[1:] &= ~word[:-1] | first[a + 1:b]
    end = word.copy()
    end[:-1] &= ~word[1:] | first[a + 1:b]
    s, e = np.flatnonzero(begin), np.flatnonzero(end) + 1
    n = b - a
    pw, inv = (POW, INV) if n <= CHUNK else (powers(BASE, n), powers(pow(BASE, -1, 1 << 64), n))
    total = np.zeros(n + 1, U)
    np.cumsum(table[x] * pw[:n], out=total[1:])
    h = mix((total[e] - total[s]) * inv[s] + (e - s).astype(U) * U(0xD6E8FEB86659FD93))
    points = np.zeros(n + 1, np.int32)
    np.cumsum(~CONT[x], out=points[1:])
    return s + a, e + a, h, (points[e] - points[s]).astype(np.int64)


def count_words(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Words of each row."""
    word = ~SEP[buf]
    word[1:] &= SEP[buf[:-1]]
    first = off[:-1][np.diff(off) > 0]
    word[first] = ~SEP[buf[first]]
    total = np.concatenate([[0], np.cumsum(word, dtype=np.int64)])
    return np.diff(total[off])


def grams(h: np.ndarray, row: np.ndarray, n: int):
    """(position, hash) of every run of n consecutive words inside one row."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    pos = np.flatnonzero(row[:m] == row[n - 1:])
    return pos, mix(rolling(h, n)[pos])


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every n consecutive values, by doubling."""
    total, width, block, size = None, 0, h, 1
    m, rest = len(h) - n + 1, n
    while rest:
        if rest & 1:
            if total is None:
                total, width = block[:m + n - size], size
            else:
                k = len(h) - (width + size) + 1
                total = total[:k] * power(BASE, size) + block[width:width + k]
                width += size
        rest >>= 1
        if rest:
            k = len(h) - 2 * size + 1
            block = block[:k] * power(BASE, size) + block[size:size + k]
            size *= 2
    return total[:m]


def repeated(key: np.ndarray) -> np.ndarray:
    """True where a value occurs more than once."""
    if len(key) == 0:
        return np.zeros(0, bool)
    order = np.argsort(key)
    k = key[order]
    same = k[1:] == k[:-1]
    dup = np.zeros(len(k), bool)
    dup[1:] |= same
    dup[:-1] |= same
    out = np.empty(len(k), bool)
    out[order] = dup
    return out


def later(key: np.ndarray) -> np.ndarray:
    """True where a value has occurred before."""
    if len(key) == 0:
        return np.zeros(0, bool)
    order = np.argsort(key)
    k = key[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    out = np.ones(len(k), bool)
    out[np.minimum.reduceat(order, np.flatnonzero(new))] = False
    return out


def per_row(values, row: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``values`` by row, as int64."""
    return np.bincount(row, weights=values, minlength=n).astype(np.int64) if len(row) else np.zeros(n, np.int64)


def binary_column(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())
