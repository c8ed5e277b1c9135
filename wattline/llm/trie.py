"""Elias-Fano coded levels of an n-gram trie, memory-mapped.

A level of m contexts holds, for each, its successors in order of their 32-bit
word ids.  ``context rank * 2**32 + word id`` is one increasing sequence, so
both the contexts, the pointers to their successors and the successors
themselves are Elias-Fano sequences.  Looking up a word is a successor search
inside its context's part.  Probabilities are 16-bit codes of -log2.
"""

from __future__ import annotations

import tempfile

import numpy as np

U = np.uint64
STEP = 1024.0       # codes per halving of a probability
ABSENT = 0xFFFF

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
POPCOUNT = _BITS.sum(axis=1).astype(np.int64)
#: NTH[byte, r]: place of the r-th set bit of a byte.
NTH = np.full((256, 8), 8, np.int64)
for _b in range(256):
    _places = np.flatnonzero(_BITS[_b])
    NTH[_b, :len(_places)] = _places


class Sequence:
    """Elias-Fano form of non-decreasing 64-bit values: low bits packed, high bits in unary."""

    def __init__(self, low: np.ndarray, high: np.ndarray, ones: np.ndarray, width: int, size: int):
        self.low, self.high, self.ones, self.width, self.size = low, high, ones, width, size
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones.astype(np.int64)

    @staticmethod
    def build(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
        """(packed low bits, high bits, ones before each word of the high bits, low width, size)."""
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // max(n, 1)).bit_length() - 1)
        low = np.zeros(2, U)
        if width and n:
            bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")[:, :width]
            packed = np.packbits(bits.ravel(), bitorder="little")
            low = np.zeros(len(packed) // 8 + 2, U)
            low.view(np.uint8)[:len(packed)] = packed
        upper = (values >> U(width)).astype(np.int64)
        flags = np.zeros((n + (top >> width) + 1 + 64) // 64 * 64 + 64, np.uint8)
        flags[upper + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view(U)
        ones = np.concatenate([[0], np.cumsum(flags.reshape(-1, 64).sum(axis=1, dtype=np.int64))])
        return low, high, ones.astype(np.uint32), width, n

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), U)
        at = i * self.width
        word, shift = at >> 6, (at & 63).astype(U)
        got = self.low[word] >> shift
        over = np.flatnonzero(shift)
        got[over] |= self.low[word[over] + 1] << (U(64) - shift[over])
        return got & U((1 << self.width) - 1)

    def upto(self, k: np.ndarray) -> np.ndarray:
        """How many values have a high part of at most k (-1: none)."""
        word = np.searchsorted(self.zeros, k, "right") - 1
        rest = np.maximum(k - self.zeros[word], 0)
        holes = np.ascontiguousarray(~self.high[np.minimum(word, len(self.high) - 1)]).view(np.uint8).reshape(-1, 8)
        running = np.cumsum(POPCOUNT[holes], axis=1)
        byte = (running <= rest[:, None]).sum(axis=1)
        byte = np.minimum(byte, 7)
        line = np.arange(len(k))
        before = np.where(byte > 0, running[line, byte - 1], 0)
        place = word * 64 + byte * 8 + NTH[holes[line, byte], np.minimum(rest - before, 7)]
        return np.where(k < 0, 0, np.minimum(place - k, self.size))

    def values(self, i: np.ndarray) -> np.ndarray:
        """The values at places i."""
        word = np.searchsorted(self.ones, i, "right") - 1
        rest = i - self.ones[word].astype(np.int64)
        filled = np.ascontiguousarray(self.high[word]).view(np.uint8).reshape(-1, 8)
        running = np.cumsum(POPCOUNT[filled], axis=1)
        byte = np.minimum((running <= rest[:, None]).sum(axis=1), 7)
        line = np.arange(len(i))
        before = np.where(byte > 0, running[line, byte - 1], 0)
        place = word * 64 + byte * 8 + NTH[filled[line, byte], np.minimum(rest - before, 7)]
        return ((place - i).astype(U) << U(self.width)) | self.lows(i)

    def successor(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first value not less than x, whether it equals x)."""
        upper = np.minimum(x >> U(self.width), U(1 << 62)).astype(np.int64)
        want = x & U((1 << self.width) - 1)
        last = self.zeros[-1] - 1
        a = self.upto(np.minimum(upper - 1, last))
        b = self.upto(np.minimum(upper, last))
        low, high = a.copy(), b.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) // 2
            less = self.lows(mid) < want[open_]
            low[open_[less]] = mid[less] + 1
            high[open_[~less]] = mid[~less]
        hit = low < b
        near = np.flatnonzero(hit)
        hit[near] = self.lows(low[near]) == want[near]
        return low, hit


class Trie:
    """Two levels over one memory-mapped file: contexts, then their successors with codes.

    context: sorted distinct 64-bit context hashes; count: successors of each;
    word: 32-bit ids, increasing within a context; probability: of each
    successor in its context."""

    def __init__(self, context: np.ndarray, count: np.ndarray, word: np.ndarray, probability: np.ndarray):
        rank = np.repeat(np.arange(len(context), dtype=U), count)
        pointer = np.concatenate([[0], np.cumsum(count)]).astype(U)
        code = np.clip(np.rint(-np.log2(probability) * STEP), 0, ABSENT - 1).astype(np.uint16)
        levels = [Sequence.build(v) for v in (context, pointer, (rank << U(32)) | word.astype(U))]
        arrays = [a for level in levels for a in level[:3]] + [code]
        self.file = tempfile.TemporaryFile()  # goes when the trie goes
        places, at = [], 0
        for a in arrays:
            self.file.write(a.tobytes())
            self.file.write(bytes(-a.nbytes % 8))
            places.append(at)
            at += a.nbytes + (-a.nbytes % 8)
        self.file.flush()
        self.bytes = at
        views = [np.memmap(self.file, a.dtype, "r", p, a.shape) if a.size else a for a, p in zip(arrays, places, strict=True)]
        self.contexts, self.pointers, self.successors = (
            Sequence(*views[3 * i:3 * i + 3], *level[3:]) for i, level in enumerate(levels))
        self.code = views[-1]

    def codes(self, context: np.ndarray, count: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Code of each word after its context (``count`` words for each context); ABSENT where unseen."""
        out = np.full(len(word), ABSENT, np.uint16)
        if not len(self.code) or not len(word):
            return out
        rank, known = self.contexts.successor(context)
        rank, known = np.repeat(rank, count), np.repeat(known, count)
        ask = np.flatnonzero(known)
        place, hit = self.successors.successor((rank[ask].astype(U) << U(32)) | word[ask].astype(U))
        ask, place, rank = ask[hit], place[hit], rank[ask][hit]
        begin = self.pointers.values(rank)
        inside = place.astype(U) >= begin  # the context's own part
        out[ask[inside]] = self.code[place[inside]]
        return out


def probability(code: np.ndarray) -> np.ndarray:
    """What a code stands for; 0 for ABSENT."""
    return np.where(code == ABSENT, 0.0, np.exp2(-code.astype(np.float64) / STEP))
