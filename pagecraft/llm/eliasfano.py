"""Elias-Fano sequences in one memory-mapped buffer, and a trie of n-gram levels made of them."""

from __future__ import annotations

import tempfile

import numpy as np

_COUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_SELECT = np.zeros((256, 8), np.uint8)
for _b in range(256):
    for _k, _p in enumerate([p for p in range(8) if _b >> p & 1]):
        _SELECT[_b, _k] = _p
#: Bytes of the upper bits between two kept ranks.
BLOCK = 32


class EliasFano:
    """A non-decreasing sequence: low bits packed, upper bits in unary, with a rank for each block of them."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, ranks: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.ranks = n, low_bits, low, high, ranks

    @staticmethod
    def parts(values: np.ndarray, universe: int) -> tuple[int, int, np.ndarray, np.ndarray, np.ndarray]:
        n = len(values)
        low_bits = max(0, int(np.floor(np.log2(max(universe, 1) / max(n, 1)))) if n else 0)
        values = values.astype(np.uint64)
        upper = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(((int(upper[-1]) if n else 0) // (8 * BLOCK) + 1) * 8 * BLOCK, bool)
        bits[upper] = True
        high = np.packbits(bits, bitorder="little")
        ranks = np.concatenate([[0], np.cumsum(_COUNT[high].reshape(-1, BLOCK).sum(axis=1, dtype=np.int64))])
        words = np.zeros(n * low_bits // 64 + 2, np.uint64)
        if low_bits:
            part = values & np.uint64((1 << low_bits) - 1)
            at = np.arange(n, dtype=np.uint64) * np.uint64(low_bits)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            np.bitwise_or.at(words, word, part << shift)
            over = (shift + np.uint64(low_bits)) > np.uint64(64)
            np.bitwise_or.at(words, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        return n, low_bits, words, high, ranks

    def get(self, i: np.ndarray) -> np.ndarray:
        """values[i], by selecting the i-th one of the upper bits."""
        i = np.asarray(i, np.int64)
        block = np.searchsorted(self.ranks, i, "right") - 1
        left = i - self.ranks[block]
        inside = self.high[block[:, None] * BLOCK + np.arange(BLOCK)]
        sums = np.cumsum(_COUNT[inside], axis=1, dtype=np.int16)
        byte = (sums <= left[:, None]).sum(axis=1)
        rows = np.arange(len(i))
        before = np.where(byte > 0, sums[rows, np.maximum(byte - 1, 0)], 0)
        place = (block * BLOCK + byte) * 8 + _SELECT[inside[rows, byte], left - before]
        high = (place - i).astype(np.uint64) << np.uint64(self.low_bits)
        return high | self.low_part(i)

    def low_part(self, i: np.ndarray) -> np.ndarray:
        """The low bits of values[i]."""
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        low = self.low[word] >> shift
        low |= np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return low & np.uint64((1 << self.low_bits) - 1)

    def below(self, high: np.ndarray) -> np.ndarray:
        """How many values have upper bits under high: the ones ahead of that many zeros."""
        gaps = np.arange(len(self.ranks), dtype=np.int64) * (8 * BLOCK) - self.ranks
        goal = np.minimum(high, gaps[-1])
        block = np.maximum(np.searchsorted(gaps, goal, "left") - 1, 0)
        left = goal - gaps[block]
        inside = ~self.high[block[:, None] * BLOCK + np.arange(BLOCK)]
        sums = np.cumsum(_COUNT[inside], axis=1, dtype=np.int16)
        byte = np.minimum((sums < left[:, None]).sum(axis=1), BLOCK - 1)
        rows = np.arange(len(goal))
        before = np.where(byte > 0, sums[rows, np.maximum(byte - 1, 0)], 0)
        place = (block * BLOCK + byte) * 8 + _SELECT[inside[rows, byte], np.maximum(left - before - 1, 0)]
        return np.where(high > 0, np.minimum(place - goal + 1, self.n), 0)


class Buffer:
    """Arrays written one after another to an unlinked temporary file and mapped back read-only."""

    def __init__(self):
        self.file = tempfile.TemporaryFile()
        self.size = 0

    def put(self, a: np.ndarray) -> tuple[int, np.dtype, int]:
        pad = -self.size % 8
        self.file.write(b"\0" * pad)
        self.size += pad
        where = (self.size, a.dtype, len(a))
        self.file.write(np.ascontiguousarray(a).data)
        self.size += a.nbytes
        return where

    def mapped(self):
        self.file.flush()
        self.file.write(b"\0" * 8)
        self.file.flush()
        data = np.memmap(self.file, np.uint8, "r")
        return lambda where: data[where[0] : where[0] + where[2] * where[1].itemsize].view(where[1])

    def close(self) -> None:
        self.file.close()


class Trie:
    """Two levels: first words by rank, and under each its neighbours, with a quantised value for both. The steps of a level
    span the least to the largest of its own values, so none is clipped, however small.

    The neighbours' identifiers restart under each word; the sum of all earlier ranges' spans is added, so that one
    Elias-Fano sequence holds them all, and is taken off again when a range is searched."""

    STEPS = 65535

    def __init__(self, first: np.ndarray, counts: np.ndarray, second: np.ndarray, value1: np.ndarray, value2: np.ndarray, span: int):
        """first: sorted words; counts: neighbours of each; second: neighbours, ascending under each word."""
        self.span, self.n = span, len(first)
        pointers = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
        rank = np.repeat(np.arange(len(first)), counts)
        held = Buffer()
        spec = [EliasFano.parts(pointers, int(pointers[-1]) + 1), EliasFano.parts(second.astype(np.int64) + rank * span, len(first) * span)]
        where = [(s[0], s[1], *[held.put(a) for a in s[2:]]) for s in spec]
        (self.scale1, steps1), (self.scale2, steps2) = self._quantised(value1), self._quantised(value2)
        keys, q1, q2 = held.put(first), held.put(steps1), held.put(steps2)
        at = held.mapped()
        self.pointers, self.second = (EliasFano(w[0], w[1], *[at(a) for a in w[2:]]) for w in where)
        self.first, self.value1, self.value2 = at(keys), at(q1), at(q2)
        self.bytes, self.held = held.size, held

    def _quantised(self, v: np.ndarray) -> tuple[tuple[float, float], np.ndarray]:
        """((least value, size of a step), steps above the least) of the values."""
        low, high = (float(v.min()), float(v.max())) if len(v) else (0.0, 0.0)
        step = (high - low) / self.STEPS or 1.0
        return (low, step), np.round((v - low) / step).astype(np.uint16)

    @staticmethod
    def _value(q: np.ndarray, scale: tuple[float, float]) -> np.ndarray:
        return scale[0] + q * scale[1]

    def find(self, word: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rank of the word or -1, log10 value of the pair or NaN, log10 value of the word or NaN)."""
        rank = np.minimum(np.searchsorted(self.first, word), max(self.n - 1, 0)) if self.n else np.zeros(len(word), np.int64)
        known = self.first[rank] == word if self.n else np.zeros(len(word), bool)
        pair = np.full(len(word), np.nan)
        single = np.where(known, self._value(self.value1[rank], self.scale1), np.nan) if self.n else pair.copy()
        at = np.flatnonzero(known)
        # Each word's range once, for neighbours that ask under the same word one after another.
        head = np.flatnonzero(np.diff(rank[at], prepend=-1))
        times = np.diff(np.append(head, len(at)))
        low = np.repeat(self.pointers.get(rank[at][head]).astype(np.int64), times)
        end = np.repeat(self.pointers.get(rank[at][head] + 1).astype(np.int64), times)
        goal = other[at].astype(np.int64) + rank[at] * self.span
        # Successor search: within the word's range, those with the goal's upper bits, then by halves over their low bits.
        upper = goal >> self.second.low_bits
        low = np.maximum(low, np.minimum(self.second.below(upper), end))
        high = np.maximum(low, np.minimum(self.second.below(upper + 1), end))
        part = goal.astype(np.uint64) & np.uint64((1 << self.second.low_bits) - 1)
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) // 2
            below = self.second.low_part(middle) < part[open_]
            low[open_] = np.where(below, middle + 1, low[open_])
            high[open_] = np.where(below, high[open_], middle)
            open_ = open_[low[open_] < high[open_]]
        inside = np.flatnonzero(low < end)
        hit = inside[self.second.get(low[inside]).astype(np.int64) == goal[inside]]
        pair[at[hit]] = self._value(self.value2[low[hit]], self.scale2)
        return np.where(known, rank, -1), pair, single

    def close(self) -> None:
        del self.pointers, self.second, self.first, self.value1, self.value2
        self.held.close()


