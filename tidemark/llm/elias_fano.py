"""Elias-Fano sequences of ascending numbers, and the n-gram trie made of them."""

from __future__ import annotations

import numpy as np

_BITS = np.array([[b >> k & 1 for k in range(8)] for b in range(256)], np.uint8)
_COUNT = _BITS.sum(axis=1).astype(np.uint8)
# Place of the r-th one of a byte.
_SELECT = np.zeros((256, 8), np.uint8)
for _b in range(256):
    _SELECT[_b, : _COUNT[_b]] = np.flatnonzero(_BITS[_b])


def _in_word(words: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Place of the r-th one, from 0, of each 64-bit word."""
    parts = words.view(np.uint8).reshape(-1, 8)
    upto = np.cumsum(_COUNT[parts], axis=1, dtype=np.int64)
    byte = (upto <= r[:, None]).sum(axis=1)
    row = np.arange(len(words))
    before = np.where(byte > 0, upto[row, byte - 1], 0)
    return byte * 8 + _SELECT[parts[row, byte], r - before]


class EliasFano:
    """Numbers in two parts: low bits packed side by side, high parts in unary.

    ``ones`` and ``zeros`` count, before each 64-bit word of the unary part, what
    ``select`` skips. Arrays may be memory-mapped; nothing is unpacked as a whole.
    """

    FIELDS = ("low", "high", "ones", "zeros", "shape")

    def __init__(self, low, high, ones, zeros, shape):
        self.low, self.high, self.ones, self.zeros, self.shape = low, high, ones, zeros, shape
        self.n, self.width, self.universe = (int(x) for x in shape)

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> "EliasFano":
        """``values`` ascend and lie below ``universe``."""
        values = np.asarray(values, np.uint64)
        n = len(values)
        width = max(0, (universe // max(n, 1)).bit_length() - 1)
        places = (values >> np.uint64(width)) + np.arange(n, dtype=np.uint64)
        words = (int(universe) >> width) + n + 1
        bits = np.zeros((words // 64 + 1) * 64, np.uint8)
        bits[places.astype(np.int64)] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        counts = _COUNT[high.view(np.uint8).reshape(-1, 8)].sum(axis=1, dtype=np.int64)
        ones = np.concatenate(([0], np.cumsum(counts)))
        zeros = np.arange(len(ones)) * 64 - ones
        low = np.zeros(n * width // 64 + 2, np.uint64)
        if width and n:
            at = np.arange(n, dtype=np.uint64) * np.uint64(width)
            word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            rest = values & np.uint64((1 << width) - 1)
            np.bitwise_or.at(low, word, rest << shift)
            over = np.flatnonzero(shift + np.uint64(width) > np.uint64(64))
            np.bitwise_or.at(low, word[over] + 1, rest[over] >> (np.uint64(64) - shift[over]))
        return cls(low, high, ones.astype(np.uint32), zeros.astype(np.uint32), np.array([n, width, universe]))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * np.uint64(self.width)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        out = self.low[word] >> shift
        spill = self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63))
        return (out | np.where(shift > 0, spill, np.uint64(0))) & np.uint64((1 << self.width) - 1)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The i-th numbers."""
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.ones, i, "right") - 1
        place = word * 64 + _in_word(self.high[word], i - self.ones[word])
        return ((place - i).astype(np.uint64) << np.uint64(self.width)) | self._low(i)

    def _before(self, h: np.ndarray) -> np.ndarray:
        """How many numbers have a high part below ``h``: the ones before the h-th zero."""
        out = np.zeros(len(h), np.int64)
        some = np.flatnonzero(h > 0)
        zero = h[some] - 1
        word = np.searchsorted(self.zeros, zero, "right") - 1
        out[some] = word * 64 + _in_word(~self.high[word], zero - self.zeros[word]) - zero
        return out

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of each ``x``, or -1: of the numbers with its high part, by low part."""
        x = np.asarray(x, np.uint64)
        out = np.full(len(x), -1, np.int64)
        if not self.n or not len(x):
            return out
        some = np.flatnonzero(x < np.uint64(self.universe))
        high = (x[some] >> np.uint64(self.width)).astype(np.int64)
        low = x[some] & np.uint64((1 << self.width) - 1)
        at, end = self._before(high), self._before(high + 1)
        last = end.copy()
        # Halving: a context with very many successors has long runs of one high part.
        open_ = np.flatnonzero(at < end)
        while len(open_):
            middle = (at[open_] + end[open_]) >> 1
            below = self._low(middle) < low[open_]
            at[open_] = np.where(below, middle + 1, at[open_])
            end[open_] = np.where(below, end[open_], middle)
            open_ = open_[at[open_] < end[open_]]
        there = np.flatnonzero(at < last)
        there = there[self._low(at[there]) == low[there]]
        out[some[there]] = at[there]
        return out

    def arrays(self, name: str) -> dict[str, np.ndarray]:
        return {f"{name}.{f}": getattr(self, f) for f in self.FIELDS}

    @classmethod
    def load(cls, arrays: dict[str, np.ndarray], name: str) -> "EliasFano":
        return cls(*[arrays[f"{name}.{f}"] for f in cls.FIELDS])
