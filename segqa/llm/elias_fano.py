"""Monotone integer sequences in Elias-Fano form, searched in whole arrays.

Each value is split: the low bits stand packed side by side, the high parts as a bit string in which
the i-th one lies at position ``high + i``. That is about ``2 + log2(universe / n)`` bits a value. A
sequence is one array of 64-bit words, used as it lies in a file.

Layout in words: n, universe, low width, number of low words, number of high words, number of
samples; low words; high words; ones before every fourth high word.
"""

from __future__ import annotations

import numpy as np

_HEAD = 6
_ONE = np.uint64(1)
_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1
# place of the k-th one in a byte, at byte * 8 + k; a byte with fewer is never asked
_IN_BYTE = np.argsort(1 - _BITS, axis=1, kind="stable").ravel()


def encode(values: np.ndarray) -> np.ndarray:
    """``values`` (unsigned 64-bit, not decreasing) as words."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    universe = int(values[-1]) + 1 if n else 1
    width = max(0, (universe // max(n, 1)).bit_length() - 1)
    low = values & np.uint64((1 << width) - 1)
    low_words = np.zeros(n * width // 64 + 2, np.uint64)
    if width:
        at = np.arange(n, dtype=np.uint64) * np.uint64(width)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        # at most one value reaches over from a word into the next
        over = shift + np.uint64(width) > 64
        low_words[word[over] + 1] = low[over] >> (np.uint64(64) - shift[over])
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if n else word
        if n:
            low_words[word[first]] |= np.bitwise_or.reduceat(low << shift, first)
    ones = (values >> np.uint64(width)) + np.arange(n, dtype=np.uint64)
    last = int(ones[-1]) if n else 0
    bits = np.zeros((last // 256 + 1) * 256 + 256, np.uint8)
    bits[ones.astype(np.int64)] = 1
    high_words = np.packbits(bits, bitorder="little").view(np.uint64)
    counts = np.bitwise_count(high_words).astype(np.uint64)
    samples = np.concatenate([[0], np.cumsum(counts.reshape(-1, 4).sum(axis=1))]).astype(np.uint64)
    head = [n, universe, width, len(low_words), len(high_words), len(samples)]
    return np.concatenate([np.array(head, np.uint64), low_words, high_words, samples])


class EliasFano:
    """Random access and successor search over the words of one sequence."""

    def __init__(self, words: np.ndarray):
        n, universe, width, low, high, samples = (int(x) for x in words[:_HEAD])
        self.n, self.universe, self.width = n, universe, width
        at = np.cumsum([_HEAD, low, high, samples])
        self.low, self.high = words[at[0] : at[1]], words[at[1] : at[2]]
        self.ones = words[at[2] : at[3]].astype(np.int64)
        self.zeros = np.arange(len(self.ones)) * 256 - self.ones
        self.size = int(at[3])

    def _lows(self, index: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(index), np.uint64)
        at = index.astype(np.uint64) * np.uint64(self.width)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        value = self.low[word] >> shift
        # a shift by 64 is undefined, so the next word moves in two steps
        value |= self.low[word + 1] << (np.uint64(63) - shift) << _ONE
        return value & np.uint64((1 << self.width) - 1)

    def _select(self, k: np.ndarray, bit: int) -> np.ndarray:
        """Position of the ``k``-th (from 0) one or zero in the high bits."""
        before = self.ones if bit else self.zeros
        block = np.searchsorted(before, k, side="right") - 1
        rest = k - before[block]
        word = block * 4
        for _ in range(3):  # at most three words on
            count = self._count(word, bit)
            step = rest >= count
            rest -= count * step
            word += step
        value = self.high[word] if bit else ~self.high[word]
        place = word * 64
        for half in (32, 16, 8):
            count = np.bitwise_count(value & np.uint64((1 << half) - 1)).astype(np.int64)
            step = rest >= count
            rest -= count * step
            place += step * half
            value >>= step * np.uint64(half)
        return place + _IN_BYTE[(value & np.uint64(255)).astype(np.int64) * 8 + rest]

    def _next(self, place: np.ndarray, k: np.ndarray, bit: int) -> np.ndarray:
        """Position of the ``k``-th one or zero where that before it lies at ``place``."""
        after = place + 1
        word = after >> 6
        value = self.high[word] if bit else ~self.high[word]
        value >>= (after & 63).astype(np.uint64)
        out = after + np.bitwise_count((value & -value) - _ONE)
        if (far := np.flatnonzero(value == 0)).size:  # beyond this word
            out[far] = self._select(k[far], bit)
        return out

    def _count(self, word: np.ndarray, bit: int) -> np.ndarray:
        count = np.bitwise_count(self.high[word]).astype(np.int64)
        return count if bit else 64 - count

    def access(self, index: np.ndarray) -> np.ndarray:
        index = np.asarray(index, np.int64)
        high = (self._select(index, 1) - index).astype(np.uint64)
        return (high << np.uint64(self.width)) | self._lows(index)

    def access_pair(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The elements at ``index`` and one behind."""
        index = np.asarray(index, np.int64)
        place = self._select(index, 1)
        width = np.uint64(self.width)
        first = (place - index).astype(np.uint64) << width | self._lows(index)
        place = self._next(place, index + 1, 1)
        return first, (place - index - 1).astype(np.uint64) << width | self._lows(index + 1)

    def _bucket(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bounds of the elements with the same high part as each value, and the values' low bits."""
        high = (values >> np.uint64(self.width)).astype(np.int64)
        # they lie between two zeros
        before = self._select(np.maximum(high - 1, 0), 0)
        after = np.where(high > 0, self._next(before, np.maximum(high, 1), 0), before)
        left = np.where(high > 0, before - high + 1, 0)
        right = np.minimum(after - high, self.n)
        return left, right, values & np.uint64((1 << self.width) - 1)

    def _descend(self, left: np.ndarray, right: np.ndarray, low: np.ndarray) -> np.ndarray:
        """First index in each bucket whose low bits are not below ``low``."""
        left, right = left.copy(), right.copy()
        while (open_ := np.flatnonzero(left < right)).size:
            middle = (left[open_] + right[open_]) // 2
            less = self._lows(middle) < low[open_]
            left[open_] = np.where(less, middle + 1, left[open_])
            right[open_] = np.where(less, right[open_], middle)
        return left

    def successor(self, values: np.ndarray) -> np.ndarray:
        """Index of the first element that is at least each value; ``n`` if there is none."""
        values = np.asarray(values, np.uint64)
        if not self.n:
            return np.zeros(len(values), np.int64)
        beyond = values >= np.uint64(self.universe)
        capped = np.where(beyond, np.uint64(self.universe - 1), values)
        return np.where(beyond, self.n, self._descend(*self._bucket(capped)))

    def find(self, values: np.ndarray) -> np.ndarray:
        """Index of each value, -1 where it is not an element."""
        values = np.asarray(values, np.uint64)
        if not self.n:
            return np.full(len(values), -1)
        inside = values < np.uint64(self.universe)
        left, right, low = self._bucket(np.where(inside, values, np.uint64(0)))
        at = self._descend(left, right, low)
        hit = inside & (at < right)
        rows = np.flatnonzero(hit)
        hit[rows] = self._lows(at[rows]) == low[rows]  # the high part is that of the bucket
        return np.where(hit, at, -1)


def decode(words: np.ndarray) -> np.ndarray:
    """All values of an encoded sequence."""
    sequence = EliasFano(words)
    index = np.arange(sequence.n)
    ones = np.flatnonzero(np.unpackbits(sequence.high.view(np.uint8), bitorder="little"))
    high = (ones[: sequence.n] - index).astype(np.uint64) << np.uint64(sequence.width)
    return high | sequence._lows(index)
