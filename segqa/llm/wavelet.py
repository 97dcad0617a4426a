"""A wavelet matrix over whole numbers: counts and order statistics of any range, many at a time."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    def __init__(self, values: np.ndarray):
        """``values`` are not negative; one level for each of their bits, the highest first."""
        values = np.asarray(values, np.int64)
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros = np.empty((self.bits, len(values) + 1), np.int32)  # before each place
        for level, shift in enumerate(range(self.bits - 1, -1, -1)):
            one = (values >> shift & 1).astype(bool)
            self.zeros[level, 0] = 0
            np.cumsum(~one, out=self.zeros[level, 1:])
            values = np.concatenate([values[~one], values[one]])

    def less(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values at ``left <= place < right`` lie below ``bound`` (itself a stored value)."""
        count = np.zeros(len(left), np.int64)
        left, right = left.astype(np.int64), right.astype(np.int64)
        for zeros, shift in zip(self.zeros, range(self.bits - 1, -1, -1)):
            a, b = zeros[left].astype(np.int64), zeros[right].astype(np.int64)
            one = (bound >> shift & 1).astype(bool)
            count += np.where(one, b - a, 0)
            left = np.where(one, left - a + zeros[-1], a)
            right = np.where(one, right - b + zeros[-1], b)
        return count

    def nth(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of ``rank`` (from 0, below the range's size) among a range's sorted values."""
        value = np.zeros(len(left), np.int64)
        left, right, rank = (x.astype(np.int64) for x in (left, right, rank))
        for zeros, shift in zip(self.zeros, range(self.bits - 1, -1, -1)):
            a, b = zeros[left].astype(np.int64), zeros[right].astype(np.int64)
            one = rank >= b - a
            value |= one.astype(np.int64) << shift
            rank = np.where(one, rank - (b - a), rank)
            left = np.where(one, left - a + zeros[-1], a)
            right = np.where(one, right - b + zeros[-1], b)
        return value
