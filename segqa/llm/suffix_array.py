"""Suffix arrays by difference cover, in whole-array steps.

The suffixes at positions that are not multiples of three are named by their first three symbols in
sorted order; where names repeat, the string of names is sorted the same way. The remaining suffixes
follow from a symbol and the rank behind it, and are merged in.
"""

from __future__ import annotations

import numpy as np


def _rank_pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Dense ranks, from 1, of pairs of non-negative numbers."""
    span = int(second.max(initial=0)) + 1
    keys = first.astype(np.int64) * span + second
    return np.unique(keys, return_inverse=True)[1].astype(np.int64) + 1


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes of ``text`` (numbers from 1 to its length or so) in order."""
    n = len(text)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: tuple(text[i:])), np.int64)
    padded = np.concatenate([text, np.zeros(4, np.int64)])
    # one suffix more at the end keeps the halves of the recursive string apart
    extra = n % 3 == 1
    ones, twos = np.arange(1, n + extra, 3), np.arange(2, n + extra, 3)
    sample = np.concatenate([ones, twos])
    names = _rank_pairs(
        _rank_pairs(padded[sample], padded[sample + 1]), padded[sample + 2]
    )
    if int(names.max()) == len(sample):
        order = np.argsort(names)
    else:
        order = suffix_array(names)
    rank = np.zeros(n + 4, np.int64)
    ranked = sample[order]
    rank[ranked] = np.arange(1, len(sample) + 1)
    ranked = ranked[ranked < n]

    zeros = np.arange(0, n, 3)
    width = len(sample) + 2
    zeros = zeros[np.argsort(padded[zeros] * width + rank[zeros + 1], kind="stable")]
    # how many sampled suffixes of either kind come before each of the others
    in_ones, in_twos = ranked[ranked % 3 == 1], ranked[ranked % 3 == 2]
    before = np.searchsorted(
        padded[in_ones] * width + rank[in_ones + 1], padded[zeros] * width + rank[zeros + 1]
    )
    both = np.concatenate([in_twos, zeros])
    pair = _rank_pairs(padded[both], padded[both + 1])
    before += np.searchsorted(
        pair[: len(in_twos)] * width + rank[in_twos + 2],
        pair[len(in_twos) :] * width + rank[zeros + 2],
    )
    out = np.empty(n, np.int64)
    at = before + np.arange(len(zeros))
    out[at] = zeros
    rest = np.ones(n, bool)
    rest[at] = False
    out[rest] = ranked
    return out
