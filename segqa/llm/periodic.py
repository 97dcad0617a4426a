"""Runs of words that repeat with a period, by internal pattern matching.

A run of period q and at least four periods holds a block of B words, B a power of two with
q <= B < 2q, that starts at a multiple of B, and the same block q words on or q words back. Nothing
nearer equals it, since q is the smallest period and the block is not shorter. So for every such
block the nearest equal stretches in its neighbouring windows are asked for: equal blocks are a range
of the suffix array, and the nearest one is the successor or predecessor of the block's own place
among the range's values, found in a wavelet tree over the array. The occurrences in a window stand
in arithmetic progression, so the distance to the nearest is the only candidate period. Each
candidate is stretched as far as the words allow, by comparing blocks of 2, 4, 8 ... words through the
ranks that sorted the array.

A batch of texts is one sequence, each text closed by a word of its own, so no repeat crosses texts
and all steps work on whole arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import slices
from .wavelet import WaveletMatrix

PERIODS, LEAST = 4, 6  # a run has that many periods and words, at least
BATCH_BYTES = 3 << 20


def block_ranks(symbols: np.ndarray, longest: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Ranks of the blocks of 1, 2, 4 ... symbols from every place, and the places in order.

    A rank is the place of the first equal block among all in order. Doubling ends when all blocks
    differ or are half as long as ``longest``. Only places that are not yet told apart are sorted again.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = _first_of_group(symbols[order], np.arange(n), order, np.empty(n, np.int64))
    ranks, width = [rank], 1
    while 4 * width <= longest:
        size = np.bincount(rank, minlength=n)
        open_ = size[rank[order]] > 1  # stretches of the order to sort again
        if not open_.any():
            break
        at = np.flatnonzero(open_)
        places = order[at]
        behind = np.minimum(places + width, n)
        second = np.append(rank, -1)[behind] + 1
        first = rank[places]
        by = np.argsort(first * (n + 2) + second, kind="stable")
        places, first, second = places[by], first[by], second[by]
        order = order.copy()
        order[at] = places
        rank = _first_of_group(first * (n + 2) + second, at, places, rank.copy())
        ranks.append(rank)
        width *= 2
    return ranks, order


def _first_of_group(keys: np.ndarray, at: np.ndarray, places: np.ndarray, rank: np.ndarray):
    """Write the place in order (``at``) of the first of every group of equal ``keys``."""
    if len(keys):
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        rank[places] = at[new][np.cumsum(new) - 1]
    return rank


def _common(ranks: list[np.ndarray], left: np.ndarray, right: np.ndarray, back: bool) -> np.ndarray:
    """Length of the equal stretches from two places on, or before two places."""
    n = len(ranks[0])
    done = np.zeros(len(left), np.int64)
    live = np.arange(len(left))
    for level in range(len(ranks) - 1, -1, -1):
        width, rank = 1 << level, ranks[level]
        while True:
            a, b = left[live], right[live]
            a, b = (a - done[live] - width, b - done[live] - width) if back else (
                a + done[live], b + done[live])
            inside = (a >= 0) & (b + width <= n)
            equal = np.zeros(len(live), bool)
            equal[inside] = rank[a[inside]] == rank[b[inside]]
            done[live[equal]] += width
            if level < len(ranks) - 1 or not equal.any():
                break
            live = live[equal]
        live = np.arange(len(left))
    return done


def find_runs(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of all runs, by start and period.

    ``symbols`` are texts one behind the other, each closed by a symbol met nowhere else; none is
    longer than ``longest``.
    """
    n = len(symbols)
    ranks, order = block_ranks(symbols, longest)
    # a block is asked for only if its first word stands again within reach
    again = np.full(n, n, np.int64)
    by = np.lexsort((np.arange(n), ranks[0]))
    same = ranks[0][by[1:]] == ranks[0][by[:-1]]
    gap = by[1:] - by[:-1]
    again[by[:-1][same]] = gap[same]
    again[by[1:][same]] = np.minimum(again[by[1:][same]], gap[same])
    tree = None
    found = []
    for level, rank in enumerate(ranks):
        width = 1 << level
        block = np.arange(0, n - width + 1, width)
        size = np.bincount(rank, minlength=n)
        block = block[(again[block] <= width) & (size[rank[block]] > 1)]
        if not len(block):
            continue
        if tree is None:
            tree = WaveletMatrix(order)
        left = rank[block]
        right = left + size[left]
        own = tree.less(left, right, block)
        for step in (1, -1):
            some = np.flatnonzero((own + step >= 0) & (own + step < right - left))
            near = tree.nth(left[some], right[some], own[some] + step)
            period = np.abs(near - block[some])
            close = period <= width
            found.append((np.minimum(near, block[some])[close], period[close]))
    if not found:
        return (np.empty(0, np.int64),) * 3
    place, period = (np.concatenate(x) for x in zip(*found))
    key = np.unique(place * (n + 1) + period)
    place, period = key // (n + 1), key % (n + 1)
    start = place - _common(ranks, place, place + period, back=True)
    end = place + period + _common(ranks, place, place + period, back=False)
    long = end - start >= np.maximum(LEAST, PERIODS * period)
    key = np.unique(np.stack([start[long], period[long], (end - start)[long]], 1), axis=0)
    return key[:, 0], key[:, 2], key[:, 1]


def _flags(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Places that any of the stretches covers."""
    edges = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(edges[:n]) > 0


def periodic_runs(
    docs: DataFrame,
    text_col: str = "text",
    repeat: Callable[[pa.RecordBatch, np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None,
) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed``.

    Words are what ASCII blanks separate. ``runs`` lists every ``(start, length, period)`` in words,
    by start and then period: stretches of at least six words and four times their smallest period
    that no neighbouring word extends. ``collapsed`` has the words that no run holds behind its first
    period, joined by one blank.

    ``repeat`` may change texts before anything else: from rows and their numbers of words it tells
    for each row a word and a period, and all words from that one on become the first ``period`` of
    them, over and over; a period of 0 leaves the text.

    A null text has no words, no runs and collapses to the empty text. Repeated rows are equal rows;
    columns of these names are replaced, all others kept; an empty table stays empty.
    """
    added = ["n_words", "runs", "collapsed"]
    docs = docs.drop(*added)
    fields = list(docs.schema.fields)
    run = T.StructType([T.StructField(f, T.LongType()) for f in ("start", "length", "period")])
    kinds = [T.LongType(), T.ArrayType(run), T.StringType()]
    schema = T.StructType([*fields, *map(T.StructField, added, kinds)])
    arrow_run = pa.struct([(f, pa.int64()) for f in ("start", "length", "period")])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col, BATCH_BYTES):
            lists = pc.ascii_split_whitespace(pc.fill_null(batch.column(text_col), ""))
            real = pc.not_equal(lists.values, "").to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], np.cumsum(real)])[lists.offsets.to_numpy()]
            coded = lists.values.filter(pa.array(real)).dictionary_encode()
            index = coded.indices.to_numpy().astype(np.int64)
            sizes = np.diff(bounds)
            if repeat is not None:
                index = _repeated(index, bounds, *repeat(batch, sizes))
            # every text is closed by a symbol of its own
            closed = bounds + np.arange(len(bounds))
            symbols = np.insert(index, bounds[1:], len(coded.dictionary) + np.arange(len(sizes)))
            start, length, period = find_runs(symbols, int(sizes.max(initial=0)))
            text = np.searchsorted(closed, start, side="right") - 1
            gone = _flags(start + period, start + length, len(symbols))
            kept = np.delete(~gone, closed[1:] - 1)
            words = coded.dictionary.take(pa.array(index[kept]))
            lengths = np.add.reduceat(np.append(kept, False).astype(np.int64), bounds[:-1])
            lengths[sizes == 0] = 0
            ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            runs = pa.StructArray.from_arrays(
                [pa.array(start - closed[text]), pa.array(length), pa.array(period)],
                fields=list(arrow_run),
            )
            run_ends = np.searchsorted(text, np.arange(len(sizes) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(sizes.astype(np.int64)),
                    pa.ListArray.from_arrays(run_ends, runs),
                    pc.binary_join(pa.ListArray.from_arrays(ends, words), " "),
                ],
                names=[*(f.name for f in fields), *added],
            )

    return docs.mapInArrow(find, schema)


def _repeated(
    index: np.ndarray, bounds: np.ndarray, first: np.ndarray, every: np.ndarray
) -> np.ndarray:
    """Words of each text with those from ``first`` on replaced by the first ``every`` of them."""
    text = np.repeat(np.arange(len(first)), np.diff(bounds))
    at = np.arange(len(index)) - bounds[text]
    first, every = first[text], every[text]
    inside = (every > 0) & (at >= first)
    at[inside] = first[inside] + (at[inside] - first[inside]) % every[inside]
    return index[bounds[text] + at]
