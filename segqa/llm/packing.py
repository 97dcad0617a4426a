"""Best-fit packing of token pieces into sequences under several capacities.

A piece is a vector (tokens, documents, attention cost = tokens squared) and so is what a sequence
has left. Pieces go in decreasing size into the open sequence that fits them best: by the smallest
weighted norm of what would be left, or by the largest weighted dot product of piece and residual.
Every capacity binds.

Pieces are dealt at random into groups of a bounded number and each group is packed by itself: a
group wastes less than a sequence, of thousands that it fills. No task sees more than a few groups,
one source or document cannot crowd one, and a lost task packs its groups again to the same result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import batch_rows, materialize
from .common import TEXT_ROWS, shuffle_tasks, slices
from .tokens import TEXT_BYTES, word_encoder

GROUP_PIECES = 8_192


class Capacity(NamedTuple):
    """What one sequence holds, and how much each dimension counts in the choice."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.1, 0.1)


def token_pieces(
    docs: DataFrame, tokenizer: str, max_tokens: int = 4096, end_id: int = 1
) -> DataFrame:
    """Pieces ``(doc_id, piece, start, length, ids_crc32)`` of every document's ids and ``end_id``.

    Only documents of more than ``max_tokens`` ids are cut. A null or empty text has the end id
    alone, a null id stays null, repeated rows give repeated pieces, other columns are ignored.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        for batch in slices(batches, "text", TEXT_BYTES):
            ids, bounds = encoder.encode(batch.column("text"))
            ids = ids.astype("<u4")
            rows = []
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), bounds, bounds[1:]):
                own = np.append(ids[a:b], np.uint32(end_id))
                for piece, start in enumerate(range(0, len(own), max_tokens)):
                    part = own[start : start + max_tokens]
                    rows.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), _PIECE_TYPES)], _PIECE_NAMES
            )

    return docs.select("doc_id", "text").mapInArrow(
        pieces, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


_PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
_PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def best_fit(
    lengths: np.ndarray, capacity: Capacity, rule: str = "norm"
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; ``lengths`` in decreasing order.

    ``rule``: ``norm`` (smallest weighted residual) or ``dot`` (largest weighted dot product). Ties
    go to the sequence opened first. A piece that exceeds a capacity by itself is an error.
    """
    limits = np.array([capacity.tokens, capacity.documents, capacity.attention], float)
    weights = np.array(capacity.weights, float)
    left = np.empty((max(1, len(lengths)), 3))  # of open sequences, in the order of opening
    number = np.empty(len(left), np.int64)
    fill = np.zeros(len(left), np.int64)
    opened = 0
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    smallest = lengths.min() if len(lengths) else 0
    live = 0  # rows of left in use
    for k, tokens in enumerate(lengths):
        need = np.array([tokens, 1.0, float(tokens) ** 2])
        if (need > limits).any():
            raise ValueError(f"a piece of {tokens} tokens exceeds a sequence")
        rest = left[:live] - need
        fits = (rest >= 0).all(axis=1)
        if fits.any():
            if rule == "norm":
                cost = (weights * (rest / limits) ** 2).sum(axis=1)
            else:
                cost = -(weights * (need / limits) * (left[:live] / limits)).sum(axis=1)
            cost[~fits] = np.inf
            row = int(cost.argmin())
        else:
            row, live = live, live + 1
            left[row], number[row] = limits, opened
            opened += 1
        left[row] -= need
        where[k], offset[k] = number[row], fill[number[row]]
        fill[number[row]] += tokens
        if left[row, 0] < smallest or left[row, 1] < 1:  # nothing fits any more
            left[row:live - 1] = left[row + 1 : live].copy()
            number[row:live - 1] = number[row + 1 : live].copy()
            live -= 1
    return where, offset


def pack(
    pieces: DataFrame,
    capacity: Capacity = Capacity(),
    rule: str = "norm",
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """``pieces`` (``doc_id, piece, length`` and any other columns) with ``sequence_id, offset``.

    Stores ``pieces`` once in the shared folder, since they are counted before they are dealt.
    Existing columns called ``sequence_id`` or ``offset`` are replaced. No pieces, no sequences.
    """
    spark = pieces.sparkSession
    with batch_rows(spark, TEXT_ROWS):
        stored = materialize(pieces.drop("sequence_id", "offset", "_group"), "pieces")
    groups = max(1, -(-stored.count() // group_pieces))
    added = [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")]
    schema = T.StructType([*stored.schema.fields, *added])
    # every column of a plain type takes part, so that a repeated run packs alike
    keys = [f.name for f in stored.schema if f.name != "length" and _sortable(f.dataType)]

    def fill(group: pa.Table) -> pa.Table:
        number = group.column("_group")[0].as_py()
        group = group.drop_columns("_group").sort_by(
            [("length", "descending"), *((k, "ascending") for k in keys)]
        )
        where, offset = best_fit(group.column("length").to_numpy(), capacity, rule)
        sequence = (np.int64(number) << 32) + where
        return group.append_column("sequence_id", pa.array(sequence)).append_column(
            "offset", pa.array(offset)
        )

    group = F.pmod(F.xxhash64("doc_id", "piece", F.lit("group")), F.lit(groups)).cast("int")
    return (
        stored.withColumn("_group", group)
        .repartition(min(groups, shuffle_tasks(spark)), "_group")
        .groupBy("_group")
        .applyInArrow(fill, schema)
    )


def _sortable(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.StringType, T.BooleanType))


def packed_documents(
    docs: DataFrame, tokenizer: str, capacity: Capacity = Capacity(), end_id: int = 1
) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return pack(token_pieces(docs, tokenizer, capacity.tokens, end_id), capacity)
