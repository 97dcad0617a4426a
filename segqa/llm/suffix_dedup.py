"""Removal of long repeated strings with suffix arrays.

Which strings of ``length`` bytes start more than once is decided by sorting suffixes. The texts are
first cut where no repeat can be missed: every string (window) is named by the least hash of the short
grams in it, a number that equal windows share wherever they stand. Consecutive windows of one name
are a piece. Names met once hold no repeat. Pieces equal to another from end to end are one piece
that occurs often. What is left, pieces that share a name but differ, is what the suffix arrays are
for: the names are dealt over the cluster, each task sorts the suffixes of its pieces by difference
cover and compares the prefixes of neighbours. Pieces of a name too common for one task are compared
window by window in a distributed count instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import KEY, clear_text, slices
from .suffix_array import suffix_array

LENGTH, GRAM = 400, 32
LONGEST_RUN = 2048  # windows of a piece
TASK_BYTES = 3 << 20  # of pieces sorted together, about; a name beyond it is counted instead
_SPANS = "__segqa_spans"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the ``gram`` bytes (a power of two) from every position."""
    hashes = (data.astype(np.uint64) + np.uint64(1)) * _MIX
    step = 1
    while step < gram:
        hashes = (hashes[:-step] ^ (hashes[:-step] >> np.uint64(31))) * _MIX + hashes[step:]
        step *= 2
    return (hashes ^ (hashes >> np.uint64(29))) * _MIX


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def pieces_of(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """First window, end window, name and number of places of the name's gram, for each piece."""
    hashes = gram_hashes(data, gram)
    width = length - gram + 1
    names = sliding_min(hashes, width)
    cut = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    ends = np.append(cut[1:], len(names))
    if (ends - cut).max() > LONGEST_RUN:
        cut = np.concatenate([np.arange(a, b, LONGEST_RUN) for a, b in zip(cut, ends)])
        ends = np.append(cut[1:], len(names))
    places = [
        np.count_nonzero(hashes[a : b + width - 1] == names[a]) for a, b in zip(cut, ends)
    ]
    return cut, ends, names[cut], np.array(places)


def find_pieces(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """``(name, body, _id, _h1, begin, end, places)``: every piece of every text, without its bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            columns = [[] for _ in range(6)]
            rows = []
            texts = batch.column("text").cast(pa.binary())
            for row in range(batch.num_rows):
                text = texts[row].as_buffer()
                if text is None or text.size < length:
                    continue
                data = np.frombuffer(text, np.uint8)
                begin, end, name, places = pieces_of(data, length, gram)
                view = memoryview(text)
                columns[1] += [
                    xxhash.xxh3_64_intdigest(view[a : b + length - 1]) for a, b in zip(begin, end)
                ]
                for column, values in zip((0, 2, 3, 4), (name, begin, end, places)):
                    columns[column].append(values)
                rows += [row] * len(begin)
            if not rows:
                continue
            own = batch.select(["_id", "_h1"]).take(pa.array(rows))
            name, begin, end, places = (np.concatenate(columns[k]) for k in (0, 2, 3, 4))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(name.view(np.int64)),
                    pa.array(np.array(columns[1], np.uint64).view(np.int64)),
                    *own.columns,
                    pa.array(begin.astype(np.int32)),
                    pa.array(end.astype(np.int32)),
                    pa.array(places.astype(np.int32)),
                ],
                ["name", "body", "_id", "_h1", "begin", "end", "places"],
            )

    return keyed.select("_id", "_h1", "text").mapInArrow(
        cut, "name long, body long, _id long, _h1 long, begin int, end int, places int"
    )


def repeated_windows(
    bodies: list[bytes], runs: np.ndarray, length: int
) -> list[np.ndarray]:
    """For each piece which of its first ``runs`` windows start elsewhere too, by suffix array."""
    sizes = np.array([len(b) for b in bodies], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    data = np.zeros(starts[-1], np.uint8)
    # every piece ends in a symbol of its own, smaller than all bytes
    text = np.empty(starts[-1], np.int64)
    for k, body in enumerate(bodies):
        data[starts[k] : starts[k] + sizes[k]] = np.frombuffer(body, np.uint8)
    text[:] = data.astype(np.int64) + len(bodies) + 1
    text[starts[1:] - 1] = np.arange(1, len(bodies) + 1)
    window = np.zeros(len(text), bool)
    for k, run in enumerate(runs):
        window[starts[k] : starts[k] + run] = True
    order = suffix_array(text)
    order = order[window[order]]
    views = np.lib.stride_tricks.sliding_window_view(data, length)
    equal = np.zeros(max(len(order) - 1, 0), bool)
    for begin in range(0, len(equal), 4096):
        part = order[begin : begin + 4097]
        rows = views[part]
        equal[begin : begin + len(part) - 1] = (rows[1:] == rows[:-1]).all(axis=1)
    hit = np.zeros(len(text), bool)
    hit[order[:-1][equal]] = True
    hit[order[1:][equal]] = True
    return [hit[s : s + run] for s, run in zip(starts, runs)]


def _runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    yield from zip(edges[::2].tolist(), edges[1::2].tolist())


def _with_bytes(keyed: DataFrame, pieces: DataFrame, length: int) -> DataFrame:
    """``pieces`` (``name, body, copies, task`` and where they lie) with their bytes.

    Rows that repeat an id and a text repeat its pieces.
    """
    fields = ["name", "body", "copies", "task", "begin", "end"]
    own = pieces.groupBy("_id", "_h1").agg(F.collect_list(F.struct(*fields)).alias("_own"))
    texts = keyed.select("_id", "_h1", "text").join(own, ["_id", "_h1"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            own, texts = batch.column("_own"), batch.column("text").cast(pa.binary())
            counts = np.diff(own.offsets.to_numpy())
            row = np.repeat(np.arange(batch.num_rows), counts)
            flat = own.flatten()
            begin, end = flat.field("begin").to_numpy(), flat.field("end").to_numpy()
            bodies = [
                memoryview(texts[int(r)].as_buffer())[a : b + length - 1].tobytes()
                for r, a, b in zip(row, begin, end)
            ]
            keys = batch.select(["_id", "_h1"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*keys.columns, *(flat.field(f) for f in fields), pa.array(bodies, pa.binary())],
                ["_id", "_h1", *fields, "bytes"],
            )

    return texts.mapInArrow(
        cut,
        "_id long, _h1 long, name long, body long, copies long, task long, begin int, end int, "
        "bytes binary",
    )


_SPAN = "_id long, _h1 long, a int, b int"


def _sorted_spans(pieces: DataFrame, length: int) -> DataFrame:
    """Repeated spans of pieces that occur once, by one suffix array per task."""

    def sort(table: pa.Table) -> pa.Table:
        own = {}
        for k, key in enumerate(
            zip(table.column("name").to_pylist(), table.column("body").to_pylist())
        ):
            own.setdefault(key, k)
        rows = sorted(own.values())
        taken = table.take(pa.array(rows, pa.int64()))
        begin, end = taken.column("begin").to_numpy(), taken.column("end").to_numpy()
        hits = repeated_windows(taken.column("bytes").to_pylist(), end - begin, length)
        places = zip(
            taken.column("_id").to_pylist(), taken.column("_h1").to_pylist(),
            taken.column("copies").to_pylist(), begin.tolist(), hits,
        )
        out = [
            (i, h, at + a, at + b + length - 1)
            for i, h, copies, at, hit in places
            if copies == 1  # others are known to be repeated
            for a, b in _runs(hit)
        ]
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        columns = list(zip(*out)) or [[]] * 4
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["_id", "_h1", "a", "b"]
        )

    return pieces.groupBy("task").applyInArrow(sort, _SPAN)


def _counted_spans(pieces: DataFrame, length: int) -> DataFrame:
    """Repeated spans of the pieces of very common names: each window a row, counted by content."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bytes", 1 << 18):
            ids, h1 = batch.column("_id").to_pylist(), batch.column("_h1").to_pylist()
            begin, copies = batch.column("begin").to_pylist(), batch.column("copies").to_pylist()
            out = []
            for k, body in enumerate(batch.column("bytes").to_pylist()):
                view = memoryview(body)
                for at in range(len(body) - length + 1):
                    digest = xxhash.xxh3_128_digest(view[at : at + length])
                    out.append((digest, ids[k], h1[k], begin[k] + at, copies[k]))
            types = (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), types)],
                ["window", "_id", "_h1", "a", "copies"],
            )

    rows = pieces.dropDuplicates(["name", "body"]).mapInArrow(
        windows, "window binary, _id long, _h1 long, a int, copies long"
    )
    often = rows.groupBy("window").agg(F.sum("copies").alias("n")).filter("n > 1")
    return rows.filter("copies = 1").join(often, "window").select(
        "_id", "_h1", "a", (F.col("a") + length).alias("b")
    )


def repeated_spans(keyed: DataFrame, length: int = LENGTH, task_bytes: int = TASK_BYTES) -> DataFrame:
    """``(_id, _h1, a, b)``: byte spans of ``keyed`` (``_id, _h1, text``) that repeats cover."""
    gram = 1 << max(0, min(5, (length // 4).bit_length() - 1))
    pieces = materialize(find_pieces(keyed, length, gram), "pieces")
    names = pieces.groupBy("name").agg(
        F.count(F.lit(1)).alias("_n"), F.max("places").alias("_places"),
        F.min("body").alias("_b0"), F.max("body").alias("_b1"),
    )
    shared = names.filter("_n > 1 or _places > 1").select(
        "name", (F.col("_b0") != F.col("_b1")).alias("differ")
    )
    shared = materialize(pieces.join(shared, "name"), "shared-pieces")

    # equal pieces are one piece that occurs often: all its windows are repeated
    distinct = materialize(
        shared.groupBy("name", "body").agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct("_id", "_h1", "begin", "end")).alias("at"),
            F.max("places").alias("places"),
            F.first("differ").alias("differ"),
        ),
        "distinct-pieces",
    )
    often = distinct.filter("copies > 1").select("name", "body")
    whole = shared.join(often, ["name", "body"]).select(
        "_id", "_h1", F.col("begin").alias("a"), (F.col("end") + (length - 1)).alias("b")
    )

    # names with differing pieces, or with a gram twice in one piece, are sorted
    size = F.col("at.end") - F.col("at.begin") + length
    unsettled = (
        distinct.filter("differ or places > 1")
        .groupBy("name")
        .agg(F.min("copies").alias("_least"), F.sum(size).alias("_bytes"))
        .filter("_least = 1")
    )
    total = unsettled.agg(F.sum("_bytes")).first()[0] or 0
    tasks = max(1, -(-total // task_bytes))
    common = F.col("_bytes") > task_bytes
    task = F.when(common, F.lit(-1)).otherwise(F.pmod(F.xxhash64("name"), F.lit(tasks)))
    dealt = distinct.join(unsettled, "name").select(
        "name", "body", "copies", "at.*", task.cast("long").alias("task")
    )
    bodies = _with_bytes(keyed, dealt, length)
    spans = whole.unionByName(_sorted_spans(bodies.filter("task >= 0"), length))
    if unsettled.filter(common).limit(1).count():
        spans = spans.unionByName(_counted_spans(bodies.filter("task < 0"), length))
    return spans


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, text_col: str = "text", task_bytes: int = TASK_BYTES
) -> DataFrame:
    """``docs`` with ``kept`` (binary), ``n_bytes, n_removed, n_spans`` (long) and ``spans``.

    A byte of the UTF-8 text goes when a string of ``length`` bytes over it also starts anywhere
    else, in the same text or another; ``spans`` are the maximal removed runs ``(a, b)`` in order.
    Matches never cross texts; all is judged on the texts as given. A null text is empty and stays
    empty, as does any text under ``length`` bytes stay whole. Rows that repeat an id and a text are
    repeats of each other. Columns of these names are replaced, all others kept.
    """
    added = ["kept", "n_bytes", "n_removed", "n_spans", "spans"]
    text = clear_text(text_col)
    row_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))
    row_hash = F.xxhash64(text, "doc_id")
    source = docs.select(row_id.alias("_id"), row_hash.alias("_h1"), text.alias("text"))
    spans = (
        repeated_spans(source, length, task_bytes)
        .groupBy(F.col("_id").alias(KEY[0]), F.col("_h1").alias(KEY[1]))
        .agg(F.collect_list(F.struct("a", "b")).alias(_SPANS))
    )
    keyed = docs.drop(*added).withColumns({KEY[0]: row_id, KEY[1]: row_hash})
    joined = keyed.join(spans, KEY[:2], "left").drop(*KEY)
    fields = [f for f in joined.schema.fields if f.name != _SPANS]
    pair = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    kinds = [T.BinaryType(), T.LongType(), T.LongType(), T.LongType(), T.ArrayType(pair)]
    schema = T.StructType([*fields, *map(T.StructField, added, kinds)])

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            out = [[] for _ in added]
            texts = batch.column(text_col).cast(pa.binary()).to_pylist()
            for text, spans in zip(texts, batch.column(_SPANS).to_pylist()):
                text, runs = text or b"", _merged(spans or [])
                ends = [0, *(b for _, b in runs)]
                begins = [*(a for a, _ in runs), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(ends, begins))
                row = (kept, len(text), len(text) - len(kept), len(runs))
                for column, value in zip(out, (*row, [{"a": a, "b": b} for a, b in runs])):
                    column.append(value)
            types = [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            types.append(pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))
            kept = batch.drop_columns([_SPANS])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *(pa.array(c, t) for c, t in zip(out, types))],
                names=[*kept.schema.names, *added],
            )

    return joined.mapInArrow(remove, schema)


def _merged(spans: list[dict]) -> list[list[int]]:
    runs: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    return runs
