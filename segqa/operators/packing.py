"""Greedy packing of caption lines into segments.

A caption closes the running segment when it starts at least ``seconds`` after that segment's
start, and the next segment starts exactly there. The moving anchor is neither a tumbling nor a
session window: every cut depends on the one before it.

Captions are cut in chunks of at most ``chunk_rows`` positions of one video. Videos that fit in one
chunk need one shuffle. For longer ones the chunks are handled independently of each other, so no
task ever holds a whole video:

1. Every cut starts at a *record*, a caption that starts later than all captions before it. An
   anchor that enters a chunk lies less than ``seconds`` before the latest start so far, so only
   the chunk's records within ``seconds`` of that can be the first to close a segment.
2. For each of those few records, a chunk tabulates the anchor in force at its end. That table is
   all that must be known about a chunk.
3. Tables compose: those of ``FAN`` neighbours make one of the same kind for the block they form,
   and so on up to a table for every video. Back down, the anchor entering a block goes through its
   ``FAN`` parts and gives the anchors entering them. That is a parallel prefix: as many rounds as
   the number of chunks has digits, and no task follows more than ``FAN`` tables.
4. With it, each chunk cuts its own captions. Only the first and the last piece of a chunk can belong
   to a segment that spans chunks; those alone are put together.

Steps 1 to 3 read only positions and start times. A table, of a chunk or of a block, has at most as
many rows as a segment has captions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import strip, timecode
from ..session import materialize
from .timeline import check_seconds

# Positions of one video handled by one task. A million captions are a few tens of megabytes.
CHUNK_ROWS = 1 << 20
FAN = 16  # tables composed by one task
_ROUNDS = 4  # for videos whose number of chunks is not known: 16 ** 4 chunks and any number beyond


def pack_captions(
    captions: DataFrame,
    seconds: int = 30,
    chunk_rows: int = CHUNK_ROWS,
    long_videos: DataFrame | None = None,
    keep_blank: bool = False,
) -> DataFrame:
    """Segments of ``captions (video_id, seq, start, duration, text)``.

    ``seq`` is the position of a caption in its list, from 0 and unique within the video. Captions
    without a usable start are left out, those without a text count as blank. ``long_videos`` names
    the videos (``video_id``) with positions from ``chunk_rows`` on; if it is not given, they are
    looked up at once by a scan of ``seq`` in which row groups below ``chunk_rows`` are skipped.
    Segments without any text are left out unless ``keep_blank``.
    """
    seconds = check_seconds(seconds)
    rows = captions.filter(
        F.col("video_id").isNotNull()
        & F.col("seq").isNotNull()
        & (F.abs("start") < float("inf"))  # neither null, NaN nor infinite
    ).select(
        "video_id",
        F.floor(F.col("seq") / chunk_rows).alias("chunk"),
        "seq",
        "start",
        "duration",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    if long_videos is None:
        named = captions.filter(F.col("seq") >= chunk_rows).groupBy("video_id")
        named = named.agg(F.floor(F.max("seq") / chunk_rows).alias("last"))
    else:
        named = long_videos.select("video_id", F.lit(FAN**_ROUNDS - 1).alias("last")).distinct()
    # stored, as it is read several times: its size is known, so each join suits it
    named = materialize(named, "long-videos")
    ids, last = named.select("video_id"), named.agg(F.max("last")).first()[0]

    # a video that is not named is one chunk whatever its length, so naming too few stays exact
    pieces = _cut(_as_one_chunk(rows.join(ids, "video_id", "left_anti")), seconds)
    if last is not None:
        rounds = max(1, (int(last).bit_length() + 3) // 4)
        long = rows.join(ids, "video_id", "left_semi")
        pieces = pieces.unionByName(_cut_long(long, seconds, rounds))

    start, end = F.col("start_time"), F.coalesce("closed_at", "tail_end")
    packed = pieces.withColumn("text", strip(F.coalesce("text", F.lit(""))))
    return (
        packed.filter(F.lit(keep_blank) | (F.col("text") != ""))
        .select(
            "video_id",
            "start_time",
            end.alias("end_time"),
            (end - start).alias("duration"),
            "text",
            timecode(start).alias("timestamp"),
        )
    )


# -- cutting -----------------------------------------------------------------------------------

_PIECE = "video_id string, chunk bigint, start_time double, closed_at double, tail_end double, text string"


def _as_one_chunk(rows: DataFrame) -> DataFrame:
    return rows.withColumn("chunk", F.lit(0).cast("bigint"))


def _cut(rows: DataFrame, seconds: int, edges: bool | None = None) -> DataFrame:
    """Pieces of segments, each within one chunk; chunks arrive whole and in order.

    ``edges``: only those that may go on in another chunk, or only the others.
    """
    ordered = rows.repartition("video_id", "chunk").sortWithinPartitions(
        "video_id", "chunk", F.col("seq").asc_nulls_first()
    )
    return ordered.mapInArrow(_cutter(seconds, edges), _PIECE)


def _cutter(seconds: int, edges: bool | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema(
        [
            ("video_id", pa.string()),
            ("chunk", pa.int64()),
            ("start_time", pa.float64()),
            ("closed_at", pa.float64()),
            ("tail_end", pa.float64()),
            ("text", pa.string()),
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the open piece lives across batches: its chunk, anchor, joined texts and last end
        current, anchor, entered, texts, tail, awaited = None, 0.0, False, [], 0.0, None
        for batch in batches:
            batch, entering = _take_entries(batch)
            if awaited is not None:
                entering[0] = awaited
            awaited = entering.pop(batch.num_rows, None)
            if batch.num_rows == 0:
                continue
            starts = batch.column("start").to_numpy()
            ends = starts + pc.fill_null(batch.column("duration"), 0.0).to_numpy()
            # only the chain of anchors is sequential: one step per segment, found by its peak
            pieces, bounds = [], [0]
            fresh = set(np.flatnonzero(_chunk_begins(batch, current)).tolist())
            begins = sorted({0, *fresh})
            for i, end in zip(begins, [*begins[1:], batch.num_rows]):
                if i in fresh:
                    pieces.append((current, anchor, entered, None))
                    bounds.append(i)
                    current = (batch.column("video_id")[i].as_py(), batch.column("chunk")[i].as_py())
                    anchor, entered = entering.get(i, 0.0), i in entering
                peak = np.maximum.accumulate(starts[i:end])
                at = 0
                while (at := _closing(peak, at, anchor, seconds)) < end - i:
                    # the first start that reaches the limit is the peak itself
                    pieces.append((current, anchor, entered, float(peak[at])))
                    bounds.append(i + at)
                    anchor, entered = float(peak[at]), False
            bounds.append(batch.num_rows)
            lines = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), batch.column("text"))
            joined = pc.binary_join(lines, " ").to_pylist()
            done = []
            for k, (key, begin, from_before, closed) in enumerate(pieces):
                if bounds[k] < bounds[k + 1]:
                    texts.append(joined[k])
                    tail = float(ends[bounds[k + 1] - 1])
                # a segment of an earlier chunk may end with the first caption here: only an end
                on_edge = from_before or closed is None
                if (texts or on_edge and closed is not None) and edges in (None, on_edge):
                    done.append((*key, begin, closed, tail, " ".join(texts) if texts else None))
                texts = []
            if bounds[-2] < bounds[-1]:
                texts.append(joined[-1])
                tail = float(ends[-1])
            if done:
                yield pa.RecordBatch.from_pylist(
                    [dict(zip(schema.names, piece)) for piece in done], schema=schema
                )
        if texts and edges in (None, True):
            last = (*current, anchor, None, tail, " ".join(texts))
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, last))], schema=schema)

    return cut


def _closing(peak: np.ndarray, at: int, anchor: float, seconds: int) -> int:
    """The first caption from ``at`` on that starts ``seconds`` or more after ``anchor``.

    ``peak`` is the running maximum of the starts: where it first reaches the limit, the start does.
    """
    found = max(at, int(np.searchsorted(peak, anchor + seconds)))
    # the rule compares differences, which may round differently from the sum searched for
    while found > at and peak[found - 1] - anchor >= seconds:
        found -= 1
    while found < len(peak) and peak[found] - anchor < seconds:
        found += 1
    return found


def _take_entries(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, dict[int, float]]:
    """The captions of a batch, and the entering anchor by the number of the caption it precedes."""
    seq = batch.column("seq")
    if not seq.null_count:
        return batch, {}
    marks = pc.is_null(seq)
    at = np.flatnonzero(marks.to_numpy(zero_copy_only=False))
    anchors = batch.column("start").to_numpy()[at]
    return batch.filter(pc.invert(marks)), dict(
        zip((at - np.arange(len(at))).tolist(), anchors.tolist())
    )


def _chunk_begins(batch: pa.RecordBatch, current: tuple | None) -> list[bool]:
    """Which rows are the first of their chunk."""
    ids, chunk = batch.column("video_id"), batch.column("chunk")
    same = pc.and_(pc.equal(ids[1:], ids[:-1]), pc.equal(chunk[1:], chunk[:-1]))
    return [(ids[0].as_py(), chunk[0].as_py()) != current, *pc.invert(same).to_pylist()]


def _cut_long(rows: DataFrame, seconds: int, rounds: int) -> DataFrame:
    """As :func:`_cut` for videos of several chunks, with the pieces of a segment joined.

    The entering anchors travel as extra rows that sort ahead of their chunk, which saves a join. The
    chunks are shuffled once and read for what lies within them and again for their edges.
    """
    entries = _entering_anchors(rows.select("video_id", "chunk", "seq", "start"), seconds, rounds)
    nothing = F.lit(None)
    marked = rows.unionByName(
        entries.select(
            "video_id",
            "chunk",
            nothing.cast("bigint").alias("seq"),
            F.col("anchor").alias("start"),
            nothing.cast("double").alias("duration"),
            nothing.cast("string").alias("text"),
        )
    )
    # one piece per chunk that a segment touches, together as large as the text it results in
    piece = F.struct("chunk", "text", "closed_at", "tail_end")
    joined = (
        _cut(marked, seconds, edges=True)
        .groupBy("video_id", "start_time")
        .agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    )
    last = F.element_at("pieces", -1)
    return _cut(marked, seconds, edges=False).unionByName(
        joined.select(
            "video_id",
            F.col("pieces")[0]["chunk"].alias("chunk"),
            "start_time",
            last["closed_at"].alias("closed_at"),
            last["tail_end"].alias("tail_end"),
            F.array_join(F.col("pieces")["text"], " ").alias("text"),
        )
    )


# -- anchors entering the chunks of long videos ------------------------------------------------

_TABLE = "video_id string, block bigint, floor double, hit double, leaving double"


def _entering_anchors(timed: DataFrame, seconds: int, rounds: int) -> DataFrame:
    """``(video_id, chunk, anchor)`` for every chunk of ``timed (video_id, chunk, seq, start)``."""
    key = ["video_id", "chunk"]
    earlier = W.partitionBy("video_id").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    peaks = (
        timed.groupBy(*key)
        .agg(F.max("start").alias("peak"))
        .select(
            F.col("video_id").alias("of_video"),
            F.col("chunk").alias("of_chunk"),
            F.greatest(F.lit(0.0), F.coalesce(F.max("peak").over(earlier), F.lit(0.0))).alias(
                "floor"
            ),
        )
    )
    tables = (
        timed.groupBy(*key)
        .cogroup(peaks.groupBy("of_video", "of_chunk"))
        .applyInArrow(_transitions(seconds), _TABLE)
    )
    # up: each level is read to compose the next and once more on the way down
    parent = F.floor(F.col("block") / FAN)
    levels = [materialize(tables, "transitions")]
    for _ in range(rounds - 1):
        composed = levels[-1].groupBy("video_id", parent.alias("parent"))
        levels.append(materialize(composed.applyInArrow(_compose(seconds), _TABLE), "transitions"))
    # down: every video starts from 0
    entered = "video_id string, block bigint, anchor double"
    anchors = levels[-1].groupBy("video_id").applyInArrow(_follow(seconds, False), entered)
    for level in reversed(levels[:-1]):
        anchors = (
            level.groupBy("video_id", parent.alias("parent"))
            .cogroup(anchors.groupBy("video_id", "block"))
            .applyInArrow(_follow(seconds, True), entered)
        )
    return anchors.withColumnRenamed("block", "chunk")


def _transitions(seconds: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Table of one chunk: first closing record -> anchor in force at the end of the chunk."""

    def tabulate(captions: pa.Table, peaks: pa.Table) -> pa.Table:
        starts = captions.sort_by([("seq", "ascending")])["start"].to_numpy()
        floor = peaks["floor"][0].as_py()
        peak = np.maximum.accumulate(np.concatenate(([floor], starts)))
        records = peak[1:][peak[1:] > peak[:-1]]
        leaving = _leaving(records, seconds)
        reach = _reach(records, floor, seconds)
        video, chunk = captions["video_id"][0].as_py(), captions["chunk"][0].as_py()
        return _as_table(video, chunk, floor, records[:reach], leaving[:reach])

    return tabulate


def _reach(records: np.ndarray, floor: float, seconds: int) -> int:
    """How many records can be the first to close a segment: those less than ``seconds`` after the
    latest earlier start, and one more."""
    return min(len(records), int(np.sum(records - floor < seconds)) + 1)


def _as_table(video: str, block: int, floor: float, hits: np.ndarray, leaving: np.ndarray) -> pa.Table:
    """The first row, without a hit, stands for the block itself."""
    n = len(hits) + 1
    return pa.table(
        {
            "video_id": pa.array([video] * n, pa.string()),
            "block": pa.array(np.full(n, block, np.int64)),
            "floor": pa.array(np.full(n, floor)),
            "hit": pa.array([None, *hits.tolist()], pa.float64()),
            "leaving": pa.array([None, *leaving.tolist()], pa.float64()),
        }
    )


def _blocks(table: pa.Table) -> Iterator[tuple[int, float, np.ndarray, np.ndarray]]:
    """Number, floor, hits and leaving anchors of each block, in order."""
    table = table.sort_by([("block", "ascending"), ("hit", "ascending")])
    block = table["block"].to_numpy()
    hits, leaving = table["hit"].to_numpy(), table["leaving"].to_numpy()
    bounds = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
    for a, b in zip(bounds, bounds[1:]):
        # the row of the block itself sorts last
        yield int(block[a]), table["floor"][int(a)].as_py(), hits[a : b - 1], leaving[a : b - 1]


def _through(hits: np.ndarray, leaving: np.ndarray, anchors: np.ndarray, seconds: int) -> np.ndarray:
    """The anchors in force behind a block, for those that enter it."""
    if not len(hits):
        return anchors
    at = _first_closing(hits, anchors, seconds)
    return np.where(at < len(hits), leaving[np.minimum(at, len(hits) - 1)], anchors)


def _compose(seconds: int) -> Callable[[pa.Table], pa.Table]:
    """One table for neighbouring blocks."""

    def compose(table: pa.Table) -> pa.Table:
        video, parts = table["video_id"][0].as_py(), list(_blocks(table))
        number, floor, hits, leaving = parts[0]
        for _, _, own_hits, own_leaving in parts[1:]:
            # an anchor that no earlier part closes meets this one's records, which are all later
            leaving = np.concatenate(
                [_through(own_hits, own_leaving, leaving, seconds), own_leaving]
            )
            hits = np.concatenate([hits, own_hits])
            reach = _reach(hits, floor, seconds)
            hits, leaving = hits[:reach], leaving[:reach]
        return _as_table(video, number // FAN, floor, hits, leaving)

    return compose


def _follow(seconds: int, entered: bool) -> Callable[..., pa.Table]:
    """The anchors entering neighbouring blocks, from that entering the first: given, or else 0."""

    def follow(table: pa.Table, entering: pa.Table | None) -> pa.Table:
        if not table.num_rows:
            return pa.table([[], [], []], _ENTERED)
        anchor = np.array([0.0 if entering is None else entering["anchor"][0].as_py()])
        blocks, anchors = [], []
        for block, _, hits, leaving in _blocks(table):
            blocks.append(block)
            anchors.append(float(anchor[0]))
            anchor = _through(hits, leaving, anchor, seconds)
        video = table["video_id"][0].as_py()
        columns = [[video] * len(blocks), blocks, anchors]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, _ENTERED)], _ENTERED)

    def follow_from_start(table: pa.Table) -> pa.Table:
        return follow(table, None)

    return follow if entered else follow_from_start


_ENTERED = pa.schema(
    [("video_id", pa.string()), ("block", pa.int64()), ("anchor", pa.float64())]
)


def _first_closing(records: np.ndarray, anchors: np.ndarray, seconds: int) -> np.ndarray:
    """For each anchor the first of the ascending ``records`` that starts ``seconds`` or more later."""
    n = len(records)
    found = np.searchsorted(records, anchors + seconds)
    # the rule compares differences, which may round differently from the sum searched for
    while (early := (found > 0) & (records[np.maximum(found, 1) - 1] - anchors >= seconds)).any():
        found = found - early
    while True:
        late = (found < n) & (records[np.minimum(found, n - 1)] - anchors < seconds)
        if not late.any():
            return found
        found = found + late


def _leaving(records: np.ndarray, seconds: int) -> np.ndarray:
    """For each record taken as an anchor, the last anchor that follows from it."""
    n = len(records)
    own = np.arange(n)
    following = _first_closing(records, records, seconds) if n else own
    # pointer doubling: each round follows twice as many steps
    following = np.where(following < n, following, own)
    while not np.array_equal(further := following[following], following):
        following = further
    return records[following]
