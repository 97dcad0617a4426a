"""Streaming forms of the operators.

The stateless operators (``consecutive_segments``, ``attach_video`` with a static videos table, the
scalar functions and ``generate_qa`` with placeholder models) take streaming tables as they are.
This module adds what needs state or a stored micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.text import strip, timecode
from ..operators.inference import Provider
from ..operators.packing import _closing
from ..operators.pairs import generate_qa
from ..operators.splits import DEFAULT_SPLITS, SplitConfig
from ..operators.stats import pair_counts
from ..operators.timeline import check_seconds

# Setting a session needs for stateful streams.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}

_OPEN = "anchor double, tail double, seq bigint, first bigint, seen bigint"
_OUT = (
    "video_id string, start_time double, end_time double, text string, seq bigint, version bigint, "
    "late boolean"
)


def stream_segments(
    captions: DataFrame, seconds: int = 30, idle_seconds: int | None = None
) -> DataFrame:
    """Pack a stream of captions ``(video_id, seq, start, duration, text)``.

    The same rule as ``pack_captions``, with the anchor and the open segment of each video held as
    state. Nothing ends by time: however the captions are sliced into micro-batches and however long
    a video pauses, :func:`latest_segments` of what was written equals ``pack_captions``. A closed
    segment comes out once it is closed. The open one comes out at the end of each micro-batch that
    changed it, with ``version``, the position of its last caption; the row with the greatest
    version counts. A caption whose position was already passed cannot be packed any more and comes
    out as a row of its own with ``late`` set (:func:`late_captions`).

    State is a few numbers per video and a list of the open segment's text, to which a micro-batch
    adds what it brings; nothing that is there already is written again. A video's captions of one
    micro-batch are ordered in one task: limit the batches at the source (``maxFilesPerTrigger``,
    ``maxOffsetsPerTrigger``) and load a backlog with ``pack_captions``.

    With ``idle_seconds`` a video that brought nothing for that long, by the clock of the cluster, is
    forgotten; its last open version stands. If it returns it is a new video: no caption is late, and
    its first segment starts at 0 or, from ``seconds`` on, at its first caption. Such a stream never
    runs out of work, so it needs a trigger that goes on, not ``availableNow``.
    """
    seconds = check_seconds(seconds)
    usable = captions.filter(
        F.col("video_id").isNotNull()
        & F.col("seq").isNotNull()
        & (F.abs("start") < float("inf"))
    ).select(
        "video_id", "seq", "start", "duration", F.coalesce("text", F.lit("")).alias("text")
    )
    packed = usable.groupBy("video_id").transformWithStateInPandas(
        _Packer(seconds, idle_seconds),
        outputStructType=_OUT,
        outputMode="Append",
        timeMode="None" if idle_seconds is None else "ProcessingTime",
    )
    return packed.withColumn("text", strip(F.col("text"))).select(
        "video_id",
        "start_time",
        "end_time",
        (F.col("end_time") - F.col("start_time")).alias("duration"),
        "text",
        timecode(F.col("start_time")).alias("timestamp"),
        "seq",
        "version",
        "late",
    )


def latest_segments(written: DataFrame) -> DataFrame:
    """The segments among the rows of :func:`stream_segments`, as ``pack_captions`` gives them.

    Versions of a segment differ only while it is open: they number its micro-batches and collapse
    before the shuffle. ``seq`` tells segments apart that start at the same time.
    """
    kept = ["end_time", "duration", "text", "timestamp"]
    latest = (
        written.filter(~F.col("late"))
        .groupBy("video_id", "start_time", "seq")
        .agg(F.max_by(F.struct(*kept), "version").alias("latest"))
    )
    return latest.select("video_id", "start_time", "latest.*").filter(F.col("text") != "")


def late_captions(written: DataFrame) -> DataFrame:
    """Captions that came after a later one of their video and are in no segment."""
    return written.filter("late").select(
        "video_id", "seq", F.col("start_time").alias("start"), "duration", "text"
    )


class _Packer(StatefulProcessor):
    def __init__(self, seconds: int, idle_seconds: int | None):
        self.seconds = seconds
        self.idle = None if idle_seconds is None else 1000 * idle_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _OPEN)
        self.texts = handle.getListState("texts", "text string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        video_id = key[0]
        now = 0 if self.idle is None else timerValues.getCurrentProcessingTimeInMs()
        anchor, tail, last, first, seen = 0.0, 0.0, -1, None, now
        if self.open.exists():
            anchor, tail, last, first, seen = self.open.get()
            if self.idle is not None and now - seen >= self.idle:
                self._forget()
                anchor, tail, last, first = 0.0, 0.0, -1, None
        batch = pd.concat(list(rows)).sort_values("seq", kind="stable")
        seq = batch["seq"].to_numpy(np.int64)
        starts = batch["start"].to_numpy(float)
        ends = starts + batch["duration"].fillna(0.0).to_numpy(float)
        lines = batch["text"].to_numpy(object)
        late = seq <= np.maximum.accumulate(np.concatenate([[last], seq[:-1]]))
        columns = (c[late].tolist() for c in (starts, ends, lines, seq, seq))
        out = [(video_id, *row, True) for row in zip(*columns)]
        seq, starts, ends, lines = (c[~late] for c in (seq, starts, ends, lines))
        peak = np.maximum.accumulate(starts)
        at, carried = 0, first is not None  # text of the open segment lies in the state
        while len(peak):
            end = _closing(peak, at, anchor, self.seconds)
            if end > at and first is None:
                first = int(seq[at])
            if end == len(peak):
                break
            if first is not None:  # closed: no later version
                text = " ".join([*self._text(carried), *lines[at:end]])
                out.append((video_id, anchor, float(peak[end]), text, first, _CLOSED, False))
            if carried:
                self.texts.clear()
            anchor, first, carried, at = float(peak[end]), int(seq[end]), False, end
        if len(peak):
            tail, last = float(ends[-1]), int(seq[-1])
            self.texts.appendValue((" ".join(lines[at:]),))
            out.append((video_id, anchor, tail, " ".join(self._text(True)), first, last, False))
        self.open.update((anchor, tail, last, first, now))
        if self.idle is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(now + self.idle)
        yield pd.DataFrame(out, columns=_COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._forget()
        return iter([])

    def _text(self, carried: bool) -> list[str]:
        return [text for (text,) in self.texts.get()] if carried else []

    def _forget(self) -> None:
        self.open.clear()
        self.texts.clear()

    def close(self) -> None:
        pass


_CLOSED = 2**63 - 1
_COLUMNS = ["video_id", "start_time", "end_time", "text", "seq", "version", "late"]


def stream_pairs(
    segments: DataFrame, videos: DataFrame, splits: Sequence[SplitConfig] = DEFAULT_SPLITS
) -> DataFrame:
    """Pairs of a stream of segments by placeholder models, titles from a static videos table.

    For called models use :func:`write_pairs_stream`, which stores each batch of responses.
    """
    return generate_qa(segments, videos, splits)


def stream_split_stats(pairs: DataFrame) -> DataFrame:
    """Running counts per split; write it in output mode ``complete`` or ``update``."""
    return pair_counts(pairs)


def replace_each_batch(
    stats: DataFrame, out: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the states of a small running aggregate below ``out``, a folder per micro-batch.

    A reader never meets a state that is being written: :func:`latest_state` takes the newest
    folder that is complete.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/state={number}")

    return _start(stats, write, checkpoint, trigger, "complete")


def latest_state(spark: SparkSession, out: str) -> DataFrame:
    """The newest complete state written by :func:`replace_each_batch`."""
    marks = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(out)
        .select(F.regexp_extract("path", r"/state=(\d+)/", 1).cast("bigint").alias("number"))
    )
    newest = marks.agg(F.max("number")).first()[0]
    if newest is None:
        raise ValueError(f"no state in {out}")
    return spark.read.parquet(f"{out.rstrip('/')}/state={newest}")


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Run the streams started inside with the state store that stateful streams need."""
    before = {key: spark.conf.get(key, None) for key in STATE_STORE}
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def write_pairs_stream(
    segments: DataFrame,
    videos: DataFrame,
    out: str,
    checkpoint: str,
    splits: Sequence[SplitConfig] = DEFAULT_SPLITS,
    provider: Provider | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the pairs of each micro-batch of segments below ``out``.

    A batch goes to its own folder and replaces it when repeated after a failure, so every pair is
    stored exactly once.
    """

    def write(batch: DataFrame, number: int) -> None:
        pairs = generate_qa(batch, videos, splits, provider)
        pairs.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")

    return _start(segments, write, checkpoint, trigger)


def _start(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None,
    mode: str = "append",
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(write)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
