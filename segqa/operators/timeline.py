"""Segments cut at fixed intervals of a video's timeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prompts import placeholder_transcript
from ..functions.text import timecode
from .quality import quarantine

# Segments expanded from one row; longer videos become several rows first.
BLOCK_SEGMENTS = 1 << 16

# Blocks expanded from one row, likewise.
BLOCK_ROWS = 1 << 10

# No video lasts longer (about 317 years). A greater number is a wrong unit or a broken probe, and
# would give more segments than can be stored: ``quarantine`` it by ``plausible_duration``.
LONGEST_SECONDS = 1e10


def plausible_duration(duration: Column) -> Column:
    """Finite and at most ``LONGEST_SECONDS``; a check for ``quarantine``."""
    return duration.isNotNull() & ~F.isnan(duration) & (duration <= F.lit(LONGEST_SECONDS))


def check_seconds(seconds: int) -> int:
    """Segment length as a positive whole number of seconds."""
    if isinstance(seconds, bool) or int(seconds) != seconds or seconds <= 0:
        raise ValueError(f"segment length must be a positive number of seconds, not {seconds!r}")
    return int(seconds)


def usable_videos(videos: DataFrame) -> DataFrame:
    """Videos with a plausible duration; others contribute no segments (``implausible_videos``)."""
    return videos.filter(plausible_duration(F.col("duration")))


def implausible_videos(videos: DataFrame) -> DataFrame:
    """The videos that are left out for their duration, with ``error``."""
    return quarantine(videos, {"implausible duration": plausible_duration(F.col("duration"))})[1]


def consecutive_segments(
    videos: DataFrame,
    seconds: int = 30,
    keep_title: bool = False,
    block_segments: int = BLOCK_SEGMENTS,
) -> DataFrame:
    """Cut ``[0, duration)`` of every video into back-to-back segments, the last one short.

    ``keep_title`` carries the title along as ``video_ref``, which saves the later lookup.

    A row of a few bytes becomes many segments, so the compact rows are spread over the cluster
    before they are expanded: an inventory in a handful of files would otherwise be expanded, and
    all work on its segments done, by as many tasks. Videos of more than ``block_segments`` segments
    are spread as blocks, which also bounds every array.
    """
    seconds = check_seconds(seconds)
    last = F.ceil(F.col("duration") / seconds)
    last_block = F.greatest(F.floor(last / block_segments), F.lit(0))
    runs = F.sequence(F.lit(0).cast("bigint"), F.floor(last_block / BLOCK_ROWS))
    first_block = F.col("run") * BLOCK_ROWS
    blocks = F.sequence(first_block, F.least(first_block + (BLOCK_ROWS - 1), last_block))
    # a fixed number of partitions: merging small ones would undo the spreading
    tasks = int(videos.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = (
        usable_videos(videos)
        .filter(F.col("duration") > 0)
        .select("video_id", "title", "duration", F.explode(runs).alias("run"))
        .select("video_id", "title", "duration", F.explode(blocks).alias("block"))
        .repartition(tasks, "video_id", "block")
    )

    first = F.col("block") * block_segments
    # ceil() may be one too high or too low at exact multiples, hence the range ends one later and
    # the filter on the start decides
    numbers = F.sequence(first, F.greatest(first, F.least(first + (block_segments - 1), last)))
    start, duration = F.col("start_time"), F.col("duration")
    cut = (
        spread.select("video_id", "title", "duration", F.explode(numbers).alias("number"))
        .withColumn("start_time", F.col("number") * float(seconds))
        .filter(start < duration)
        .withColumn("end_time", F.least(start + float(seconds), duration))
    )
    return cut.select(
        "video_id",
        "start_time",
        "end_time",
        (F.col("end_time") - start).alias("duration"),
        placeholder_transcript(
            F.col("number") + 1, start, F.col("end_time"), F.col("title")
        ).alias("text"),
        timecode(start).alias("timestamp"),
        *([F.col("title").alias("video_ref")] if keep_title else []),
    )


def segments_with_fallback(
    videos: DataFrame, primary: DataFrame, status: DataFrame, seconds: int = 30
) -> DataFrame:
    """``primary`` segments, plus consecutive ones for videos without a successful extraction.

    ``status`` is ``(video_id, status)`` with ``ok`` for success. A successful extraction that
    found nothing stays empty.
    """
    done = status.filter(F.col("status") == "ok").select("video_id")
    missing = videos.join(done, "video_id", "left_anti")
    return primary.unionByName(consecutive_segments(missing, seconds))
