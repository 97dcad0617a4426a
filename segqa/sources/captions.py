"""Caption tables and segments made elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import youtube_id
from ..operators.packing import pack_captions


def explode_captions(df: DataFrame, items_col: str = "captions") -> DataFrame:
    """One row per caption from ``(video_id, array<struct<start, duration, text>>)``.

    ``seq`` is the position in the list, which is the order captions are packed in.
    """
    return df.select("video_id", F.posexplode(items_col).alias("seq", "item")).select(
        "video_id", F.col("seq").cast("bigint").alias("seq"), "item.start", "item.duration", "item.text"
    )


def caption_segments(
    urls: DataFrame, captions: DataFrame, seconds: int = 30, **packing
) -> DataFrame:
    """Segments of every video whose URL carries a platform id that has captions.

    ``urls`` is ``(video_id, url)``, ``captions`` is keyed by platform id in ``video_id``. Captions
    that no URL asks for are left out before anything moves. The others are packed once per platform
    id and joined afterwards, so the join moves segments instead of captions.
    """
    wanted = urls.select("video_id", youtube_id(F.col("url")).alias("platform_id")).filter(
        F.col("platform_id").isNotNull()
    )
    ids = wanted.select(F.col("platform_id").alias("video_id")).distinct()
    asked = captions.join(ids, "video_id", "left_semi")
    packed = pack_captions(asked, seconds, **packing).withColumnRenamed("video_id", "platform_id")
    return packed.join(wanted, "platform_id").select(
        "video_id", "start_time", "end_time", "duration", "text", "timestamp"
    )


def unmatched_urls(urls: DataFrame, captions: DataFrame) -> DataFrame:
    """URLs that give no segments, with the reason.

    Rows without an id stay out of the join, where they would all meet under the null key.
    """
    keyed = urls.withColumn("platform_id", youtube_id(F.col("url")))
    known = captions.select(F.col("video_id").alias("platform_id")).distinct()
    no_id = keyed.filter(F.col("platform_id").isNull()).withColumn(
        "reason", F.lit("no platform id")
    )
    no_captions = (
        keyed.filter(F.col("platform_id").isNotNull())
        .join(known, "platform_id", "left_anti")
        .withColumn("reason", F.lit("no captions"))
    )
    return no_id.unionByName(no_captions).select(*urls.columns, "reason")


def adapt_external_segments(df: DataFrame) -> DataFrame:
    """Segments from rows ``(video_id, start_time, duration, text, timestamp)``."""
    return df.select(
        "video_id",
        "start_time",
        (F.col("start_time") + F.col("duration")).alias("end_time"),
        "duration",
        "text",
        "timestamp",
    )
