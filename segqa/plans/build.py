"""From videos to a stored dataset."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.inference import Provider, call_report
from ..operators.packing import pack_captions
from ..operators.pairs import UNKNOWN_VIDEO, generate_qa
from ..operators.quality import require_rows
from ..operators.responses import ResponseLog
from ..operators.splits import DEFAULT_SPLITS, SplitConfig
from ..operators.stats import dataset_totals, split_stats
from ..operators.timeline import consecutive_segments, plausible_duration, usable_videos
from ..session import materialize, release, scratch_scope
from ..sinks.writers import (
    dataset_info,
    write_dataset_info,
    write_document,
    write_flat,
    write_splits_json,
)


@dataclass(frozen=True)
class Dataset:
    """Tables of a built dataset; ``pairs`` and ``segments`` are stored tables.

    ``calls`` counts requests and failures per kind of call and model, None if no model was called.
    ``report`` counts what was read and what was left out, by reason. ``release`` deletes the stored
    tables, after which only the files below ``out`` can be read.
    """

    segments: DataFrame
    pairs: DataFrame
    stats: DataFrame
    info: DataFrame
    calls: DataFrame | None
    report: DataFrame
    scratch: list[str] = field(default_factory=list)

    def release(self) -> None:
        release(self.report.sparkSession, self.scratch)


def drop_report(videos: DataFrame, segments: DataFrame) -> DataFrame:
    """``(stage, reason, rows)``: what was read, and what is left out and why.

    ``segments`` with the blank ones. Both tables are read once, videos by their duration alone.
    """
    duration = F.col("duration")
    known, plausible = duration.isNotNull() & ~F.isnan("duration"), plausible_duration(duration)

    def counted(table: DataFrame, stage: str, reasons: Mapping) -> DataFrame:
        row = table.agg(F.count("*").alias("read"), *(F.count_if(c).alias(r) for r, c in reasons.items()))
        lines = F.array(*(F.struct(F.lit(r).alias("reason"), F.col(r).alias("rows")) for r in row.columns))
        return row.select(F.lit(stage).alias("stage"), F.inline(lines))

    left_out = {
        "no duration": ~known,
        "implausible duration": known & ~plausible,
        "no length": plausible & (duration <= 0),
    }
    return counted(videos, "videos", left_out).unionByName(
        counted(segments, "segments", {"blank": F.col("text") == ""})
    )


def extract_all(
    videos: DataFrame,
    captions: DataFrame | None = None,
    seconds: int = 30,
    keep_blank: bool = False,
) -> DataFrame:
    """Titled segments of every usable video: from its captions, else at fixed intervals.

    A video without any caption falls back to fixed intervals; one whose captions hold no text has
    been transcribed and stays without segments. Captions of other videos are left out, and
    segments without text unless ``keep_blank``.
    """
    if captions is None:
        return consecutive_segments(videos, seconds, keep_title=True)
    transcribed = captions.select("video_id").distinct()
    titles = usable_videos(videos).select(
        "video_id", F.coalesce("title", F.lit(UNKNOWN_VIDEO)).alias("video_ref")
    )
    packed = pack_captions(
        captions.join(titles.select("video_id"), "video_id", "left_semi"),
        seconds,
        keep_blank=keep_blank,
    )
    rest = videos.join(transcribed, "video_id", "left_anti")
    return packed.join(titles, "video_id").unionByName(
        consecutive_segments(rest, seconds, keep_title=True)
    )


def build_dataset(
    videos: DataFrame,
    out: str,
    name: str,
    description: str = "",
    captions: DataFrame | None = None,
    seconds: int = 30,
    splits: Sequence[SplitConfig] = DEFAULT_SPLITS,
    provider: Provider | None = None,
    config: Mapping | None = None,
    document: bool = False,
    mode: str = "errorifexists",
    log: ResponseLog | None = None,
) -> Dataset:
    """Segments, pairs for every split, files below ``out`` and statistics.

    Writes ``flat/``, ``splits/``, ``info/`` and ``report/`` (what was left out and why), the nested
    ``document/`` on request, and ``calls/`` with the failures of called models. Fails if there are no videos or no segments; having no pairs
    is allowed. With a ``log`` a build that was cut short, or one more with the same data, asks only
    what no earlier one has asked.
    """
    with scratch_scope() as scratch:
        require_rows(videos, "videos")
        # stored with the blank ones, so that they are counted without another pass over captions
        extracted = materialize(extract_all(videos, captions, seconds, keep_blank=True), "segments")
        segments = require_rows(extracted.filter(F.col("text") != ""), "transcript segments")
        report = drop_report(videos, extracted)
        responses: list[DataFrame] = []
        pairs = materialize(
            generate_qa(segments, splits=splits, provider=provider, calls=responses, log=log), "pairs"
        )
        info = dataset_info(
            dataset_totals(videos, segments), pairs, name, description, config, splits
        )
        out = out.rstrip("/")
        write_flat(pairs, f"{out}/flat", mode)
        write_splits_json(pairs, f"{out}/splits", mode)
        write_dataset_info(info, f"{out}/info", mode)
        report.coalesce(1).write.mode(mode).json(f"{out}/report")
        if document:
            write_document(pairs, info, f"{out}/document", splits, mode)
        calls = call_report(*responses) if responses else None
        if calls is not None:
            calls.write.mode(mode).json(f"{out}/calls")
    return Dataset(segments, pairs, split_stats(pairs, splits), info, calls, report, scratch)
