"""Splits: model pairs per split, assignment by ratio, bounded nesting."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SplitConfig:
    """A split and the models that write and answer its questions."""

    name: str
    llm_s_model: str = "placeholder-llm-s"
    llm_a_model: str = "placeholder-llm-a"


DEFAULT_SPLITS = (SplitConfig("training"), SplitConfig("validation"))


def _as_structs(splits: Sequence[SplitConfig]) -> Column:
    return F.array(
        *[
            F.struct(
                F.lit(s.name).alias("split"),
                F.lit(s.llm_s_model).alias("llm_s_model"),
                F.lit(s.llm_a_model).alias("llm_a_model"),
            )
            for s in splits
        ]
    )


def split_config(spark: SparkSession, splits: Sequence[SplitConfig] = DEFAULT_SPLITS) -> DataFrame:
    """One row per split."""
    return spark.range(1).select(F.inline(_as_structs(splits)))


def known_split(splits: Sequence[SplitConfig]) -> Column:
    """The ``split`` column; a name that is not configured is an error, never left out."""
    split = F.col("split")
    unknown = F.concat(F.lit("split is not configured: "), F.coalesce(split, F.lit("null")))
    return F.when(split.isin([s.name for s in splits]), split).otherwise(
        F.raise_error(unknown).cast("string")
    )


def expand_splits(
    df: DataFrame, splits: Sequence[SplitConfig] = DEFAULT_SPLITS, where: Column | None = None
) -> DataFrame:
    """Every row once per split, with the split's models; only rows for which ``where`` holds.

    The splits are constants of the plan, so this expands rows in place without a join. ``where`` is
    tested on computed columns as they are, whereas a filter would be pushed below the computation
    and repeat it.
    """
    structs = _as_structs(splits)
    return df.select("*", F.inline(structs if where is None else F.when(where, structs)))


def assign_split(df: DataFrame, ratio: float = 0.8, key: str = "video_id") -> DataFrame:
    """Add ``split`` by a hash of ``key``: all rows of one video fall on the same side.

    The share of training keys is ``ratio``, which must lie strictly between 0 and 1.
    """
    return df.withColumn(
        "split",
        F.when(
            F.substring(F.md5(F.col(key).cast("string")), 1, 4) < ratio_threshold(ratio),
            "training",
        ).otherwise("validation"),
    )


def ratio_threshold(ratio: float) -> str:
    """The first four hex digits from which on a key belongs to validation."""
    if not 0 < ratio < 1:
        raise ValueError("the training share must lie strictly between 0 and 1")
    return f"{int(ratio * 65536):04x}"


def nest_splits(
    pairs: DataFrame, block_seconds: int = 30 * 1024, created_at: datetime | None = None
) -> DataFrame:
    """Pairs collected under their split, models, video and time block, with ``created_at``.

    All rows carry one creation time, by default that of the call. A split as a single row would hold an unbounded share of all pairs. Segments of a video do not
    overlap, so a block of its timeline bounds each row; a split is the set of its rows.
    """
    source = F.col("source_document")
    return (
        pairs.withColumn("video_id", source["video_id"])
        .withColumn("block", F.floor(source["start_time"] / block_seconds))
        .groupBy(F.col("split").alias("name"), "llm_s_model", "llm_a_model", "video_id", "block")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        source["start_time"].alias("start_time"),
                        "question",
                        "answer",
                        "source_document",
                        "is_answerable_without_context",
                        "is_answerable_with_context",
                    )
                )
            ).alias("qa_pairs")
        )
        .withColumn("created_at", F.lit(created_at or datetime.now()).cast("timestamp_ntz"))
    )


def union_splits(*parts: DataFrame) -> DataFrame:
    """Rows of all parts, columns matched by name."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union
