"""Statistics and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .splits import DEFAULT_SPLITS, SplitConfig, known_split, split_config


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Pairs per split and how many are answerable each way."""
    return pairs.groupBy("split").agg(
        F.count("*").alias("qa_pairs"),
        F.count_if("is_answerable_without_context").alias("answerable_without_context"),
        F.count_if("is_answerable_with_context").alias("answerable_with_context"),
    )


def split_stats(pairs: DataFrame, splits: Sequence[SplitConfig] = DEFAULT_SPLITS) -> DataFrame:
    """Counts, ratios and models per split; a split without pairs has zeros.

    Pairs of a split that is not in ``splits`` are an error.
    """
    counts = pair_counts(pairs)
    config = split_config(pairs.sparkSession, splits)
    # the full join keeps what is not configured, so that it is seen
    stats = config.join(counts, "split", "full").withColumn("split", known_split(splits))

    def count(name: str) -> Column:
        return F.coalesce(name, F.lit(0).cast("bigint"))

    def ratio(name: str) -> Column:
        share = F.try_divide(F.col(name).cast("double"), F.col("qa_pairs"))
        return F.coalesce(share, F.lit(0.0))

    return stats.select(
        "split",
        count("qa_pairs").alias("qa_pairs"),
        count("answerable_without_context").alias("answerable_without_context"),
        ratio("answerable_without_context").alias("answerable_without_context_ratio"),
        count("answerable_with_context").alias("answerable_with_context"),
        ratio("answerable_with_context").alias("answerable_with_context_ratio"),
        "llm_s_model",
        "llm_a_model",
    )


def dataset_totals(
    videos: DataFrame, segments: DataFrame, pairs: DataFrame | None = None
) -> DataFrame:
    """One row; a segment counts once although every split uses it.

    Without ``pairs`` their number is left out: ``dataset_info`` counts them per split anyway.
    """
    totals = [
        videos.agg(F.count("*").alias("total_videos")),
        segments.agg(F.count("*").alias("total_segments")),
    ]
    if pairs is not None:
        totals.append(pairs.agg(F.count("*").alias("total_qa_pairs")))
    return side_by_side(*totals)


def side_by_side(*rows: DataFrame) -> DataFrame:
    """One row with the columns of several one-row tables, without joining them."""
    union = rows[0]
    for row in rows[1:]:
        union = union.unionByName(row, allowMissingColumns=True)
    return union.agg(*[F.max(name).alias(name) for row in rows for name in row.columns])


def analyze_dataset(documents: DataFrame) -> DataFrame:
    """``(dataset, metric, value)`` rows of stored dataset documents, in report order by ``line``."""

    def text(name: str, default: str) -> Column:
        return F.coalesce(F.col(name), F.lit(default))

    def number(value: Column) -> Column:
        return F.coalesce(value, F.lit(0)).cast("string")

    dataset = text("name", "Unknown")
    rows = [
        ("total_videos", number(F.col("total_videos"))),
        ("total_segments", number(F.col("total_segments"))),
        ("total_qa_pairs", number(F.col("total_qa_pairs"))),
    ]
    for side in ("training", "validation"):
        rows += [
            (f"{side}_qa_pairs", number(F.array_size(F.col(f"{side}_split.qa_pairs")))),
            (f"{side}_llm_s_model", text(f"{side}_split.llm_s_model", "Unknown")),
            (f"{side}_llm_a_model", text(f"{side}_split.llm_a_model", "Unknown")),
        ]
    rows += [
        ("created_at", text("created_at", "Unknown")),
        ("description", text("description", "No description")),
    ]
    lines = F.array(
        *[
            F.struct(F.lit(i).alias("line"), F.lit(m).alias("metric"), v.alias("value"))
            for i, (m, v) in enumerate(rows, 1)
        ]
    )
    return documents.select(dataset.alias("dataset"), F.inline(lines))


def analyze_documents(frames: DataFrame) -> DataFrame:
    """``(document, dataset, line, metric, value)`` rows of documents of any size and any splits.

    ``frames`` comes from ``read_document_frames``. The metrics are those of :func:`analyze_dataset`, with
    three lines for each split that the document names, in its order; absent values read the same.
    """

    def text(value: Column, default: str) -> Column:
        return F.coalesce(value, F.lit(default))

    def number(value: Column) -> Column:
        return F.coalesce(value, F.lit(0)).cast("string")

    def rows(first: Column | int, *metrics: tuple[Column, Column]) -> Column:
        return F.array(
            *[
                F.struct(
                    (F.lit(first) + F.lit(i)).cast("int").alias("line"),
                    metric.alias("metric"),
                    value.alias("value"),
                )
                for i, (metric, value) in enumerate(metrics)
            ]
        )

    totals = ("total_videos", "total_segments", "total_qa_pairs")
    sides = F.transform(
        "splits",
        lambda s, i: rows(
            F.lit(len(totals) + 1) + i * 3,
            (F.concat(s["name"], F.lit("_qa_pairs")), number(s["qa_pairs"])),
            *[
                (F.concat(s["name"], F.lit(f"_{model}")), text(s[model], "Unknown"))
                for model in ("llm_s_model", "llm_a_model")
            ],
        ),
    )
    lines = F.concat(
        rows(1, *[(F.lit(name), number(F.col(name))) for name in totals]),
        F.flatten(sides),
        rows(
            F.lit(len(totals) + 1) + F.size("splits") * 3,
            (F.lit("created_at"), text(F.col("created_at"), "Unknown")),
            (F.lit("description"), text(F.col("description"), "No description")),
        ),
    )
    return frames.select(
        "document", text(F.col("name"), "Unknown").alias("dataset"), F.inline(lines)
    )


def stats_report(stats: DataFrame, splits: Sequence[SplitConfig] = DEFAULT_SPLITS) -> DataFrame:
    """One row per metric, one column per split of ``splits``; ratios with three decimals."""
    ratios = {"answerable_without_context_ratio", "answerable_with_context_ratio"}
    metrics = [
        (c, F.format_string("%.3f", c) if c in ratios else F.col(c).cast("string"))
        for c in stats.columns
        if c != "split"
    ]
    lines = F.array(
        *[
            F.struct(F.lit(i).alias("line"), F.lit(m).alias("metric"), v.alias("value"))
            for i, (m, v) in enumerate(metrics, 1)
        ]
    )
    return (
        stats.withColumn("split", known_split(splits))
        .select("split", F.inline(lines))
        .groupBy("line", "metric")
        .pivot("split", [s.name for s in splits])
        .agg(F.first("value"))
    )
