"""Stored forms of a dataset."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.pairs import flatten_pairs
from ..operators.splits import DEFAULT_SPLITS, SplitConfig, known_split
from ..operators.stats import pair_counts, side_by_side
from ..schemas import QA_PAIR
from ..session import materialize

# Settings with one of these in their name never reach a file.
SECRET_MARKS = ("key", "token", "secret", "password", "credential")


def public_config(config: Mapping | None) -> dict:
    """``config`` without secrets, at any depth."""
    return {
        name: public_config(value) if isinstance(value, Mapping) else value
        for name, value in (config or {}).items()
        if not any(mark in name.lower() for mark in SECRET_MARKS)
    }


def write_splits_json(pairs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON lines, one folder per split."""
    pairs.select("split", *QA_PAIR.names).write.mode(mode).partitionBy("split").json(path)


def write_flat(pairs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet of the flat columns, in the folders ``split=train`` and ``split=validation``."""
    stored = F.when(F.col("split") == "training", "train").otherwise(F.col("split"))
    flatten_pairs(pairs).withColumn("split", stored).write.mode(mode).partitionBy(
        "split"
    ).parquet(path)


def dataset_info(
    totals: DataFrame,
    pairs: DataFrame,
    name: str,
    description: str,
    config: Mapping | None = None,
    splits: Sequence[SplitConfig] = DEFAULT_SPLITS,
) -> DataFrame:
    """One row: name, description, totals, pairs per split, creation time, public configuration.

    Pairs are counted once, per split; their total is the sum. ``totals`` needs the numbers of
    videos and segments only.
    """
    counts = pair_counts(pairs).withColumn("split", known_split(splits))
    names = [s.name for s in splits]
    per_split = counts.agg(
        F.coalesce(F.sum("qa_pairs"), F.lit(0)).alias("total_qa_pairs"),
        *[
            F.coalesce(F.sum(F.when(F.col("split") == s, F.col("qa_pairs"))), F.lit(0)).alias(
                f"{s}_qa_pairs"
            )
            for s in names
        ],
    )
    videos_and_segments = totals.select("total_videos", "total_segments")
    return side_by_side(videos_and_segments, per_split).select(
        F.lit(name).alias("name"),
        F.lit(description).alias("description"),
        "total_videos",
        "total_segments",
        "total_qa_pairs",
        *[f"{s}_qa_pairs" for s in names],
        F.lit(datetime.now().isoformat()).alias("created_at"),
        F.lit(json.dumps(public_config(config), default=str)).alias("config"),
    )


def write_dataset_info(info: DataFrame, path: str, mode: str = "errorifexists") -> None:
    info.write.mode(mode).json(path)


def write_document(
    pairs: DataFrame,
    info: DataFrame,
    path: str,
    splits: Sequence[SplitConfig] = DEFAULT_SPLITS,
    mode: str = "errorifexists",
) -> None:
    """One nested JSON document, written as text parts that form it when read in name order.

    ``info`` is the row of :func:`dataset_info`. Every pair names its split, so
    ``read_document_pairs`` can read the lines apart again. No task holds the document: each line is one pair
    or a piece of the frame around the pairs, and a range sort puts them in order. The pairs are
    stored once beforehand so that their line numbers do not change between the passes.
    """
    names = [s.name for s in splits]  # a pair of any other split is an error
    position = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("split"))
    numbered = materialize(
        pairs.withColumn("split", known_split(splits))
        .select("split", F.to_json(F.struct("split", *QA_PAIR.names)).alias("line"))
        .withColumn("number", F.monotonically_increasing_id()),
        "document-lines",
    )
    # one row per split; a pair is preceded by a comma unless it is the first of its split
    first = numbered.groupBy(F.col("split").alias("of")).agg(F.min("number").alias("first"))
    lines = numbered.join(F.broadcast(first), F.col("split") == F.col("of")).select(
        (position * 2).cast("int").alias("section"),
        "number",
        F.concat(F.when(F.col("number") == F.col("first"), "").otherwise(","), "line").alias(
            "value"
        ),
    )

    def text(value: str):
        return F.lit(value)

    def quoted(column: str):
        # a one-element JSON array without its brackets is the escaped text
        as_json = F.to_json(F.array(F.col(column)))
        return F.substring(as_json, F.lit(2), F.length(as_json) - 2)

    frame = []
    for i, s in enumerate(splits, 1):
        opening = (
            f'{"," if i > 1 else ""}"{s.name}_split": {{"name": {json.dumps(s.name)}, '
            f'"llm_s_model": {json.dumps(s.llm_s_model)}, "llm_a_model": {json.dumps(s.llm_a_model)}, '
            '"created_at": '
        )
        frame.append((2 * i - 1, F.concat(text(opening), quoted("created_at"), text(', "qa_pairs": ['))))
        frame.append((2 * i, text("]}")))
    head = F.concat(
        text('{"name": '), quoted("name"), text(', "description": '), quoted("description"), text(",")
    )
    foot = F.concat(
        text(', "config": '),
        F.col("config"),
        text(', "created_at": '),
        quoted("created_at"),
        *[
            F.concat(text(f', "{c}": '), F.col(c).cast("string"))
            for c in ("total_videos", "total_segments", "total_qa_pairs")
        ],
        text("}"),
    )
    frame = [(0, head), *frame, (2 * len(splits) + 1, foot)]
    # the closing piece of a split sorts behind its pairs, everything else stands alone in its section
    structs = F.array(
        *[
            F.struct(
                F.lit(section).alias("section"),
                F.lit((1 << 63) - 1).alias("number"),
                value.alias("value"),
            )
            for section, value in frame
        ]
    )
    (
        lines.unionByName(info.select(F.inline(structs)))
        .orderBy("section", "number")
        .select("value")
        .write.mode(mode)
        .text(path)
    )
