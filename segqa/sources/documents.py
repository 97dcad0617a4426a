"""Stored datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import DATASET, FLAT_PAIR, SPLIT_DOCUMENT, SPLIT_PAIR


def read_dataset(spark: SparkSession, path: str) -> DataFrame:
    """Saved dataset documents, one row each; absent keys are null.

    A nested document is read whole by one task and must be one file. A file that is no dataset
    document, such as one part of several, is an error. What ``write_document`` stores is read by
    :func:`read_document_pairs`, whatever its size.
    """
    documents = spark.read.schema(DATASET).json(path, multiLine=True)
    parts = ("training_split", "validation_split", "total_videos", "total_qa_pairs", "name")
    readable = F.exists(F.array(*[F.col(p).isNotNull() for p in parts]), lambda found: found)
    message = F.concat(F.lit("not a whole dataset document: "), F.input_file_name())
    # part of a column that every reader needs, so that no plan can leave the check out
    name = F.when(readable, F.col("name")).otherwise(F.raise_error(message).cast("string"))
    return documents.withColumn("name", name)


# Pieces of the frame around the pairs, one line each, as ``write_document`` stores them.
HEAD = r'\A\{"name": '
OPENING = r'\A,?"[^"]+_split": \{"name": '
CLOSING = r"\A\]\}\z"
FOOT = r'\A, "config": '


def read_document_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Pairs of a document stored by ``write_document``, each with its ``split``.

    Each line of the parts is a pair or a piece of the frame around the pairs, so any number of
    tasks read it. Lines that are neither are an error.
    """
    pair = _line_pair(SPLIT_PAIR)
    checked = F.when(_is_pair(pair) | _frame_kind().isNotNull(), pair).otherwise(
        _no_line(SPLIT_PAIR)
    )
    return spark.read.text(path).select(F.inline(F.filter(F.array(checked), _is_pair)))


def _line_pair(schema: T.StructType) -> Column:
    return F.from_json(F.regexp_replace("value", r"\A,(?=\{)", ""), schema)


def _is_pair(pair: Column) -> Column:
    return pair["question"].isNotNull() & pair["split"].isNotNull()


def _frame_kind() -> Column:
    """Which piece of the frame a line is, null for any other line."""
    kinds = {"head": HEAD, "opening": OPENING, "closing": CLOSING, "foot": FOOT}
    return F.coalesce(*[F.when(F.col("value").rlike(p), F.lit(k)) for k, p in kinds.items()])


def _no_line(dtype: T.DataType) -> Column:
    wrong = F.concat(F.lit("not a line of a dataset document: "), F.substring("value", 1, 80))
    return F.raise_error(wrong).cast(dtype)


def read_document_frames(spark: SparkSession, path: str) -> DataFrame:
    """One row per document stored by ``write_document`` in ``path`` or in folders below it.

    ``document`` is the folder of its parts, the other columns what its frame says, and ``splits`` the
    splits in stored order, whatever their names, each with the number of pairs that are really there
    (``qa_pairs``). Parts are read by any number of tasks in one scan; each sums up the pairs it meets,
    so only a row per split and task and the frames themselves are shuffled. A document whose frame is not
    whole, such as one that lost a part with a piece of it, and pairs of a split that the frame does not
    name are errors; a lost part of nothing but pairs shows as a difference to ``total_qa_pairs``.
    """
    pair = _line_pair(T.StructType([f for f in SPLIT_PAIR.fields if f.name in ("split", "question")]))
    kind = F.when(_is_pair(pair), "pair").otherwise(_frame_kind())
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(
        F.regexp_replace("_metadata.file_path", r"/[^/]*\z", "").alias("document"),
        F.coalesce(kind, _no_line(T.StringType())).alias("kind"),
        F.when(_is_pair(pair), pair["split"]).alias("split"),
        F.when(
            ~_is_pair(pair),
            F.struct(
                F.col("_metadata.file_path").alias("part"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("number"),
                F.col("value").alias("text"),
            ),
        ).alias("place"),
    )
    pieces = lines.groupBy("document", "kind", "split", "place").agg(F.count("*").alias("n"))

    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value)

    text = F.col("place.text")
    head = F.from_json(
        F.concat(F.regexp_replace(text, r",\z", ""), F.lit("}")),
        T.StructType([DATASET["name"], DATASET["description"]]),
    )
    opening = F.map_values(
        F.from_json(
            F.concat(F.lit("{"), F.regexp_replace(text, r"\A,", ""), F.lit("]}}")),
            T.MapType(T.StringType(), SPLIT_DOCUMENT),
        )
    )[0]
    known = ("config", "created_at", "total_videos", "total_segments", "total_qa_pairs")
    foot = F.from_json(
        F.concat(F.lit("{"), F.substring(text, F.lit(3), F.length(text))),
        T.StructType([DATASET[name] for name in known]),
    )
    side = F.struct(
        F.struct("place.part", "place.block", "place.number").alias("place"),
        *[opening[name].alias(name) for name in ("name", "llm_s_model", "llm_a_model", "created_at")],
    )
    whole = pieces.groupBy("document").agg(
        *[F.count(of(kind, F.lit(1))).alias(f"{kind}s") for kind in ("head", "opening", "closing", "foot")],
        F.first(of("head", head), ignorenulls=True).alias("head"),
        F.first(of("foot", foot), ignorenulls=True).alias("foot"),
        # no more entries than a document has splits
        F.array_sort(F.collect_list(of("opening", side))).alias("sides"),
        F.map_from_entries(F.collect_list(of("pair", F.struct("split", "n")))).alias("counts"),
    )
    complete = (
        (F.col("heads") == 1) & (F.col("foots") == 1) & (F.col("openings") == F.col("closings"))
    )
    sides = F.col("sides")
    strange = F.array_except(F.map_keys("counts"), F.transform(sides, lambda s: s["name"]))
    checked = (
        F.when(~complete, _broken("not a whole dataset document: "))
        .when(F.size(strange) > 0, _broken("pairs of a split the frame does not name: "))
        .otherwise(sides)
    )
    found = F.transform(
        checked,
        lambda s: F.struct(
            s["name"].alias("name"),
            F.coalesce(F.try_element_at("counts", s["name"]), F.lit(0).cast("bigint")).alias("qa_pairs"),
            *[s[name].alias(name) for name in ("llm_s_model", "llm_a_model", "created_at")],
        ),
    )
    return whole.select("document", "head.*", found.alias("splits"), "foot.*")


def _broken(message: str) -> Column:
    return F.raise_error(F.concat(F.lit(message), F.col("document")))


def dataset_pairs(documents: DataFrame) -> DataFrame:
    """One row per pair of dataset documents, tagged with ``dataset`` and ``split``."""
    sides = F.array(
        *[
            F.struct(
                F.lit(split).alias("split"), F.col(f"{split}_split.qa_pairs").alias("qa_pairs")
            )
            for split in ("training", "validation")
        ]
    )
    return (
        documents.select(F.col("name").alias("dataset"), F.inline(sides))
        .select("dataset", "split", F.explode("qa_pairs").alias("pair"))
        .select("dataset", "split", "pair.*")
    )


def read_splits_json(spark: SparkSession, path: str) -> DataFrame:
    """Pairs written by ``write_splits_json``."""
    return spark.read.schema(SPLIT_PAIR).json(path)


def read_flat(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Pairs written by ``write_flat``, with the split named ``training`` again."""
    reader = spark.readStream if stream else spark.read
    schema = T.StructType([*FLAT_PAIR.fields, T.StructField("split", T.StringType(), True)])
    stored = reader.schema(schema).parquet(path)
    return stored.withColumn(
        "split", F.when(F.col("split") == "train", "training").otherwise(F.col("split"))
    )
