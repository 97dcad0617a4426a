"""Video inventories and probe output."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import file_stem
from ..schemas import ENTRY, PROBE
from ..session import materialize
from ..storage import place

# Accepted file suffixes, compared in lower case.
VIDEO_SUFFIXES = ("mp4", "avi", "mov", "mkv", "webm", "flv", "wmv")

# Entries of a folder that a task holds at once.
LISTED_ROWS = 8192


def scan_videos(spark: SparkSession, root: str, hidden: bool = True) -> DataFrame:
    """Video files below the folder ``root`` as ``(path, length)``; fails if it is missing.

    Only names and sizes are read, never file contents. Folders are listed by tasks, all of one depth
    at a time, in any store Arrow knows, whatever their names start with; links to files count, links
    to folders are not followed. A folder that cannot be read, or vanishes meanwhile, is an error.
    The listing is stored when the function is called, so all uses of it agree.

    ``hidden=False`` leaves the listing to Spark's file source, which knows other stores too, skips
    names starting with ``.`` or ``_`` and keeps the list on the driver.
    """
    if hidden:
        return _listed_videos(spark, root)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length")
    )
    return filter_video_paths(files)


def _listed_videos(spark: SparkSession, root: str) -> DataFrame:
    """One job per depth of the tree; a folder is listed by one task, which streams its entries."""
    if "://" not in root and not root.startswith("file:"):
        root = os.path.abspath(root)
    store, base = place(root.rstrip("/") or "/")
    local = store.type_name == "local"
    prefix = "file:" if local else root.rstrip("/").removesuffix(base)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    list_folders = _folder_lister(root)
    frontier = spark.createDataFrame([(base,)], "path string")
    found = []
    while not found or not frontier.isEmpty():
        entries = frontier.repartition(tasks, "path").mapInArrow(list_folders, ENTRY)
        # other files are never stored
        listed = materialize(entries.filter(F.col("folder") | _is_video(F.col("path"))), "listing")
        found.append(listed.filter(~F.col("folder")))
        frontier = listed.filter("folder").select("path")
    files = reduce(DataFrame.unionByName, found)
    return files.select(F.concat(F.lit(prefix), "path").alias("path"), "length")


def _folder_lister(root: str):
    def list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("length", pa.int64()), ("folder", pa.bool_())])
        store, _ = place(root)
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                entries = _entries(store, folder)
                while rows := list(islice(entries, LISTED_ROWS)):
                    columns = zip(*rows)
                    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return list_folders


def _entries(store: fs.FileSystem, folder: str) -> Iterator[tuple[str, int | None, bool]]:
    """Files and folders directly in ``folder``."""
    if store.type_name != "local":
        for info in store.get_file_info(fs.FileSelector(folder)):
            if info.type in (fs.FileType.File, fs.FileType.Directory):
                yield info.path, info.size, info.type == fs.FileType.Directory
        return
    try:
        entries = os.scandir(folder)
    except FileNotFoundError as missing:
        raise FileNotFoundError(f"{folder} does not exist") from missing
    with entries:
        for entry in entries:
            if entry.is_dir(follow_symlinks=False):
                yield entry.path, None, True
            elif entry.is_file():
                yield entry.path, entry.stat().st_size, False


def filter_video_paths(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Keep rows whose file name is not only a suffix and ends in a video suffix."""
    return df.filter(_is_video(F.col(path_col)))


def _is_video(path: Column) -> Column:
    return F.lower(path).rlike(rf"[^/]\.({'|'.join(VIDEO_SUFFIXES)})\z")


def parse_probe(df: DataFrame, json_col: str = "probe") -> DataFrame:
    """Add ``duration``, ``width`` and ``height`` of the first video stream of a probe document.

    Rows without a video stream, or with a missing or malformed number, are dropped.
    """
    return (
        df.withColumn("_probe", probe_fields(F.col(json_col)))
        .filter(probe_is_complete(F.col("_probe")))
        .select(
            *[F.col(c) for c in df.columns],
            "_probe.duration",
            "_probe.width",
            "_probe.height",
        )
    )


def probe_fields(json: Column) -> Column:
    """``struct(has_video, duration, width, height)``; unreadable numbers are null."""
    probe = F.from_json(json, PROBE)
    kind = "codec_type"
    # a stream of unknown kind ahead of the first video stream makes the document unreadable
    stream = F.try_element_at(
        F.filter(probe["streams"], lambda s: s[kind].isNull() | (s[kind] == "video")), F.lit(1)
    )
    return F.struct(
        stream[kind].isNotNull().alias("has_video"),
        _number(probe["format"]["duration"]).alias("duration"),
        stream["width"].try_cast("int").alias("width"),
        stream["height"].try_cast("int").alias("height"),
    )


def probe_is_complete(fields: Column) -> Column:
    return (
        fields["has_video"]
        & fields["duration"].isNotNull()
        & fields["width"].isNotNull()
        & fields["height"].isNotNull()
    )


def _number(text: Column) -> Column:
    # Java also reads "12d" and "12f" as numbers; infinities and NaN would never end a timeline
    plain = text.rlike(r"\A\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z")
    number = F.when(plain, text.try_cast("double"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def video_manifest(df: DataFrame, out: str, path_col: str = "path") -> DataFrame:
    """Add a stable ``video_id``, ``title`` and target ``file_path`` per accepted video.

    The id is a hash of the source path, so reruns and retried tasks agree on it.
    """
    path = F.col(path_col)
    return (
        df.withColumn("video_id", F.sha2(path, 256))
        .withColumn("title", file_stem(path))
        .withColumn(
            "file_path", F.concat(F.lit(out.rstrip("/") + "/"), F.col("video_id"), F.lit(".mp4"))
        )
        .withColumn("source_url", F.lit(None).cast("string"))
    )


def process_videos(inventory: DataFrame, out: str, json_col: str = "probe") -> DataFrame:
    """Videos table from an inventory ``(path, probe)``: suffix filter, probe fields, manifest."""
    videos = video_manifest(parse_probe(filter_video_paths(inventory), json_col), out)
    return videos.select("video_id", "title", "duration", "file_path", "source_url")
