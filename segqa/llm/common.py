"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BLANKS = "[\\x20\\x09-\\x0D]"  # the six ASCII blanks that separate words
WORD = "[^\\x20\\x09-\\x0D]+"
TEXT_ROWS = 1024  # whole texts handed to a Python task at once


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def clear_text(text: str | Column = "text") -> Column:
    """The whole text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


# Names of columns that travel beside the caller's own; names with this prefix are reserved.
KEY = ["__segqa_id", "__segqa_h1", "__segqa_h2"]


def row_key(id_col: str, text: Column) -> dict[str, Column]:
    """Identity of a row by its id and content: repeated rows share it and get the same decision."""
    return dict(zip(KEY, (F.col(id_col), F.xxhash64(text), F.hash(text))))


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Whether two tables' rows are the same by ``KEY``; ids may be null."""
    found = left[KEY[0]].eqNullSafe(right[KEY[0]])
    for name in KEY[1:]:
        found &= left[name] == right[name]
    return found


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker.

    Task functions are shipped by value, so their module globals are new in every task; what is
    costly to build (a tokenizer and its words) is kept here for the worker's next tasks.
    """
    return sys.modules.setdefault("_segqa_worker", types.ModuleType("_segqa_worker")).__dict__


def give_back() -> None:
    """Return to the system what a task took and let go: the worker stays for other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps freed arrays otherwise
    if trim:
        trim(0)


def slices(
    batches: Iterable[pa.RecordBatch], column: str, max_bytes: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``max_bytes`` in each, one row at least."""
    for batch in batches:
        offsets = pa.compute.cumulative_sum(
            pa.compute.cast(
                pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), pa.int64()
            )
        ).to_numpy()
        begin, done = 0, 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(offsets.searchsorted(done + max_bytes, side="right")))
            yield batch.slice(begin, end - begin)
            begin, done = end, int(offsets[end - 1])
    give_back()
