"""Exact deduplication by Grace hashing over complete contents.

Contents (the text without ASCII blanks) are first combined within each input task, so a content
leaves a task at most once per table however many copies it has. They are then dealt by content hash;
each task partitions its share recursively into spill files until a bucket fits an open-addressing
table, which compares complete contents. Only one row per distinct content and task is dealt this
way; the documents find their class by the content's SHA-256 in a join of narrow rows, which
adaptive execution splits where one content holds much of the table. Two contents with one SHA-256
are told apart by the comparison and end the job with an error.

Spill files are scratch of one task attempt, as Spark's own spills are: nothing else reads them, they are
gone when the attempt ends, and a task that is lost starts anew from the shuffled records.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_tasks

BLANK_BYTES = b" \t\n\x0b\x0c\r"
TABLE_BYTES = 64 << 20
FANOUT = 16


class ContentTable:
    """Open addressing with linear probing; equal means equal in every byte."""

    def __init__(self) -> None:
        self.slots: list[int] = [-1] * 1024
        self.rows: list[list] = []  # key, content, best length, best id, members
        self.bytes = 0

    def add(self, key: bytes, content: bytes, length: int, doc_id: int | None, members: int) -> None:
        mask = len(self.slots) - 1
        at = int.from_bytes(key[:8], "little") & mask
        while (k := self.slots[at]) >= 0:
            row = self.rows[k]
            if row[1] == content:
                row[4] += members
                if _better(length, doc_id, row[2], row[3]):
                    row[2:4] = length, doc_id
                return
            if row[0] == key:
                raise ValueError("two contents share a SHA-256")
            at = (at + 1) & mask
        self.slots[at] = len(self.rows)
        self.rows.append([key, content, length, doc_id, members])
        self.bytes += len(content) + 200
        if 2 * len(self.rows) > len(self.slots):
            self._grow()

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for k, row in enumerate(self.rows):
            at = int.from_bytes(row[0][:8], "little") & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = k


def _better(length: int, doc_id: int | None, than: int, than_id: int | None) -> bool:
    """More code points first, then the smaller id; a null id comes last."""
    if length != than:
        return length > than
    return doc_id is not None and (than_id is None or doc_id < than_id)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        columns = [batch.column(name) for name in _RECORD]
        for row in range(batch.num_rows):
            yield tuple(column[row].as_py() for column in columns)


def _grace(
    records: Iterator[tuple], folder: str, table_bytes: int, level: int = 0
) -> Iterator[list[list]]:
    """Tables that together hold every distinct content of ``records`` once."""
    table, files = ContentTable(), None
    for record in records:
        if files is None:
            table.add(*record)
            if table.bytes > table_bytes and level < 8:
                # the table is full: it and all that follow go to the files of the next level
                place = Path(tempfile.mkdtemp(dir=folder))
                files = [open(place / f"{k}.spill", "wb") for k in range(FANOUT)]
                for row in table.rows:
                    _spill(files, row, level)
                table = ContentTable()
        else:
            _spill(files, record, level)
    if files is None:
        if table.rows:
            yield table.rows
        return
    for file in files:
        file.close()
    for file in files:
        yield from _grace(_unspill(file.name), folder, table_bytes, level + 1)


def _spill(files: list, record: tuple, level: int) -> None:
    # another byte of the digest at each level than those that address the table
    pickle.dump(tuple(record), files[record[0][8 + level] % FANOUT], pickle.HIGHEST_PROTOCOL)


def _unspill(name: str) -> Iterator[tuple]:
    with open(name, "rb") as file:
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                break
    Path(name).unlink()


_RECORD = ["key", "content", "length", "doc_id", "members"]


def _normalised(batch: pa.RecordBatch) -> Iterator[tuple[int | None, int, bytes]]:
    """Id, code points of the original text and the content's bytes, row by row."""
    for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
        text = text.as_py() or ""
        yield doc_id.as_py(), len(text), text.encode().translate(None, BLANK_BYTES)


def exact_classes(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """``(key, keep_id, keep_length, group_size)`` per distinct content; ``key`` is its SHA-256."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable()
        for batch in batches:
            for doc_id, length, content in _normalised(batch):
                table.add(hashlib.sha256(content).digest(), content, length, doc_id, 1)
                if table.bytes > table_bytes:
                    yield from _emit(table.rows)
                    table = ContentTable()
        yield from _emit(table.rows)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:  # this task's own, gone at its end
            for rows in _grace(_records(batches), folder, table_bytes):
                for begin in range(0, len(rows), 10_000):
                    part = rows[begin : begin + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([r[0] for r in part], pa.binary()),
                            pa.array([r[3] for r in part], pa.int64()),
                            pa.array([r[2] for r in part], pa.int64()),
                            pa.array([r[4] for r in part], pa.int64()),
                        ],
                        ["key", "keep_id", "keep_length", "group_size"],
                    )

    records = docs.select("doc_id", "text").mapInArrow(
        combine, "key binary, content binary, length long, doc_id long, members long"
    )
    return records.repartition(shuffle_tasks(docs.sparkSession), "key").mapInArrow(
        merge, "key binary, keep_id long, keep_length long, group_size long"
    )


def _emit(rows: list[list]) -> Iterator[pa.RecordBatch]:
    for begin in range(0, len(rows), 1000):
        columns = zip(*rows[begin : begin + 1000])
        types = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], _RECORD
        )


def exact_duplicates(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Verdict for every row: ``(doc_id, keep_id, group_size, kept, text_sha256)``.

    Of equal contents the row with most code points stays, then the smallest ``doc_id``. A null text
    counts as empty; all empty texts are one group. A null ``doc_id`` comes after all others. Rows
    that repeat a ``doc_id`` and a text share the verdict and each count in ``group_size``. Other
    columns of ``docs`` are ignored. No rows, no result rows.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, keys = [], []
            for _, length, content in _normalised(batch):
                lengths.append(length)
                keys.append(hashlib.sha256(content).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(keys, pa.binary())],
                ["doc_id", "length", "key"],
            )

    members = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        digest, "doc_id long, length long, key binary"
    )
    classes = exact_classes(docs, table_bytes)
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("length") == F.col("keep_length"))
    return members.join(classes, "key").select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("key")).alias("text_sha256")
    )
