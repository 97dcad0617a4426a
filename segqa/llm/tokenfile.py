"""Token ids in binary files of patched frame-of-reference blocks.

Every document's ids, closed by an end id, follow each other in ascending ``doc_id`` (nulls first).
A file holds a range of documents::

    magic b"PFR1"
    blocks         512 ids each (the last may be shorter)
    block starts   uint64 byte position of every block
    documents      int64 doc_id, uint8 null flag, uint64 n_tokens each, as three arrays
    footer         uint64 position of block starts, of documents, n_blocks, n_documents, n_tokens

A block subtracts its minimum from all ids and stores the low bits at a width that a percentile of
its ids needs. What exceeds it goes to an exception list: positions and high bits. ::

    uint32 minimum, uint16 count, uint8 width, uint8 high width, uint16 n_exceptions
    packed low bits, uint16 exception positions, packed high bits

Files are written under names of their own and count only once the stored manifest names them, so a
task that is lost or runs twice leaves no trace in what is read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .common import shuffle_tasks, slices
from .tokens import TEXT_BYTES, word_encoder

BLOCK_IDS = 512
PERCENTILE = 0.9
_HEAD = "<IHBBH"
_FOOT = "<QQQQQQ"
_FOOT_BYTES = struct.calcsize(_FOOT)
_HEAD_BYTES = struct.calcsize(_HEAD)
_MAGIC = b"PFR1"


def _pack_bits(values: np.ndarray, width: int) -> bytes:
    bits = (values[:, None] >> np.arange(width, dtype=np.uint32)) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def _unpack_bits(data: bytes, count: int, width: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width, bitorder="little")
    return bits.reshape(count, width) @ (np.uint32(1) << np.arange(width, dtype=np.uint32))


def encode_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """One block of up to 65,535 unsigned 32-bit ids."""
    return encode_blocks(ids[None, :], percentile)[0]


def encode_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> list[bytes]:
    """The blocks in the rows of ``ids``; rows of one width are packed together."""
    count = ids.shape[1]
    low = ids.min(axis=1)
    rest = ids - low[:, None]
    rank = min(count - 1, int(percentile * count))
    width = _bit_length(np.partition(rest, rank, axis=1)[:, rank])
    top = _bit_length(rest.max(axis=1))
    out: list[bytes] = [b""] * len(ids)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        own = rest[rows]
        bits = (own[:, :, None] >> np.arange(w, dtype=np.uint32)).astype(np.uint8) & 1
        packed = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
        above = own >> np.uint32(w) if w < 32 else np.zeros_like(own)
        for row, body, high in zip(rows.tolist(), packed, above):
            odd = np.flatnonzero(high)
            high_width = int(top[row]) - w
            head = struct.pack(_HEAD, int(low[row]), count, w, high_width, len(odd))
            out[row] = head + body.tobytes()
            if len(odd):
                out[row] += odd.astype("<u2").tobytes() + _pack_bits(high[odd], high_width)
    return out


def _bit_length(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1]


def decode_block(data: memoryview) -> np.ndarray:
    low, count, width, high_width, n_odd = struct.unpack_from(_HEAD, data)
    at = _HEAD_BYTES
    size = (count * width + 7) // 8
    rest = _unpack_bits(data[at : at + size], count, width).astype(np.uint32)
    if n_odd:
        odd = np.frombuffer(data, "<u2", n_odd, at + size)
        high = _unpack_bits(data[at + size + 2 * n_odd :], n_odd, high_width).astype(np.uint32)
        rest[odd] |= high << np.uint32(width)
    return rest + np.uint32(low)


def _place(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, block_ids: int = BLOCK_IDS
) -> DataFrame:
    """Write the files below ``path``; return the stored manifest.

    The manifest has a row per file ``(part, file, n_documents, n_tokens, n_bytes)``; parts follow
    each other in ``doc_id`` order. A null text has the end id alone; rows that repeat a ``doc_id``
    lie beside each other in the order of their texts; other columns are ignored. An empty table
    gives an empty manifest. ``path`` must be a folder that all executors reach.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        ids_left = np.empty(0, np.uint32)
        starts, doc_ids, nulls, counts = [], [], [], []
        out, part, at, name = None, 0, len(_MAGIC), f"{uuid.uuid4().hex}.pfr"

        def store(ids: np.ndarray) -> None:
            nonlocal at
            for block in encode_blocks(ids):
                starts.append(at)
                out.write(block)
                at += len(block)

        for batch in slices(batches, "text", TEXT_BYTES):
            if out is None:
                store_fs, folder = _place(path)
                store_fs.create_dir(folder, recursive=True)
                out = store_fs.open_output_stream(f"{folder}/{name}")
                out.write(_MAGIC)
                part = batch.column("_part")[0].as_py()
            ids, bounds = encoder.encode(batch.column("text"))
            ids = np.insert(ids, bounds[1:], np.uint32(end_id))
            counts.append(np.diff(bounds) + 1)
            doc_ids.append(batch.column("doc_id").fill_null(0).to_numpy())
            nulls.append(batch.column("doc_id").is_null().to_numpy(zero_copy_only=False))
            ids = np.concatenate([ids_left, ids])
            whole = len(ids) // block_ids * block_ids
            for begin in range(0, whole, 256 * block_ids):
                store(ids[begin : min(begin + 256 * block_ids, whole)].reshape(-1, block_ids))
            ids_left = ids[whole:]
        if out is None:
            return
        if len(ids_left):
            store(ids_left[None, :])
        counts = np.concatenate(counts)
        out.write(np.array(starts, "<u8").tobytes())
        documents_at = at + 8 * len(starts)
        out.write(np.concatenate(doc_ids).astype("<i8").tobytes())
        out.write(np.concatenate(nulls).astype("u1").tobytes())
        out.write(counts.astype("<u8").tobytes())
        total = int(counts.sum())
        out.write(struct.pack(_FOOT, at, documents_at, len(starts), len(counts), total, block_ids))
        out.close()
        size = documents_at + 17 * len(counts) + _FOOT_BYTES
        row = (part, name, len(counts), total, size)
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in row], _MANIFEST)

    tasks = shuffle_tasks(docs.sparkSession)
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(tasks, "doc_id")
        .sortWithinPartitions("doc_id", "text")
        .withColumn("_part", F.spark_partition_id().cast("long"))
    )
    return materialize(
        ordered.mapInArrow(
            write, "part long, file string, n_documents long, n_tokens long, n_bytes long"
        ),
        "token-manifest",
    )


_MANIFEST = ["part", "file", "n_documents", "n_tokens", "n_bytes"]


class TokenFile:
    """Reads one file: all documents in turn, or any range of ids through the block starts."""

    def __init__(self, source: pa.NativeFile, size: int):
        self.source = source
        self.source.seek(size - _FOOT_BYTES)
        foot = struct.unpack(_FOOT, self.source.read(_FOOT_BYTES))
        self.index_at, self.documents_at, n_blocks, n_documents, self.n_tokens, self.block_ids = foot
        self.source.seek(self.index_at)
        self.starts = np.frombuffer(self.source.read(8 * n_blocks), "<u8")
        tail = self.source.read(17 * n_documents)
        self.doc_ids = np.frombuffer(tail, "<i8", n_documents)
        self.nulls = np.frombuffer(tail, "u1", n_documents, 8 * n_documents)
        self.counts = np.frombuffer(tail, "<u8", n_documents, 9 * n_documents).astype(np.int64)

    def blocks(self, first: int = 0, last: int | None = None) -> Iterator[np.ndarray]:
        last = len(self.starts) if last is None else last
        ends = np.append(self.starts[1:], np.uint64(self.index_at))
        for k in range(first, last):
            self.source.seek(int(self.starts[k]))
            yield decode_block(memoryview(self.source.read(int(ends[k] - self.starts[k]))))

    def ids(self, begin: int, end: int) -> np.ndarray:
        """Ids ``begin`` to ``end`` of the file."""
        if begin >= end:
            return np.empty(0, np.uint32)
        block_ids = self.block_ids
        first = begin // block_ids
        found = np.concatenate([*self.blocks(first, -(-end // block_ids))])
        return found[begin - first * block_ids : end - first * block_ids]

    def documents(self, blocks_at_once: int = 2048) -> Iterator[tuple[int | None, np.ndarray]]:
        """Each document's id and token ids, in the order of the file."""
        held, supply = np.empty(0, np.uint32), self.blocks()
        at = 0
        for doc_id, null, count in zip(self.doc_ids, self.nulls, self.counts):
            if at + count > len(held):
                parts, have = [held[at:]], len(held) - at
                for block in supply:
                    parts.append(block)
                    have += len(block)
                    if have >= count and len(parts) > blocks_at_once:
                        break
                held, at = np.concatenate(parts), 0
            yield None if null else int(doc_id), held[at : at + count]
            at += count


def read_token_files(manifest: DataFrame, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, decoded from the files.

    ``start`` counts the ids of all documents before. ``manifest`` is what the write returned.
    """
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, folder = _place(path)
                with store.open_input_file(f"{folder}/{row['file']}") as source:
                    rows, start = [], row["base"]
                    for doc_id, ids in TokenFile(source, row["n_bytes"]).documents():
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4"))))
                        start += len(ids)
                        if len(rows) == 10_000:
                            yield table(rows)
                            rows = []
                if rows:
                    yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], _READ)

    spark = manifest.sparkSession
    return files.repartition(max(1, shuffle_tasks(spark)), "part").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


_READ = ["doc_id", "start", "n_tokens", "ids_crc32"]


def token_folder(spark: SparkSession) -> str:
    """A new folder for files in the place that executors share."""
    return scratch_path(spark, "tokens")
