"""Responses kept from run to run, so that no request is paid for twice.

A log is a folder of Parquet files. Requests are dealt into its buckets by a hash of their id. The task
that asks a bucket's requests first looks them up in the bucket's files and then appends every batch of
answers as one file as soon as it has it: a task that is tried again, or a job that is started again,
asks only what is missing. Nothing is shuffled or joined for that beyond the requests themselves.

A file is named after the requests in it and appears whole or not at all, so that writing it again
changes nothing. Two attempts of a task may still answer one request each: readers take the first by
name, an answer before a failure. Files are only added until ``compact`` merges those of each bucket.
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RESPONSE
from ..storage import names, place, publish

_SCHEMA = pa.schema([(f.name, pa.string()) for f in RESPONSE.fields])
BUCKETS = 256


class ResponseLog:
    """Responses stored below ``path``, a folder that all executors reach.

    ``buckets`` counts for a new log, an old one keeps its own: a task reads a bucket's files once for
    each of its Arrow batches of requests. With ``retry_failures`` requests whose call failed before
    are asked again; an answer then replaces the failure.
    """

    def __init__(self, path: str, buckets: int = BUCKETS, retry_failures: bool = False):
        if buckets < 1:
            raise ValueError("a log needs a bucket")
        self.path, self.retry_failures = path.rstrip("/"), retry_failures
        store, folder = place(self.path)
        head = f"{folder}/_log.json"
        if not store.get_file_info(head).is_file:
            publish(store, head, json.dumps({"version": 1, "buckets": buckets}).encode())
        with store.open_input_stream(head) as source:
            stored = json.loads(source.read())
        if stored["version"] != 1:
            raise ValueError(f"a response log of version {stored['version']}")
        self.buckets = int(stored["buckets"])

    def bucket(self, request_id: Column | str) -> Column:
        return F.pmod(F.xxhash64(request_id), F.lit(self.buckets)).cast("int")

    # -- in tasks ------------------------------------------------------------------------------

    def known(self, bucket: int, wanted: list[str]) -> dict[str, tuple]:
        """``(response, error)`` of those of the ``wanted`` requests that need not be asked."""
        found: dict[str, tuple] = {}
        ids = pa.array(wanted, pa.string())
        for table in self._files(bucket):
            rows = table.filter(pc.is_in(table["request_id"], ids))
            for name, answer, error in zip(
                *(rows[c].to_pylist() for c in ("request_id", "response", "error"))
            ):
                if name not in found or found[name][0] is None and answer is not None:
                    found[name] = (answer, error)
        if self.retry_failures:
            found = {name: pair for name, pair in found.items() if pair[0] is not None}
        return found

    def append(self, bucket: int, rows: pa.Table) -> None:
        digest = hashlib.sha256("\n".join(rows["request_id"].to_pylist()).encode()).hexdigest()
        # answers of a repeated request must not hide behind the failure they replace
        kind = "retry" if self.retry_failures else "batch"
        self._write(bucket, f"{kind}-{digest[:32]}", rows)

    def _folder(self, bucket: int) -> tuple:
        store, folder = place(self.path)
        return store, f"{folder}/bucket={bucket}"

    def _write(self, bucket: int, name: str, rows: pa.Table) -> str:
        store, folder = self._folder(bucket)
        data = io.BytesIO()
        pq.write_table(rows.select(_SCHEMA.names).cast(_SCHEMA), data)
        path = f"{folder}/{name}.parquet"
        publish(store, path, data.getvalue())
        return path

    def _files(self, bucket: int) -> Iterator[pa.Table]:
        """The bucket's files in order of their names, each read once it is needed."""
        store, folder = self._folder(bucket)
        paths, done = names(store, folder, ".parquet"), set()
        while paths:
            path = paths.pop(0)
            if path in done:
                continue
            try:
                with store.open_input_file(path) as source:
                    table = pq.read_table(source, schema=_SCHEMA)
            except FileNotFoundError:  # merged meanwhile into a file that was not listed
                paths = names(store, folder, ".parquet")
                continue
            done.add(path)
            yield table

    # -- as tables -----------------------------------------------------------------------------

    def rows(self, spark: SparkSession) -> DataFrame:
        """Every stored row of ``RESPONSE`` with its ``file``; a request may have several."""
        stored = spark.createDataFrame([], RESPONSE).withColumn("file", F.lit(""))
        store, folder = place(self.path)
        from pyarrow import fs

        if any(f.type == fs.FileType.Directory for f in store.get_file_info(fs.FileSelector(folder))):
            read = spark.read.schema(RESPONSE).option("recursiveFileLookup", "true")
            stored = read.parquet(self.path).withColumn("file", F.input_file_name())
        return stored

    def read(self, spark: SparkSession) -> DataFrame:
        """One row of ``RESPONSE`` per request, what a task would find."""
        name = F.substring_index("file", "/", -1)
        rest = [c for c in RESPONSE.names if c != "request_id"]
        best = F.min(F.struct(F.col("response").isNull().alias("failed"), name.alias("file"), *rest))
        return (
            self.rows(spark)
            .groupBy("request_id")
            .agg(best.alias("best"))
            .select("request_id", *(F.col(f"best.{c}").alias(c) for c in rest))
        )

    def compact(self, spark: SparkSession) -> DataFrame:
        """Merge the files of every bucket into one; ``(bucket, files, rows)``.

        The merged file is there before any other goes, and holds one row per request, so readers see
        the same answers at any moment. One compaction at a time; runs may go on beside it.
        """
        log = self

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for bucket in batch.column("id").to_pylist():
                    store, folder = log._folder(bucket)
                    paths = names(store, folder, ".parquet")
                    kept: dict[str, tuple] = {}
                    for path in paths:
                        with store.open_input_file(path) as source:
                            rows = pq.read_table(source, schema=_SCHEMA).to_pylist()
                        for row in rows:
                            old = kept.get(row["request_id"])
                            if old is None or old["response"] is None and row["response"] is not None:
                                kept[row["request_id"]] = row
                    if len(paths) > 1:
                        table = pa.Table.from_pylist(list(kept.values()), _SCHEMA)
                        # names of merged files come first
                        log._write(bucket, f"all-{uuid.uuid4().hex}", table)
                        for path in paths:
                            store.delete_file(path)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([v], pa.int64()) for v in (bucket, len(paths), len(kept))],
                        ["bucket", "files", "rows"],
                    )

        buckets = spark.range(0, self.buckets, 1, min(self.buckets, 64))
        done = buckets.mapInArrow(merge, "bucket long, files long, rows long")
        return spark.createDataFrame(done.toPandas(), done.schema)  # a row per bucket, run once
