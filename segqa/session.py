"""Session defaults and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Everything here is safe on a cluster; partition counts and memory stay with the submitter.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # splits the hot side of a join when one key holds much of the table
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cpus: int | str = 8, app: str = "segqa", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without a checkpoint folder gets a temporary one of its own.
    """
    configured = (
        spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="segqa-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


_SCOPES: list[list[str]] = []


@contextmanager
def scratch_scope() -> Iterator[list[str]]:
    """Collect the paths of all tables that are stored inside, for ``release``."""
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield paths
    finally:
        _SCOPES.pop()


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables; what was read from them cannot be read any more."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths[-1])
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        paths.pop()


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand Python tasks that are planned inside ``rows`` rows at once, or fewer if so configured.

    For tables with whole texts: a batch lies in memory on both sides. Results do not depend on it.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    configured = spark.conf.get(name)
    if 0 < int(configured) <= rows:
        yield
        return
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, configured)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the stored table.

    Used where recomputation would change the data (model output) or repeat costly work. The stored
    table survives lost executors and has a known size, so later joins choose their strategy by it.
    """
    path = scratch_path(df.sparkSession, label)
    for scope in _SCOPES:
        scope.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
