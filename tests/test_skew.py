"""One key holding most rows is split, not processed by one task."""

import pytest
from pyspark.sql import functions as F

from segqa import attach_responses, attach_video, request_id
from segqa.functions.prompts import OPEN_BOOK

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def large(spark):
    """Thresholds lowered so that small tables behave like large ones."""
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def finished_plan(df):
    rows = df.collect()
    return df._jdf.queryExecution().executedPlan().toString(), rows


def hot(spark, n=60_000):
    """Two thirds of the rows under one key, spread over several input partitions."""
    key = F.when(F.col("id") % 3 != 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 500))
    return spark.range(0, n, 1, 8).select(key.alias("video_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))


def test_titles_of_a_long_video(spark, large):
    videos = spark.range(500).select(
        F.concat(F.lit("v"), "id").alias("video_id"), F.lit("T").alias("title")
    ).unionByName(spark.range(1).select(F.lit("hot").alias("video_id"), F.lit("Hot").alias("title")))
    plan, rows = finished_plan(attach_video(hot(spark), videos))
    assert "skew=true" in plan
    assert len(rows) == 60_000
    assert sum(r.video_ref == "Hot" for r in rows) == 40_000


def test_responses_to_a_frequent_prompt(spark, large):
    asked = hot(spark).withColumnRenamed("video_id", "prompt").withColumn("model", F.lit("m"))
    stored = asked.select("model", "prompt").distinct().select(
        request_id(F.col("model"), F.col("prompt"), OPEN_BOOK).alias("request_id"),
        F.upper("prompt").alias("response"),
    )
    plan, rows = finished_plan(attach_responses(asked, stored, "model", F.col("prompt"), OPEN_BOOK))
    assert "skew=true" in plan
    assert len(rows) == 60_000 and all(r.response == r.prompt.upper() for r in rows)
