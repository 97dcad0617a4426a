import math

import pytest
from pyspark.sql import functions as F

from segqa import consecutive_segments, segments_with_fallback
from segqa.schemas import SEGMENT, VIDEO

from . import plain


def videos(spark, durations):
    rows = [(f"v{i}", f"Title {i}", d, f"./v{i}.mp4", None) for i, d in enumerate(durations)]
    return spark.createDataFrame(rows, VIDEO)


def bounds(df):
    got = {}
    for r in df.orderBy("video_id", "start_time").collect():
        assert r.duration == r.end_time - r.start_time
        assert r.timestamp == plain.clock(r.start_time)
        got.setdefault(r.video_id, []).append((r.start_time, r.end_time))
    return got


def test_ninety_seconds(spark):
    df = consecutive_segments(videos(spark, [90.0]))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SEGMENT]
    assert bounds(df) == {"v0": [(0.0, 30.0), (30.0, 60.0), (60.0, 90.0)]}
    first = df.orderBy("start_time").first()
    assert first.text == "Transcript segment 1 from 00:00:00 to 00:00:30 of video Title 0"


def test_short_last_and_none(spark):
    df = consecutive_segments(videos(spark, [0.0, 95.5, -5.0]))
    assert bounds(df) == {"v1": [(0.0, 30.0), (30.0, 60.0), (60.0, 90.0), (90.0, 95.5)]}


EDGES = [29.999, 30.0, 90.00000000000001, 0.001, 1.0, 7.0, 6.999999999, 12345.678]
EDGES += [math.nextafter(30.0 * 997, d) for d in (0, math.inf)]


@pytest.mark.parametrize("seconds", [30, 7, 1])
@pytest.mark.parametrize("block", [1 << 16, 3, 1])
def test_tiles_without_gap(spark, seconds, block):
    got = bounds(consecutive_segments(videos(spark, EDGES), seconds, block_segments=block))
    assert got == {f"v{i}": plain.cut(d, seconds) for i, d in enumerate(EDGES)}


def test_unusable_durations_contribute_nothing(spark):
    df = videos(spark, [float("inf"), float("nan"), None, float("-inf"), 30.0])
    assert bounds(consecutive_segments(df)) == {"v4": [(0.0, 30.0)]}


@pytest.mark.parametrize("seconds", [0, -30, 2.5, True])
def test_bad_lengths_are_refused(spark, seconds):
    with pytest.raises(ValueError):
        consecutive_segments(videos(spark, [1.0]), seconds)


def test_long_video_is_spread(spark):
    """A video with most of all segments is expanded by many tasks."""
    df = consecutive_segments(videos(spark, [30.0 * 40_000] + [60.0] * 50), block_segments=1000)
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 40_000 + 100
    assert max(sizes) < 30_000


def test_only_compact_rows_are_shuffled(spark):
    df = consecutive_segments(videos(spark, [60.0]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    # the expansion into segments and their text come after (above) the exchange
    above = plan[: plan.index("Exchange")]
    assert "number" in above and "Transcript segment" in above


def test_title_is_kept_on_request(spark):
    df = consecutive_segments(videos(spark, [30.0]), keep_title=True)
    assert df.first().video_ref == "Title 0"


def test_fallback(spark):
    primary = consecutive_segments(videos(spark, [10.0])).withColumn("text", F.lit("spoken"))
    status = spark.createDataFrame(
        [("v0", "ok"), ("v1", "failed"), ("v3", "ok")], "video_id string, status string"
    )
    df = segments_with_fallback(videos(spark, [10.0, 20.0, 30.0, 40.0]), primary, status)
    got = {r.video_id: r.text for r in df.collect()}
    # v1 failed and v2 was never tried; v3 succeeded without segments
    assert set(got) == {"v0", "v1", "v2"}
    assert got["v0"] == "spoken"
