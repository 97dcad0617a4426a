import random

import numpy as np
import pytest

from segqa import pack_captions
from segqa.operators.packing import _leaving
from segqa.schemas import CAPTION, SEGMENT

from . import plain


def captions(spark, rows, parts=3):
    return spark.createDataFrame(rows, CAPTION).repartition(parts)


def packed(df, *args, **kwargs):
    rows = pack_captions(df, *args, **kwargs).collect()
    assert all(r.duration == r.end_time - r.start_time for r in rows)
    assert all(r.timestamp == plain.clock(r.start_time) for r in rows if r.start_time >= 0)
    return sorted((r.video_id, r.start_time, r.end_time, r.text) for r in rows)


CASES = [
    ([(0, "a", None), (10, "", None), (20, "b", None)], [(0, 20, "a  b")]),
    ([(45, "a", 5)], [(45, 50, "a")]),
    (
        [(0, "a", None), (31, "b", None), (62, "c", 2)],
        [(0, 31, "a"), (31, 62, "b"), (62, 64, "c")],
    ),
    ([(0, " ", None), (40, "b", 1)], [(40, 41, "b")]),
    ([(0, "a", 1), (30, "b", 1)], [(0, 30, "a"), (30, 31, "b")]),
    ([(29, "a", 1), (59, "b", 1)], [(0, 59, "a"), (59, 60, "b")]),
    ([], []),
]


@pytest.mark.parametrize("chunk_rows", [1 << 20, 1, 2])
def test_vectors(spark, chunk_rows):
    rows = [
        (f"v{k}", i, float(s), None if d is None else float(d), t)
        for k, (items, _) in enumerate(CASES)
        for i, (s, t, d) in enumerate(items)
    ]
    expected = sorted(
        (f"v{k}", float(s), float(e), t) for k, (_, found) in enumerate(CASES) for s, e, t in found
    )
    assert packed(captions(spark, rows), chunk_rows=chunk_rows) == expected
    assert expected == plain.pack(rows, 30)


def test_schema(spark):
    df = pack_captions(captions(spark, []))
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in SEGMENT]
    assert df.collect() == []


def random_rows(seed, videos=40):
    rng = random.Random(seed)
    rows = []
    for v in range(videos):
        at, regular = rng.uniform(-40, 60), rng.random() < 0.4
        for i in range(rng.choice([1, 2, 5, 40, 120])):
            # steps back, repeats, gaps; regular spacing never lets two chains of cuts meet
            step = rng.choice([0, 0, rng.uniform(-20, 12), rng.uniform(0, 9), rng.uniform(0, 100)])
            at = i * 12.5 if regular else at + step
            length = rng.choice([None, rng.uniform(0, 9)])
            rows.append((f"v{v}", i, float(at), length, rng.choice(["a", "b c", " ", "", " x "])))
    return rows


@pytest.mark.parametrize("seconds", [30, 7, 500])
@pytest.mark.parametrize("chunk_rows", [1 << 20, 50, 7, 1])
def test_random_videos(spark, seconds, chunk_rows):
    rows = random_rows(seconds)
    assert packed(captions(spark, rows), seconds, chunk_rows) == plain.pack(rows, seconds)


def test_without_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        rows = random_rows(3)
        assert packed(captions(spark, rows), 30, 10) == plain.pack(rows, 30)
    finally:
        spark.conf.set(key, before)


def test_known_long_videos(spark):
    rows = random_rows(4)
    df = captions(spark, rows)
    long_videos = df.filter("seq >= 10").select("video_id")
    assert packed(df, 30, 10, long_videos=long_videos) == plain.pack(rows, 30)
    for too_few in (long_videos.limit(0), long_videos.limit(1)):
        assert packed(df, 30, 10, long_videos=too_few) == plain.pack(rows, 30)


def test_rounding_follows_the_difference(spark):
    """start - anchor >= seconds, not start >= anchor + seconds: they round differently."""
    rng = random.Random(8)
    rows = []
    for v in range(300):
        a = rng.uniform(30, 1e5)
        b = float(np.nextafter(a + 30, rng.choice([-np.inf, np.inf])))
        rows += [(f"v{v}", 0, a, 1.0, "a"), (f"v{v}", 1, b, 1.0, "b"), (f"v{v}", 2, a + 30, 1.0, "c")]
    expected = plain.pack(rows, 30)
    for chunk_rows in (1 << 20, 1):
        assert packed(captions(spark, rows), 30, chunk_rows) == expected


def test_leaving_anchor():
    rng = np.random.default_rng(1)
    for _ in range(50):
        records = np.unique(rng.uniform(0, 500, rng.integers(1, 60)))
        leaving = _leaving(records, 30)
        for i, own in enumerate(records):
            for r in records[i:]:
                if r - own >= 30:
                    own = r
            assert leaving[i] == own


def test_unusable_captions_are_left_out(spark):
    rows = [
        ("v", 0, 0.0, 1.0, "a"),
        ("v", 1, None, 1.0, "x"),
        ("v", 2, float("nan"), 1.0, "x"),
        ("v", 3, float("inf"), 1.0, "x"),
        ("v", 4, 5.0, 1.0, None),
        ("v", 5, 6.0, 1.0, "b"),
        (None, 0, 0.0, 1.0, "x"),
    ]
    for chunk_rows in (1 << 20, 2):
        # a caption without a text is blank
        assert packed(captions(spark, rows), chunk_rows=chunk_rows) == [("v", 0.0, 7.0, "a  b")]


def test_only_the_last_pass_reads_texts(spark, tmp_path):
    rows = random_rows(5, videos=10)
    captions(spark, rows).write.parquet(str(tmp_path / "c"))
    stored = spark.read.parquet(str(tmp_path / "c"))
    done = pack_captions(stored, 30, 10)
    assert done.count() > 0
    done.collect()
    plan = done._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    scans = [line for line in plan.splitlines() if "FileScan parquet [video_id" in line and "seq" in line]
    with_text = [line for line in scans if "text" in line.split("Batched")[0]]
    # short and long videos once each: what lies within chunks and at their edges share one shuffle
    assert len(scans) == len(with_text) == 2 and "ReusedExchange" in plan, plan
    assert packed(stored, 30, 10) == plain.pack(rows, 30)


@pytest.mark.parametrize("spacing", [1.0, 400.0])
def test_tables_compose_in_rounds(spark, spacing, monkeypatch):
    """Over 300 chunks, no task follows more tables than it composes, at any length of segments."""
    from segqa.operators import packing

    plainly = packing._blocks

    def counted(table):
        found = list(plainly(table))
        assert len(found) <= packing.FAN
        return iter(found)

    monkeypatch.setattr(packing, "_blocks", counted)
    rng = random.Random(6)
    rows, at = [], 0.0
    for i in range(1300):
        at += rng.uniform(0, spacing)
        rows.append(("hot", i, at - rng.choice([0, 0, 5]), 1.0, f"w{i}"))
    for seconds in (30, 86_400):
        assert packed(captions(spark, rows), seconds, 4) == plain.pack(rows, seconds)


def test_one_video_holds_most_captions(spark):
    """No task sees more than a few chunks of the long video, and the result is exact."""
    rng = random.Random(2)
    at, rows = 0.0, []
    for i in range(30_000):
        at += rng.uniform(0, 6)
        rows.append(("hot", i, at, 2.0, f"w{i}"))
    rows += [(f"v{k}", i, i * 4.0, 2.0, "t") for k in range(200) for i in range(20)]
    assert packed(captions(spark, rows, 8), 30, 1000) == plain.pack(rows, 30)


def test_segment_over_many_chunks(spark):
    rows = [("v", i, 0.0, None, str(i)) for i in range(100)] + [("v", 100, 31.0, 1.0, "end")]
    expected = [("v", 0.0, 31.0, " ".join(map(str, range(100)))), ("v", 31.0, 32.0, "end")]
    assert packed(captions(spark, rows), 30, 7) == expected
    assert packed(captions(spark, rows), 30, 100) == expected  # closed by the first of its chunk


@pytest.mark.parametrize("batch_rows", [1, 2, 3])
@pytest.mark.parametrize("chunk_rows", [1 << 20, 5, 1])
def test_segments_over_batches(spark, batch_rows, chunk_rows):
    """Open pieces and entering anchors are carried from one Arrow batch to the next."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, batch_rows)
    try:
        rows = random_rows(11, videos=15)
        assert packed(captions(spark, rows), 30, chunk_rows) == plain.pack(rows, 30)
    finally:
        spark.conf.set(setting, before)
