import random
import time

import pytest

from segqa import consecutive_segments, flatten_pairs, generate_qa
from segqa.schemas import CAPTION, VIDEO
from segqa.streaming import (
    STATE_STORE,
    late_captions,
    latest_segments,
    state_store,
    stream_segments,
    write_pairs_stream,
)

from . import plain

FOLDER = "captions"


def run(spark, tmp_path):
    stream = (
        spark.readStream.schema(CAPTION)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true")
        .parquet(str(tmp_path / FOLDER))
    )
    segments = stream_segments(stream, 30)
    (
        segments.writeStream.format("parquet")
        .option("path", str(tmp_path / "segments"))
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(segments.schema).parquet(str(tmp_path / "segments"))


def feed(spark, tmp_path, name, rows):
    spark.createDataFrame(rows, CAPTION).coalesce(1).write.parquet(str(tmp_path / FOLDER / name))


def test_one_batch_equals_the_rule(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for v in range(20):
        at = 0.0
        for i in range(rng.choice([1, 5, 40])):
            at += rng.choice([0, rng.uniform(-5, 20), rng.uniform(0, 50)])
            rows.append((f"v{v}", i, at, rng.choice([None, 4.0]), rng.choice(["a", " ", "b c"])))
    rng.shuffle(rows)
    feed(spark, tmp_path, "1", rows)
    written = run(spark, tmp_path)
    assert late_captions(written).isEmpty()
    got = latest_segments(written).collect()
    assert sorted((r.video_id, r.start_time, r.end_time, r.text) for r in got) == plain.pack(rows, 30)


def segments_of(written):
    rows = latest_segments(written).collect()
    return sorted((r.video_id, r.start_time, r.end_time, r.text) for r in rows)


def test_state_over_batches_and_late_captions(spark, tmp_path):
    feed(spark, tmp_path, "1", [("v", 0, 0.0, 1.0, "a"), ("v", 1, 20.0, 1.0, "b")])
    assert segments_of(run(spark, tmp_path)) == [("v", 0.0, 21.0, "a b")]  # so far
    feed(spark, tmp_path, "2", [("v", 1, 21.0, 1.0, "again"), ("v", 2, 29.0, 1.0, "c"), ("v", 3, 31.0, 1.0, "d")])
    written = run(spark, tmp_path)
    assert segments_of(written) == [("v", 0.0, 31.0, "a b c"), ("v", 31.0, 32.0, "d")]
    late = late_captions(written).collect()
    assert [(r.video_id, r.seq, r.start, r.text) for r in late] == [("v", 1, 21.0, "again")]


def test_a_pause_changes_nothing(spark, tmp_path):
    rows = [("v", i, 10.0 * i, 10.0, f"t{i}") for i in range(10)]
    other = [("w", 0, 0.0, 1.0, "x")]
    for name, part in (("1", rows[:5]), ("2", other), ("3", rows[5:])):
        feed(spark, tmp_path, name, part)
        run(spark, tmp_path)
    assert segments_of(run(spark, tmp_path)) == plain.pack(rows + other, 30)


@pytest.mark.parametrize("seed", range(3))
def test_any_slicing_equals_the_rule(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = []
    for v in range(8):
        at = 0.0
        for i in range(rng.choice([1, 6, 30])):
            at += rng.choice([0, rng.uniform(-5, 20), rng.uniform(0, 90)])
            rows.append((f"v{v}", i, at, rng.choice([None, 4.0]), rng.choice(["a", " ", "b c"])))
    # each video advances by a random step in every file, none at all now and then
    left = {v: [r for r in rows if r[0] == v] for v in {r[0] for r in rows}}
    number = 0
    while any(left.values()):
        part = []
        for v in sorted(left):
            step = rng.choice([0, 0, 1, 4, 20])
            part += left[v][:step]
            left[v] = left[v][step:]
        if part:
            rng.shuffle(part)
            feed(spark, tmp_path, f"{number:03d}", part)
            number += 1
    assert segments_of(run(spark, tmp_path)) == plain.pack(rows, 30)


def test_one_large_video_in_one_batch(spark, tmp_path):
    rng = random.Random(4)
    rows, at = [], 0.0
    for i in range(30_000):
        at += rng.uniform(-2, 6)
        rows.append(("hot", i, at, 2.0, f"w{i}"))
    rest = [("hot", 30_000 + i, at + i, 1.0, "z") for i in range(100)]
    for name, part in (("1", rng.sample(rows, len(rows))), ("2", rest)):
        feed(spark, tmp_path, name, part)
    assert segments_of(run(spark, tmp_path)) == plain.pack(rows + rest, 30)


def test_forgotten_video_returns_as_a_new_one(spark, tmp_path):
    feed(spark, tmp_path, "1", [("v", 5, 100.0, 1.0, "a"), ("v", 6, 110.0, 1.0, "b")])
    stream = (
        spark.readStream.schema(CAPTION)
        .option("recursiveFileLookup", "true")
        .parquet(str(tmp_path / FOLDER))
    )
    segments = stream_segments(stream, 30, idle_seconds=2)
    out = str(tmp_path / "segments")
    query = (
        segments.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(processingTime="1 second")
        .start()
    )

    def written(video):
        limit = time.monotonic() + 40
        while time.monotonic() < limit:
            if list(tmp_path.glob("segments/_spark_metadata/0")):
                found = spark.read.schema(segments.schema).parquet(out)
                if found.filter(found.video_id == video).count():
                    return found
            time.sleep(0.5)
        raise AssertionError(f"nothing of {video}: {query.exception()}")

    try:
        written("v")
        time.sleep(4)
        feed(spark, tmp_path, "2", [("v", 1, 200.0, 1.0, "c"), ("w", 0, 3.0, 1.0, "d")])
        found = written("w")
        assert late_captions(found).isEmpty()
        # the last open version of the forgotten segment stands
        assert segments_of(found) == [("v", 100.0, 111.0, "a b"), ("v", 200.0, 201.0, "c"), ("w", 0.0, 4.0, "d")]
    finally:
        query.stop()


def test_pairs_per_batch(spark, tmp_path):
    rows = [(f"v{i}", f"T{i}", 50.0, "f", None) for i in range(4)]
    videos = spark.createDataFrame(rows, VIDEO)
    for i in range(2):
        part = spark.createDataFrame(rows[2 * i : 2 * i + 2], VIDEO)
        part.coalesce(1).write.parquet(str(tmp_path / "videos" / str(i)))
    stream = (
        spark.readStream.schema(VIDEO)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true")
        .parquet(str(tmp_path / "videos"))
    )
    out = str(tmp_path / "pairs")
    write_pairs_stream(
        consecutive_segments(stream), videos, out, str(tmp_path / "checkpoint")
    ).awaitTermination()
    stored = spark.read.parquet(out)
    assert stored.select("batch").distinct().count() == 2
    expected = flatten_pairs(generate_qa(consecutive_segments(videos), videos))
    got = flatten_pairs(stored.drop("batch"))
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_state_store_setting_is_restored(spark):
    key = next(iter(STATE_STORE))
    before = spark.conf.get(key, None)
    with state_store(spark):
        assert spark.conf.get(key) == STATE_STORE[key]
    assert spark.conf.get(key, None) == before
