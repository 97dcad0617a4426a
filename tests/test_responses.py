"""Calls that are kept: tasks that die, runs that start again, failures that are asked again."""

import collections

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from segqa import (
    Outage,
    ResponseLog,
    SplitConfig,
    build_dataset,
    chat_requests,
    dedup_prompts,
    infer_batch,
)
from segqa.functions.prompts import OPEN_BOOK


@pytest.fixture
def log(tmp_path):
    return ResponseLog(f"{tmp_path}/log", buckets=4)


def requests(spark, count, parts=3):
    df = spark.range(count).select(F.concat(F.lit("p"), "id").alias("p"), F.lit("m").alias("model"))
    return dedup_prompts(chat_requests(df.repartition(parts), "model", F.col("p"), OPEN_BOOK))


def counting(folder, answer, name=lambda r: r.prompt):
    """A provider that leaves a mark for every request it answers."""
    folder.mkdir(exist_ok=True)

    def provider(batch):
        answers = [answer(r) for r in batch]
        for r in batch:
            with open(f"{folder}/asked", "a") as out:
                out.write(name(r) + "\n")
        return answers

    def asked():
        path = folder / "asked"
        return collections.Counter(path.read_text().split()) if path.exists() else collections.Counter()

    return provider, asked


def test_second_run_asks_nothing(spark, log, tmp_path):
    provider, asked = counting(tmp_path / "marks", lambda r: r.prompt.upper())
    df = infer_batch(requests(spark, 50), provider, batch_size=7, log=log)
    expected = sorted((f"P{k}", None) for k in range(50))
    for _ in range(3):  # as often as it is read
        assert sorted((r.response, r.error) for r in df.collect()) == expected
    more = infer_batch(requests(spark, 60), provider, batch_size=7, log=ResponseLog(log.path, 99))
    assert len(more.collect()) == 60
    assert set(asked().values()) == {1} and len(asked()) == 60
    assert ResponseLog(log.path, 99).buckets == 4
    assert sorted(r.response for r in log.read(spark).collect()) == sorted(f"P{k}" for k in range(60))


def test_outage_loses_nothing(spark, log, tmp_path):
    healthy, asked = counting(tmp_path / "marks", lambda r: r.prompt.upper())

    def dying(batch):
        if any(r.prompt in ("p11", "p37") for r in batch):
            raise Outage("gone")
        return healthy(batch)

    df = requests(spark, 60)
    with pytest.raises(PythonException, match="gone"):
        infer_batch(df, dying, batch_size=3, log=log).collect()
    before = asked()
    assert 0 < len(before) < 60
    kept = {r.response for r in log.read(spark).collect()}
    assert kept == {p.upper() for p in before}
    rows = infer_batch(df, healthy, batch_size=3, log=log).collect()
    assert sorted(r.response for r in rows) == sorted(f"P{k}" for k in range(60))
    assert set(asked().values()) == {1}
    assert log.rows(spark).count() == 60


def test_failures_are_kept_or_asked_again(spark, log, tmp_path):
    failing, asked = counting(tmp_path / "marks", lambda r: None if r.prompt.endswith("3") else "ok")
    df = requests(spark, 20)
    for _ in range(2):
        rows = infer_batch(df, failing, log=log).collect()
        assert sorted(r.error or "" for r in rows) == [""] * 18 + ["no response"] * 2
    assert set(asked().values()) == {1}
    again = ResponseLog(log.path, retry_failures=True)
    healthy, asked_again = counting(tmp_path / "again", lambda r: "better")
    rows = infer_batch(df, healthy, log=again).collect()
    assert collections.Counter(r.response for r in rows) == {"ok": 18, "better": 2}
    assert sorted(asked_again()) == ["p13", "p3"]
    assert collections.Counter(r.response for r in log.read(spark).collect()) == {"ok": 18, "better": 2}
    # and so after the files are merged
    assert sum(r["rows"] for r in log.compact(spark).collect()) == 20
    assert log.rows(spark).count() == 20
    rows = infer_batch(df, failing, log=log).collect()
    assert collections.Counter(r.response for r in rows) == {"ok": 18, "better": 2}


def test_compaction_and_empty_logs(spark, log):
    assert log.read(spark).count() == 0 and log.rows(spark).count() == 0
    assert infer_batch(requests(spark, 0), lambda batch: ["x"] * len(batch), log=log).count() == 0
    infer_batch(requests(spark, 30), lambda batch: ["x"] * len(batch), batch_size=2, log=log).collect()
    before = sorted(map(tuple, log.read(spark).collect()))
    done = log.compact(spark).collect()
    assert len(done) == 4 and sum(r.files for r in done) >= 15 and sum(r["rows"] for r in done) == 30
    assert sum(r.files for r in log.compact(spark).collect()) == 4
    assert sorted(map(tuple, log.read(spark).collect())) == before and len(before) == 30


def test_second_build_makes_no_call(spark, log, tmp_path):
    def answer(r):
        return "Question: What is said?\nAnswer: a thing" if r.max_tokens == 300 else "a thing"

    def name(r):
        return "_".join([r.model, str(r.max_tokens), *r.prompt.split()])

    provider, asked = counting(tmp_path / "marks", answer, name)
    videos = spark.createDataFrame([("v", "Title", 95.0)], "video_id string, title string, duration double")
    videos = videos.withColumns({"path": F.lit("/x.mp4"), "format": F.lit("mp4")})
    splits = [SplitConfig("training", "w", "r"), SplitConfig("validation", "w2", "r")]
    built = [
        build_dataset(videos, f"{tmp_path}/out{k}", "d", splits=splits, provider=provider, log=log)
        for k in range(2)
    ]
    assert asked() and set(asked().values()) == {1}
    first, second = (sorted(b.pairs.toJSON().collect()) for b in built)
    assert first == second and first
    assert built[1].calls.agg(F.sum("requests")).first()[0] == sum(asked().values())
