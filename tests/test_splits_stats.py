import pytest
from pyspark.sql import functions as F

from segqa import (
    SplitConfig,
    analyze_dataset,
    assign_split,
    consecutive_segments,
    dataset_totals,
    expand_splits,
    generate_qa,
    nest_splits,
    ratio_threshold,
    split_config,
    split_stats,
    stats_report,
)
from segqa.schemas import DATASET, VIDEO


def test_ratio(spark):
    assert ratio_threshold(0.8) == "cccc"
    ids = spark.range(5000).select(F.col("id").cast("string").alias("video_id"))
    share = assign_split(ids, 0.8).filter("split = 'training'").count() / 5000
    assert abs(share - 0.8) < 0.03
    # all rows of a video fall on one side
    twice = assign_split(ids.union(ids), 0.3)
    assert twice.groupBy("video_id").agg(F.countDistinct("split").alias("n")).filter("n > 1").isEmpty()
    for bad in (0, 1, -0.5, 1.5):
        with pytest.raises(ValueError):
            assign_split(ids, bad)


def test_expansion(spark):
    splits = [SplitConfig("training", "a", "b"), SplitConfig("validation", "c", "d")]
    got = expand_splits(spark.range(2), splits).collect()
    assert sorted(map(tuple, got)) == [
        (0, "training", "a", "b"),
        (0, "validation", "c", "d"),
        (1, "training", "a", "b"),
        (1, "validation", "c", "d"),
    ]
    assert [tuple(r) for r in split_config(spark, splits).collect()] == [
        ("training", "a", "b"),
        ("validation", "c", "d"),
    ]


def pairs(spark, flags):
    rows = [("training", without, with_) for without, with_ in flags]
    return spark.createDataFrame(
        rows,
        "split string, is_answerable_without_context boolean, is_answerable_with_context boolean",
    )


def test_stats(spark):
    df = pairs(spark, [(True, True), (False, True), (False, False), (None, True)])
    rows = {r.split: r for r in split_stats(df).collect()}
    t, v = rows["training"], rows["validation"]
    assert (t.qa_pairs, t.answerable_without_context, t.answerable_with_context) == (4, 1, 3)
    assert (t.answerable_without_context_ratio, t.answerable_with_context_ratio) == (0.25, 0.75)
    assert (v.qa_pairs, v.answerable_without_context_ratio, v.answerable_with_context_ratio) == (0, 0, 0)
    assert v.llm_a_model == "placeholder-llm-a"


def test_report(spark):
    df = split_stats(pairs(spark, [(True, True), (False, True), (False, False)]))
    rows = [tuple(r)[1:] for r in stats_report(df).orderBy("line").collect()]
    assert rows[0] == ("qa_pairs", "3", "0")
    assert rows[2] == ("answerable_without_context_ratio", "0.333", "0.000")
    assert rows[5] == ("llm_s_model", "placeholder-llm-s", "placeholder-llm-s")
    assert len(rows) == 7


def test_a_third_split_is_shown_and_an_unknown_one_is_an_error(spark):
    three = [SplitConfig("training"), SplitConfig("test")]
    df = pairs(spark, [(True, True), (False, True)])
    df = df.withColumn("split", F.lit("test"))
    row = stats_report(split_stats(df, three), three).orderBy("line").first()
    assert (row.training, row.test) == ("0", "2")
    with pytest.raises(Exception, match="split is not configured: test"):
        split_stats(df).collect()
    with pytest.raises(Exception, match="split is not configured: test"):
        stats_report(split_stats(df, three)).collect()


@pytest.fixture(scope="module")
def built(spark):
    videos = spark.createDataFrame(
        [("a", "A", 100.0, "a", None), ("b", "B", 30.0 * 2050, "b", None)], VIDEO
    )
    segments = consecutive_segments(videos, keep_title=True)
    return videos, segments, generate_qa(segments)


def test_totals(built):
    assert tuple(dataset_totals(*built).first()) == (2, 2054, 4108)


def test_nesting_is_bounded_and_whole(built):
    _, _, pairs = built
    rows = nest_splits(pairs).collect()
    sizes = [len(r.qa_pairs) for r in rows]
    assert sum(sizes) == 4108 and max(sizes) <= 1025
    for r in rows:
        starts = [p.start_time for p in r.qa_pairs]
        assert starts == sorted(starts)
    assert {r.name for r in rows} == {"training", "validation"}


def test_analysis_of_sparse_document(spark):
    row = spark.createDataFrame([('{"total_videos": 3}',), ("{}",)], "d string").select(
        F.from_json("d", DATASET).alias("d")
    )
    got = {}
    for r in analyze_dataset(row.select("d.*")).collect():
        got.setdefault(r.metric, set()).add(r.value)
    assert got["total_videos"] == {"3", "0"}
    assert got["training_qa_pairs"] == {"0"}
    assert got["validation_llm_a_model"] == got["created_at"] == {"Unknown"}
    assert got["description"] == {"No description"}
