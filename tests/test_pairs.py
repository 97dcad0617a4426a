import pytest
from pyspark.sql import functions as F

from segqa import (
    SplitConfig,
    attach_video,
    complete_pairs,
    consecutive_segments,
    context_dependent_only,
    flatten_pairs,
    generate_qa,
    min_confidence,
    validate_qa,
    with_confidence,
)
from segqa.schemas import FLAT_PAIR, SEGMENT, SPLIT_PAIR, VIDEO

TEXT = "This is a test transcript segment about machine learning."


@pytest.fixture(scope="module")
def segments(spark):
    rows = [
        ("test_video_123", 0.0, 30.0, 30.0, TEXT, "00:00:00"),
        ("other", 0.0, 30.0, 30.0, "nothing else", "00:00:00"),
        ("other", 30.0, 40.0, 10.0, "broken call", "00:00:30"),
    ]
    return spark.createDataFrame(rows, SEGMENT)


@pytest.fixture(scope="module")
def videos(spark):
    return spark.createDataFrame(
        [("test_video_123", "Test Video", 120.0, "./test_video.mp4", None)], VIDEO
    )


def talk(requests):
    """Fails on one passage, knows one answer without context."""
    out = []
    for r in requests:
        if "broken call" in r.prompt:
            raise RuntimeError("no answer")
        if r.max_tokens == 300:
            known = "machine learning" in r.prompt
            out.append(f"Question: what?\nAnswer: {'known fact' if known else 'hidden thing'}")
        elif "Context:" in r.prompt:
            out.append(" known fact " if "machine learning" in r.prompt else "hidden thing")
        else:
            out.append("Known FACT")
    return out


def test_titles(segments, videos):
    got = {r.video_id: r.video_ref for r in attach_video(segments, videos).collect()}
    assert got == {"test_video_123": "Test Video", "other": "Unknown Video"}


def test_template_pairs(segments, videos):
    pairs = generate_qa(segments, videos, keep_answers=True)
    assert pairs.columns[: len(SPLIT_PAIR)] == SPLIT_PAIR.names
    rows = pairs.collect()
    assert len(rows) == 6
    row = next(r for r in rows if r.split == "training" and r.source_document.transcript == TEXT)
    assert row.question == "What is discussed in this transcript segment?"
    assert row.answer == f"This segment discusses: {TEXT}..."
    assert row.source_document.asDict() == {
        "transcript": TEXT,
        "video_ref": "Test Video",
        "timecode": "00:00:00",
        "video_id": "test_video_123",
        "start_time": 0.0,
        "end_time": 30.0,
    }
    assert (row.llm_s_model, row.llm_a_model) == ("placeholder-llm-s", "placeholder-llm-a")
    assert row.answer_without_context == f"General knowledge answer for: {row.question}"


def test_called_model(segments, videos):
    splits = [SplitConfig("training", "writer", "reader")]
    rows = generate_qa(segments, videos, splits, provider=talk).collect()
    got = {
        r.answer: (r.is_answerable_without_context, r.is_answerable_with_context) for r in rows
    }
    # the segment whose call failed gives no pair
    assert got == {"known fact": (True, True), "hidden thing": (False, True)}


def test_failed_answers_count_as_wrong(segments, videos):
    splits = [SplitConfig("training", "placeholder-llm-s", "reader")]
    rows = generate_qa(segments, videos, splits, provider=talk, keep_answers=True).collect()
    assert len(rows) == 3
    broken = next(r for r in rows if "broken" in r.answer)
    assert broken.answer_with_context == "" and not broken.is_answerable_with_context


def test_segments_without_a_text_give_no_pair(segments, videos):
    empty = segments.withColumn("text", F.lit(None).cast("string"))
    assert generate_qa(empty, videos).isEmpty()
    splits = [SplitConfig("training"), SplitConfig("validation", "writer", "reader")]
    assert generate_qa(empty, videos, splits, provider=talk).isEmpty()


def test_called_answers_are_stripped(segments, videos):
    splits = [SplitConfig("training", "writer", "reader")]
    rows = generate_qa(segments, videos, splits, provider=talk, keep_answers=True).collect()
    assert {r.answer_with_context for r in rows} == {"known fact", "hidden thing"}


def test_models_are_never_replaced(segments, videos):
    with pytest.raises(ValueError, match="gpt-4"):
        generate_qa(segments, videos, [SplitConfig("training", "gpt-4", "placeholder-a")])
    pairs = generate_qa(segments, videos).withColumn("llm_a_model", F.lit("gpt-4"))
    with pytest.raises(Exception, match="no provider for model gpt-4"):
        validate_qa(pairs).collect()


def test_validation(segments, videos):
    splits = [SplitConfig("training", "writer", "reader")]
    pairs = generate_qa(segments, videos, splits, provider=talk)
    wrong = pairs.withColumn("is_answerable_without_context", F.lit(None).cast("boolean"))
    wrong = wrong.withColumn("is_answerable_with_context", F.lit(False))
    rows = {r.answer: r for r in validate_qa(wrong, talk).collect()}
    known, hidden = rows["known fact"], rows["hidden thing"]
    assert (known.context_similarity, known.no_context_similarity) == (1.0, 1.0)
    assert (hidden.context_similarity, hidden.no_context_similarity) == (1.0, 0.0)
    assert known.is_answerable_without_context and not hidden.is_answerable_without_context
    # only one flag is renewed
    assert not known.is_answerable_with_context


def test_incomplete_pairs_are_dropped(spark):
    rows = [("q", "a"), ("q", ""), ("", "a"), (None, "a"), ("q", None)]
    df = spark.createDataFrame(rows, "question string, answer string")
    assert [tuple(r) for r in complete_pairs(df).collect()] == [("q", "a")]


def test_flat_form(segments, videos):
    flat = flatten_pairs(generate_qa(segments, videos))
    assert flat.columns == ["split", *FLAT_PAIR.names]
    assert flatten_pairs(generate_qa(segments, videos).drop("split")).columns == FLAT_PAIR.names


def test_filters(spark):
    rows = [("a b c", "a b c", False), ("a b c d e f g", "a b c d e f g h i j", True), ("x", "y", False)]
    df = spark.createDataFrame(
        rows, "answer_with_context string, answer string, is_answerable_without_context boolean"
    )
    scored = with_confidence(df)
    assert sorted(r.confidence_score for r in scored.collect()) == [0.0, 0.7, 1.0]
    assert min_confidence(scored, 0.7).count() == 2  # at least, unlike the flags
    assert context_dependent_only(df).count() == 2


def test_template_pairs_need_no_shuffle(spark, videos):
    df = generate_qa(consecutive_segments(videos, keep_title=True))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1  # the spreading of long videos
    assert "Python" not in plan
