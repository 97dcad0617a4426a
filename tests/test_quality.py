import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segqa import quarantine, require_rows, validate_rows
from segqa.schemas import PAIR_DEFAULTS, QA_PAIR, SOURCE_DOCUMENT, VIDEO, VIDEO_DEFAULTS


def test_video_rows(spark):
    rows = [
        ("test_123", "Test Video", "120.0", "./test.mp4"),
        ("x", "No duration", None, "./x.mp4"),
        ("y", "Bad duration", "two minutes", "./y.mp4"),
        (None, "No id", "1", "./z.mp4"),
    ]
    df = spark.createDataFrame(
        rows, "video_id string, title string, duration string, file_path string"
    )
    good, bad = validate_rows(df, VIDEO, VIDEO_DEFAULTS)
    assert good.schema == VIDEO
    row = good.collect()
    assert len(row) == 1 and tuple(row[0]) == ("test_123", "Test Video", 120.0, "./test.mp4", None)
    assert {r.title: r.error for r in bad.collect()} == {
        "No duration": "duration: missing",
        "Bad duration": "duration: not double",
        "No id": "video_id: missing",
    }


def test_pair_rows_take_defaults(spark):
    source = ("Test transcript", "Test Video", "00:00:00", "test_123", 0.0, 30.0)
    schema = T.StructType(
        [f for f in QA_PAIR.fields if not f.name.startswith("is_answerable_with")]
        + [T.StructField("is_answerable_without_context", T.StringType())]
    )
    assert "source_document" in schema.names and SOURCE_DOCUMENT.names[0] == "transcript"
    rows = [
        ("What is this about?", "It's about testing.", source, "s", "a", None),
        ("q", "a", source, "s", "a", "true"),
        ("q", "bad flag", source, "s", "a", "perhaps"),
        ("q", "no source", None, "s", "a", "true"),
    ]
    good, bad = validate_rows(spark.createDataFrame(rows, schema), QA_PAIR, PAIR_DEFAULTS)
    flags = [
        (r.is_answerable_without_context, r.is_answerable_with_context) for r in good.collect()
    ]
    assert flags == [(False, True), (True, True)]
    assert sorted(r.error for r in bad.collect()) == [
        "is_answerable_without_context: not boolean",
        "source_document: missing",
    ]


def test_absent_required_column(spark):
    good, bad = validate_rows(spark.range(2).select(F.lit("x").alias("video_id")), VIDEO)
    assert good.count() == 0 and {r.error for r in bad.collect()} == {"title: missing"}


def test_quarantine_keeps_every_row_once(spark):
    df = spark.range(10)
    good, bad = quarantine(
        df, {"odd": F.col("id") % 2 == 0, "unknown": F.when(F.col("id") < 8, True)}
    )
    assert good.columns == ["id"] and sorted(r.id for r in good.collect()) == [0, 2, 4, 6]
    assert {r.id: r.error for r in bad.collect()} == {
        1: "odd", 3: "odd", 5: "odd", 7: "odd", 8: "unknown", 9: "odd",
    }


def test_require_rows(spark):
    assert require_rows(spark.range(1), "videos").count() == 1
    with pytest.raises(ValueError, match="no videos"):
        require_rows(spark.range(0), "videos")
