import json

import pytest
from pyspark.sql import functions as F

from segqa import (
    adapt_external_segments,
    analyze_dataset,
    caption_segments,
    dataset_pairs,
    explode_captions,
    filter_video_paths,
    parse_probe,
    process_videos,
    read_dataset,
    scan_videos,
    unmatched_urls,
    video_manifest,
)
from segqa.schemas import CAPTION, EXTERNAL_SEGMENT, SEGMENT, VIDEO


# File names of the scan that are to be told apart.
SCANNED = ["video1.mp4", "video2.avi", "document.txt", "subdir/video3.mov"]


def make_files(root, names):
    for name in names:
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(b"12345")


@pytest.mark.parametrize("hidden", [True, False])
def test_scan(spark, tmp_path, hidden):
    make_files(tmp_path, [*SCANNED, "Loud.MKV", "x.mp4.bak"])
    df = scan_videos(spark, str(tmp_path), hidden=hidden)
    kept = ["Loud.MKV", "subdir/video3.mov", "video1.mp4", "video2.avi"]
    assert sorted(map(tuple, df.collect())) == [(f"file:{tmp_path}/{name}", 5) for name in kept]
    # file bytes are never read
    assert "content" not in df._jdf.queryExecution().executedPlan().toString()


def test_scan_sees_hidden_names(spark, tmp_path):
    kept = [".a.mp4", "_b.avi", ".c/d.mov", "_e/.f/g h%20#.mkv", "1/2/3/4/5/deep.wmv"]
    make_files(tmp_path, [*kept, ".mp4", "h.mp4/inside.txt"])
    (tmp_path / "empty.mov").mkdir()  # a folder is no file whatever its name
    (tmp_path / "link.flv").symlink_to(tmp_path / ".a.mp4")
    (tmp_path / "broken.flv").symlink_to(tmp_path / "nowhere")
    (tmp_path / "1" / "round").symlink_to(tmp_path)
    for root in (str(tmp_path), f"{tmp_path}/", f"file:{tmp_path}", f"file://{tmp_path}"):
        paths = [r.path for r in scan_videos(spark, root).collect()]
        assert sorted(paths) == sorted(f"file:{tmp_path}/{n}" for n in [*kept, "link.flv"])
    spaced = tmp_path / "a b%41"
    make_files(spaced, ["x.mp4"])
    assert [r.path for r in scan_videos(spark, str(spaced)).collect()] == [f"file:{spaced}/x.mp4"]


def test_scan_in_many_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("segqa.sources.videos.LISTED_ROWS", 3)
    names = [f"{i % 2}/{i}.mp4" for i in range(23)]
    make_files(tmp_path, names)
    found = scan_videos(spark, str(tmp_path))
    assert sorted(r.path for r in found.collect()) == sorted(f"file:{tmp_path}/{n}" for n in names)


def test_scan_of_empty_folder(spark, tmp_path):
    found = scan_videos(spark, str(tmp_path))
    assert found.columns == ["path", "length"] and found.count() == 0


@pytest.mark.parametrize("hidden", [True, False])
def test_scan_of_missing_folder(spark, hidden):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        scan_videos(spark, "/tmp/no-such-folder-here", hidden=hidden)


def test_inventory_filter(spark):
    kept = ["/a/b.mp4", "/a/b.MOV", "b.webm", "/a/.x.flv", "/a.b/c.wmv"]
    dropped = ["/a/.mp4", "/mp4", "a.mp4\n", "a.mp4/b", "/a/b.mp", "/a/bmp4"]
    df = spark.createDataFrame([(p,) for p in kept + dropped], "path string")
    assert sorted(r.path for r in filter_video_paths(df).collect()) == sorted(kept)


def probe(streams, duration, **more):
    return json.dumps({"streams": streams, "format": {"duration": duration, **more}})


VIDEO_STREAM = {"codec_type": "video", "width": 1280, "height": 720, "extra": [1]}


def test_probe(spark):
    rows = {
        "plain": probe([VIDEO_STREAM], "12.5"),
        "audio first": probe([{"codec_type": "audio"}, VIDEO_STREAM, {"codec_type": "video"}], 3),
        "kind unknown later": probe([VIDEO_STREAM, {"width": 1}, None], "2"),
        "text size": probe([{**VIDEO_STREAM, "width": "640"}], "1e2", size="9"),
        "no video": probe([{"codec_type": "audio"}], "1"),
        "bad duration": probe([VIDEO_STREAM], "N/A"),
        "java number": probe([VIDEO_STREAM], "12d"),
        "endless": probe([VIDEO_STREAM], "inf"),
        "no size": probe([{"codec_type": "video"}], "1"),
        "first has no size": probe([{"codec_type": "video"}, VIDEO_STREAM], "1"),
        "no format": json.dumps({"streams": [VIDEO_STREAM]}),
        "kind unknown": probe([{"width": 1}, VIDEO_STREAM], "1"),
        "null stream": probe([None, VIDEO_STREAM], "1"),
        "no json": "{",
        "null": None,
    }
    df = spark.createDataFrame(list(rows.items()), "name string, probe string")
    got = {r.name: (r.duration, r.width, r.height) for r in parse_probe(df).collect()}
    assert got == {
        "plain": (12.5, 1280, 720),
        "audio first": (3.0, 1280, 720),
        "text size": (100.0, 640, 720),
        "kind unknown later": (2.0, 1280, 720),
    }


def test_manifest_is_stable(spark):
    df = spark.createDataFrame([("/in/a.AVI",), ("/in/b.mkv",)], "path string")
    first, again = (video_manifest(d, "/out/").orderBy("path").collect() for d in (df, df.repartition(2)))
    assert first == again
    row = first[0]
    assert row.title == "a" and row.file_path == f"/out/{row.video_id}.mp4" and row.source_url is None
    assert len({r.video_id for r in first}) == 2


def test_process_videos(spark):
    rows = [
        ("/in/a.avi", probe([VIDEO_STREAM], "61")),
        ("/in/a.txt", probe([VIDEO_STREAM], "61")),
        ("/in/b.avi", probe([], "61")),
    ]
    got = process_videos(spark.createDataFrame(rows, "path string, probe string"), "/out")
    assert got.columns == VIDEO.names
    assert [(r.title, r.duration) for r in got.collect()] == [("a", 61.0)]


@pytest.fixture(scope="module")
def captions(spark):
    rows = [("id1", 0, 0.0, 5.0, "one"), ("id1", 1, 31.0, 5.0, "two"), ("id2", 0, 0.0, 5.0, "x")]
    return spark.createDataFrame(rows, CAPTION)


URLS = [
    ("v1", "https://youtu.be/id1"),
    ("v2", "https://www.youtube.com/watch?v=id1&t=2"),
    ("v3", "https://youtu.be/none"),
    ("v4", "https://example.com/id1"),
]


def test_caption_segments(spark, captions):
    urls = spark.createDataFrame(URLS, "video_id string, url string")
    df = caption_segments(urls, captions)
    assert df.columns == SEGMENT.names
    got = sorted((r.video_id, r.start_time, r.text) for r in df.collect())
    assert got == [("v1", 0.0, "one"), ("v1", 31.0, "two"), ("v2", 0.0, "one"), ("v2", 31.0, "two")]
    rest = {r.video_id: r.reason for r in unmatched_urls(urls, captions).collect()}
    assert rest == {"v3": "no captions", "v4": "no platform id"}


def test_caption_lists(spark):
    doc = '{"captions": [{"start": 1.5, "text": "b"}, {"start": 0, "text": "a", "duration": 2}]}'
    df = spark.createDataFrame([("v", doc)], "video_id string, d string").select(
        "video_id",
        F.from_json("d", "captions array<struct<start: double, duration: double, text: string>>")[
            "captions"
        ].alias("captions"),
    )
    got = explode_captions(df)
    assert got.columns == CAPTION.names
    assert [tuple(r) for r in got.collect()] == [("v", 0, 1.5, None, "b"), ("v", 1, 0.0, 2.0, "a")]


def test_external_segments(spark):
    df = spark.createDataFrame([("v", 10.0, 2.5, "t", "00:00:10")], EXTERNAL_SEGMENT)
    got = adapt_external_segments(df)
    assert got.schema == SEGMENT
    assert tuple(got.first()) == ("v", 10.0, 12.5, 2.5, "t", "00:00:10")


def test_saved_document(spark, tmp_path):
    source = {
        "transcript": "t", "video_ref": "Intro", "timecode": "00:01:30",
        "video_id": "video_123", "start_time": 90.0, "end_time": 120.0,
    }
    pair = {
        "question": "q", "answer": "a", "source_document": source, "confidence_score": 0.85,
        "is_answerable_without_context": False, "is_answerable_with_context": True,
        "llm_s_model": "gpt-4", "llm_a_model": "gpt-3.5-turbo",
    }
    document = {
        "name": "set",
        "training_split": {"name": "training", "qa_pairs": [pair, pair], "llm_s_model": "gpt-4"},
        "config": {"segment_duration": 30, "training_llm_config": {"llm_s_model": "x"}},
        "created_at": "2025-01-01 10:00:00",
        "total_videos": 10,
    }
    (tmp_path / "set.json").write_text(json.dumps(document, indent=2))
    stored = read_dataset(spark, str(tmp_path / "set.json"))
    assert dataset_pairs(stored).count() == 2
    assert dataset_pairs(stored).first().source_document.timecode == "00:01:30"
    report = {r.metric: r.value for r in analyze_dataset(stored).collect()}
    assert report["training_qa_pairs"] == "2" and report["total_videos"] == "10"
    assert report["validation_qa_pairs"] == "0" and report["created_at"] == "2025-01-01 10:00:00"
