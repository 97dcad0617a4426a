import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from segqa import (
    SplitConfig,
    analyze_dataset,
    analyze_documents,
    build_dataset,
    dataset_pairs,
    consecutive_segments,
    read_dataset,
    read_document_frames,
    read_document_pairs,
    read_flat,
    read_splits_json,
    flatten_pairs,
    write_document,
    dataset_info,
    dataset_totals,
)
from segqa.schemas import CAPTION, VIDEO
from segqa.session import shared_dir
from segqa.sinks.writers import public_config

CONFIG = {
    "segment_duration": 30,
    "openai_api_key": "secret-value",
    "training_llm_config": {"llm_s_model": "a", "api_token": "secret-value"},
}


@pytest.fixture(scope="module")
def videos(spark):
    rows = [(f"v{i}", f'Title "{i}"\n', 40.0 * i, f"v{i}.mp4", None) for i in range(6)]
    return spark.createDataFrame(rows, VIDEO)


@pytest.fixture(scope="module")
def built(spark, videos, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("built"))
    dataset = build_dataset(videos, out, "set", 'quoted "text"', config=CONFIG, document=True)
    return out, dataset


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_tables(built):
    _, dataset = built
    assert dataset.segments.count() == 0 + 2 + 3 + 4 + 6 + 7
    assert dataset.pairs.count() == 2 * dataset.segments.count()
    assert {r.split: r.qa_pairs for r in dataset.stats.collect()} == {"training": 22, "validation": 22}


def test_flat_and_splits_read_back(spark, built):
    out, dataset = built
    assert {p.name for p in Path(out, "flat").glob("split=*")} == {"split=train", "split=validation"}
    flat = flatten_pairs(dataset.pairs)
    assert same(read_flat(spark, f"{out}/flat").select(flat.columns), flat)
    stored = read_splits_json(spark, f"{out}/splits").select(dataset.pairs.columns)
    assert same(stored, dataset.pairs)


def test_no_secret_is_written(built):
    out, _ = built
    texts = [p.read_bytes() for p in Path(out).rglob("*") if p.is_file()]
    assert texts and not any(b"secret-value" in t for t in texts)
    assert public_config(CONFIG) == {
        "segment_duration": 30,
        "training_llm_config": {"llm_s_model": "a"},
    }


def test_info(spark, built):
    out, _ = built
    info = spark.read.json(f"{out}/info").first()
    assert (info.total_videos, info.total_segments, info.total_qa_pairs) == (6, 22, 44)
    assert (info.training_qa_pairs, info.validation_qa_pairs) == (22, 22)
    assert "T" in info.created_at and json.loads(info.config)["segment_duration"] == 30


def joined(folder):
    return "".join(p.read_text() for p in sorted(Path(folder).glob("part-*")))


def test_document(spark, built, tmp_path):
    out, dataset = built
    document = json.loads(joined(f"{out}/document"))
    assert document["name"] == "set" and document["description"] == 'quoted "text"'
    assert document["config"] == public_config(CONFIG)
    assert document["total_qa_pairs"] == 44
    assert document["created_at"] == dataset.info.first().created_at
    training = document["training_split"]
    assert training["name"] == "training" and len(training["qa_pairs"]) == 22
    assert training["llm_s_model"] == "placeholder-llm-s"
    (tmp_path / "set.json").write_text(joined(f"{out}/document"))
    stored = read_dataset(spark, str(tmp_path / "set.json"))
    assert same(dataset_pairs(stored).select(dataset.pairs.columns), dataset.pairs)
    report = {r.metric: r.value for r in analyze_dataset(stored).collect()}
    assert report["validation_qa_pairs"] == "22" and report["description"] == 'quoted "text"'


def test_document_with_copies_and_an_empty_split(spark, built, tmp_path):
    _, dataset = built
    copies = dataset.pairs.filter("split = 'training'").limit(1)
    copies = copies.unionByName(copies).unionByName(copies)
    info = dataset_info(
        dataset_totals(spark.range(1), spark.range(1), copies), copies, "copies", ""
    )
    write_document(copies, info, str(tmp_path / "d"))
    document = json.loads(joined(tmp_path / "d"))
    assert len(document["training_split"]["qa_pairs"]) == 3
    assert document["validation_split"]["qa_pairs"] == []


def test_from_captions_with_a_called_model(spark, videos, tmp_path):
    captions = spark.createDataFrame(
        [("v1", 0, 0.0, 5.0, "one"), ("v1", 1, 40.0, 5.0, "two"), ("v99", 0, 0.0, 1.0, "x")], CAPTION
    )

    def provider(batch):
        return ["Question: q\nAnswer: a" if r.max_tokens == 300 else "a" for r in batch]

    splits = [SplitConfig("training", "writer", "reader"), SplitConfig("validation", "writer", "reader")]
    dataset = build_dataset(
        videos, str(tmp_path / "out"), "set", captions=captions, splits=splits, provider=provider
    )
    # v99 is no video; the videos without captions are cut at fixed intervals
    counts = {r.video_id: r["count"] for r in dataset.segments.groupBy("video_id").count().collect()}
    rest = consecutive_segments(videos.filter("video_id <> 'v1'"))
    expected = {r.video_id: r["count"] for r in rest.groupBy("video_id").count().collect()}
    assert counts == {"v1": 2, **expected}
    n = sum(counts.values())
    stats = {r.split: tuple(r)[1:] for r in dataset.stats.collect()}
    assert stats["training"] == (n, n, 1.0, n, 1.0, "writer", "reader")
    assert {r.call: r.failed for r in dataset.calls.collect()} == {
        "synthesis": 0, "open_book": 0, "closed_book": 0
    }


def test_document_of_several_parts_is_read_back(spark, built, tmp_path):
    _, dataset = built
    pairs = dataset.pairs.repartition(7)
    info = dataset_info(dataset_totals(spark.range(1), spark.range(1)), pairs, "set", "")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # else the few lines here come together in one part
    write_document(pairs, info, str(tmp_path / "d"))
    spark.conf.unset(key)
    assert len(list((tmp_path / "d").glob("part-*"))) > 1
    stored = read_document_pairs(spark, str(tmp_path / "d"))
    assert same(stored.select(dataset.pairs.columns), dataset.pairs)
    with pytest.raises(Exception, match="not a whole dataset document"):
        read_dataset(spark, str(tmp_path / "d")).collect()
    (tmp_path / "d" / "part-99999").write_text("something else")
    with pytest.raises(Exception, match="not a line of a dataset document"):
        read_document_pairs(spark, str(tmp_path / "d")).collect()


def test_nothing_to_build(spark, videos, tmp_path):
    with pytest.raises(ValueError, match="no videos"):
        build_dataset(videos.limit(0), str(tmp_path / "a"), "set")
    with pytest.raises(ValueError, match="no transcript segments"):
        build_dataset(videos.withColumn("duration", F.lit(0.0)), str(tmp_path / "b"), "set")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_failed_build_leaves_the_old_version(spark, videos, tmp_path, monkeypatch):
    from segqa import build_version, current_version, versions
    from segqa.plans import build

    out = f"{tmp_path}/versions"
    with pytest.raises(ValueError, match="no version"):
        current_version(out)
    first = build_version(videos, out, "one")
    scratch = list(first.scratch)
    assert scratch and all(Path(p).exists() for p in scratch)
    first.release()
    assert first.scratch == [] and not any(Path(p).exists() for p in scratch)
    before = current_version(out)
    assert read_flat(spark, f"{before}/flat").count() == 44

    def broken(*_):
        raise RuntimeError("between two sinks")

    with monkeypatch.context() as patch:
        patch.setattr(build, "write_dataset_info", broken)
        with pytest.raises(RuntimeError, match="between"):
            build_version(videos.filter("video_id <> 'v5'"), out, "two")
    assert current_version(out) == before and versions(out) == [before]
    build_version(videos.filter("video_id <> 'v5'"), out, "three")
    assert versions(out) == [before, current_version(out)] and current_version(out) != before
    assert read_flat(spark, f"{current_version(out)}/flat").count() == 30
    assert read_flat(spark, f"{before}/flat").count() == 44


def test_report_of_what_is_left_out(spark, tmp_path):
    rows = [("a", "A", 40.0), ("b", "B", None), ("c", "C", 1e11), ("d", "D", 0.0), ("e", "E", float("nan"))]
    videos = spark.createDataFrame(rows, "video_id string, title string, duration double")
    built = build_dataset(videos, f"{tmp_path}/out", "d")
    counts = {(r.stage, r.reason): r["rows"] for r in built.report.collect()}
    assert counts == {
        ("videos", "read"): 5, ("videos", "no duration"): 2,
        ("videos", "implausible duration"): 1, ("videos", "no length"): 1,
        ("segments", "read"): 2, ("segments", "blank"): 0,
    }
    captions = spark.createDataFrame([("a", 0, 0.0, 1.0, " "), ("a", 1, 35.0, 1.0, "x")], CAPTION)
    built = build_dataset(videos, f"{tmp_path}/more", "d", captions=captions)
    counts = {(r.stage, r.reason): r["rows"] for r in built.report.collect()}
    assert counts["segments", "read"] == 2 and counts["segments", "blank"] == 1


THREE = [SplitConfig(name, f"writer {name}", "reader") for name in ("b", "a", "empty")]


def several_parts(spark, pairs, info, path):
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # else the few lines here come together in one part
    write_document(pairs, info, path, THREE)
    spark.conf.unset(key)


@pytest.fixture
def documents(spark, built, tmp_path):
    """Two documents below one folder, the first of many parts, the second without pairs."""
    _, dataset = built
    pairs = dataset.pairs.repartition(7).replace({"training": "b", "validation": "a"}, subset=["split"])
    for name, of in (("one", pairs), ("none", pairs.limit(0))):
        info = dataset_info(
            dataset_totals(spark.range(4), spark.range(9)), of, name, 'a "text",', CONFIG, THREE
        )
        several_parts(spark, of, info, str(tmp_path / "all documents" / name))
    return tmp_path / "all documents"


def report_of(spark, path):
    lines = analyze_documents(read_document_frames(spark, str(path))).collect()
    found = {}
    for r in sorted(lines, key=lambda r: r.line):
        found.setdefault(r.dataset, []).append((r.metric, r.value))
    return found


def test_analysis_of_stored_documents(spark, documents):
    found = report_of(spark, documents)
    assert set(found) == {"one", "none"}
    names = [m for m, _ in found["one"]]
    # splits in the order of the document
    assert [n.removesuffix("_qa_pairs") for n in names[3::3][:3]] == ["b", "a", "empty"]
    one, none = dict(found["one"]), dict(found["none"])
    assert len(one) == len(found["one"]) == 14
    assert (one["total_videos"], one["total_segments"], one["total_qa_pairs"]) == ("4", "9", "44")
    assert [one[f"{s}_qa_pairs"] for s in ("b", "a", "empty")] == ["22", "22", "0"]
    assert one["a_llm_s_model"] == "writer a" and one["description"] == 'a "text",'
    assert [none[f"{s}_qa_pairs"] for s in ("b", "a", "empty")] == ["0", "0", "0"]
    # one document by itself reads the same
    assert report_of(spark, documents / "one") == {"one": found["one"]}
    frame = read_document_frames(spark, str(documents / "one")).first()
    assert frame.config["segment_duration"] == str(CONFIG["segment_duration"])
    assert {s.created_at for s in frame.splits} == {frame.created_at}


def test_analysis_of_damaged_documents(spark, documents, tmp_path):
    texts = [p.read_text() for p in sorted((documents / "one").glob("part-*")) if p.stat().st_size]
    assert len(texts) > 2
    foot = texts[-1].splitlines(keepends=True)[-1]
    damages = {
        "not a whole dataset document": (foot, ""),
        "pairs of a split the frame does not name": (foot, ',{"split":"c","question":"q"}\n' + foot),
        "not a line of a dataset document": (foot, "something else\n" + foot),
    }
    for i, (message, (old, new)) in enumerate(damages.items()):
        folder = tmp_path / f"damaged{i}"
        folder.mkdir()
        for k, text in enumerate(texts):
            (folder / f"part-{k}").write_text(text.replace(old, new))
        with pytest.raises(Exception, match=message):
            report_of(spark, folder)
