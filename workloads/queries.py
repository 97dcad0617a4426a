"""One query per operator, each over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.errors import PythonException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segqa import functions as fn
from segqa import operators as op
from segqa import plans, sinks, sources, streaming
from segqa.functions.prompts import CLOSED_BOOK, OPEN_BOOK, SYNTHESIS
from segqa.operators.packing import CHUNK_ROWS
from segqa.schemas import DATASET
from segqa.session import materialize, scratch_path
from segqa.sources.videos import probe_fields
from segqa.storage import place

from .views import event_captions, long_event_videos, table, view

Query = Callable[[SparkSession, str], DataFrame]

SPLITS = (
    op.SplitConfig("training", "placeholder-llm-s", "placeholder-llm-a"),
    op.SplitConfig("validation", "placeholder-writer", "placeholder-reader"),
)
PAIR_SPLITS = (
    op.SplitConfig("training", "writer-a", "reader-a"),
    op.SplitConfig("validation", "writer-b", "reader-b"),
)
THREE_SPLITS = (*PAIR_SPLITS, op.SplitConfig("test", "writer-c", "reader-c"))
# more than a chunk's worth never occurs at small scale; this size makes every video a long one
SMALL_CHUNK = 3
DAY = 86_400

QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# -- timeline ----------------------------------------------------------------------------------


@query
def consecutive_segments(spark, sf_dir):
    return op.consecutive_segments(view(spark, sf_dir, "v_videos"))


@query
def consecutive_segments_long(spark, sf_dir):
    """As above at 7 seconds with every video beyond 16 segments treated as a long one."""
    return op.consecutive_segments(view(spark, sf_dir, "v_videos"), 7, block_segments=16)


@query
def timecodes(spark, sf_dir):
    seconds = F.col("duration")
    return view(spark, sf_dir, "v_videos").select(
        "video_id",
        fn.timecode(seconds).alias("timecode"),
        fn.timecode(seconds * 1000).alias("long_timecode"),
    )


@query
def packed_captions(spark, sf_dir):
    return op.pack_captions(view(spark, sf_dir, "v_captions"))


@query
def packed_captions_chunked(spark, sf_dir):
    """As above with chunks so small that most videos span several."""
    return op.pack_captions(view(spark, sf_dir, "v_captions"), chunk_rows=SMALL_CHUNK)


@query
def packed_events(spark, sf_dir):
    return op.pack_captions(
        event_captions(spark, sf_dir), DAY, long_videos=long_event_videos(spark, sf_dir, CHUNK_ROWS)
    )


@query
def external_segments(spark, sf_dir):
    captions = view(spark, sf_dir, "v_captions").select(
        "video_id",
        F.col("start").alias("start_time"),
        "duration",
        "text",
        fn.timecode(F.col("start")).alias("timestamp"),
    )
    return sources.adapt_external_segments(captions)


@query
def segments_fallback(spark, sf_dir):
    """Every fourth extraction failed, some succeeded without any caption, most were never made."""
    number = F.col("video_id").cast("bigint")
    captions = view(spark, sf_dir, "v_captions")
    videos = view(spark, sf_dir, "v_videos")
    made = captions.select(
        "video_id", F.when(number % 4 == 0, "failed").otherwise("ok").alias("status")
    ).distinct()
    empty = videos.filter(number % 10 == 3).select("video_id", F.lit("ok").alias("status"))
    primary = op.pack_captions(captions.filter(number % 4 != 0))
    return op.segments_with_fallback(videos, primary, made.union(empty))


@query
def extracted_segments(spark, sf_dir):
    """Titled segments of all videos, from captions where there are any."""
    return plans.extract_all(view(spark, sf_dir, "v_videos"), view(spark, sf_dir, "v_captions"))


@query
def implausible_videos(spark, sf_dir):
    """Videos set aside for a duration in a wrong unit, infinite or absent."""
    number = F.col("video_id").cast("bigint")
    duration = (
        F.when(number % 5 == 0, F.col("duration") * 1e12)
        .when(number % 5 == 1, F.lit(float("inf")))
        .when(number % 5 == 2, F.lit(None))
        .otherwise(F.col("duration"))
    )
    videos = view(spark, sf_dir, "v_videos").withColumn("duration", duration)
    return op.implausible_videos(videos).select("video_id", "error")


@query
def caption_join(spark, sf_dir):
    return sources.caption_segments(
        view(spark, sf_dir, "v_urls"), view(spark, sf_dir, "v_captions")
    )


@query
def exploded_captions(spark, sf_dir):
    """Caption lists, one a document with a caption for each of its lines, as captions."""
    lists = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.transform(
            F.split("text", "\n"),
            lambda line, i: F.struct(
                (i * 2.5).alias("start"),
                F.when(i % 3 != 2, i * 0.5).alias("duration"),
                line.alias("text"),
            ),
        ).alias("captions"),
    )
    return sources.explode_captions(lists)


@query
def unmatched_urls(spark, sf_dir):
    return sources.unmatched_urls(
        view(spark, sf_dir, "v_urls").select("video_id", "url"), view(spark, sf_dir, "v_captions")
    )


@query
def titled_segments(spark, sf_dir):
    segments = op.pack_captions(view(spark, sf_dir, "v_captions"))
    return op.attach_video(segments, view(spark, sf_dir, "v_videos"))


# -- sources -----------------------------------------------------------------------------------


@query
def video_paths(spark, sf_dir):
    accepted = sources.filter_video_paths(view(spark, sf_dir, "v_paths"))
    return sources.video_manifest(accepted, "/out/videos").drop("source_url")


@query
def scanned_videos(spark, sf_dir):
    """Files written below a folder, hidden ones and other kinds included, and found again."""
    root = scratch_path(spark, "lake")
    files = view(spark, sf_dir, "v_files").select("path", "length")
    files.mapInArrow(file_writer(root), "path string").write.format("noop").mode("overwrite").save()
    name = root.rsplit("/", 1)[1]
    return sources.scan_videos(spark, root).select(
        F.split_part("path", F.lit(f"{name}/"), F.lit(-1)).alias("path"), "length"
    )


def file_writer(root):
    """Files of given names and lengths below ``root``, each written by the task that has its row."""

    def write(batches):
        store, base = place(root)
        for batch in batches:
            for path, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store.create_dir(f"{base}/{path}".rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(f"{base}/{path}") as out:
                    out.write(bytes(length))
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["path"])

    return write


@query
def probe_metadata(spark, sf_dir):
    return sources.parse_probe(view(spark, sf_dir, "v_probe")).drop("probe")


@query
def processed_videos(spark, sf_dir):
    """Inventory with probe output to videos table."""
    probes = view(spark, sf_dir, "v_probe")
    paths = view(spark, sf_dir, "v_paths").withColumn("video_id", F.col("page_id").cast("string"))
    inventory = paths.join(probes, "video_id", "left").select("path", "probe")
    return sources.process_videos(inventory, "/out").drop("source_url")


@query
def youtube_ids(spark, sf_dir):
    return view(spark, sf_dir, "v_urls").select(
        "page_id", fn.youtube_id(F.col("url")).alias("youtube_id")
    )


@query
def quarantined_rows(spark, sf_dir):
    probe = F.col("fields")
    _, bad = op.quarantine(
        view(spark, sf_dir, "v_probe").withColumn("fields", probe_fields(F.col("probe"))),
        {
            "no video stream": probe["has_video"],
            "bad duration": probe["duration"].isNotNull(),
            "bad size": probe["width"].isNotNull() & probe["height"].isNotNull(),
        },
    )
    return bad.select("video_id", "error")


# -- text --------------------------------------------------------------------------------------


@query
def parse_qa(spark, sf_dir):
    return view(spark, sf_dir, "v_responses").select(
        "conv_id", "turn", F.inline(fn.parsed_pairs(F.col("response")))
    )


@query
def parse_qa_fields(spark, sf_dir):
    """As above with every response kept, null where incomplete."""
    return view(spark, sf_dir, "v_responses").select(
        "conv_id", "turn", fn.parse_qa(F.col("response")).alias("qa")
    ).select("conv_id", "turn", "qa.question", "qa.answer")


@query
def text_functions(spark, sf_dir):
    """Blank stripping and question words over whole document texts."""
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.length(fn.strip(F.concat(F.lit(" \t\n"), text, F.lit("\r\n ")))).cast("bigint").alias("stripped"),
        fn.has_question_word(text).alias("has_question_word"),
        fn.is_placeholder(
            F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("placeholder-"), F.col("source")))
            .otherwise(F.concat(F.col("source"), F.lit("placeholder-")))
        ).alias("is_placeholder"),
        F.array_size(fn.tokens(text)).cast("bigint").alias("words"),
    )


@query
def answer_similarity(spark, sf_dir):
    answer = F.col("answer")
    return view(spark, sf_dir, "v_answers").select(
        "conv_id",
        "turn",
        fn.answer_similarity(F.col("answer_with_context"), answer).alias("with_context"),
        fn.answer_similarity(F.col("answer_without_context"), answer).alias("without_context"),
    )


@query
def answerability_flags(spark, sf_dir):
    answer = F.col("answer")
    return view(spark, sf_dir, "v_answers").select(
        "conv_id",
        "turn",
        fn.answerable(F.col("answer_with_context"), answer).alias("with_context"),
        fn.answerable(F.col("answer_without_context"), answer).alias("without_context"),
    )


# -- pairs -------------------------------------------------------------------------------------


def labelled_pairs(
    spark: SparkSession, sf_dir: str, splits: tuple[op.SplitConfig, ...] = PAIR_SPLITS
) -> DataFrame:
    """Pairs parsed from responses and flagged by their stored answers, split by conversation.

    A third split takes every fifth conversation.
    """
    start = F.col("turn") * F.lit(12.5)
    parsed = (
        view(spark, sf_dir, "v_answers")
        .withColumnRenamed("answer", "text")
        .withColumn("video_id", F.col("conv_id").cast("string"))
        .select(
            "*",
            F.concat(F.lit("Conversation "), F.col("video_id")).alias("video_ref"),
            fn.timecode(start).alias("timestamp"),
            start.alias("start_time"),
            (start + F.lit(12.5)).alias("end_time"),
            F.inline(fn.parsed_pairs(F.col("response"))).alias("question", "answer"),
        )
    )
    pairs = op.assign_split(op.with_source_document(op.complete_pairs(parsed)), 0.8)
    if len(splits) > 2:
        fifth = F.col("source_document.video_id").cast("bigint") % 5 == 0
        pairs = pairs.withColumn("split", F.when(fifth, splits[2].name).otherwise(F.col("split")))
    models = op.split_config(spark, splits)
    answer = F.col("answer")
    return (
        pairs.join(F.broadcast(models), "split")  # one row per split
        .withColumn(
            "is_answerable_without_context",
            fn.answerable(F.col("answer_without_context"), answer),
        )
        .withColumn(
            "is_answerable_with_context", fn.answerable(F.col("answer_with_context"), answer)
        )
        .select(
            "split",
            "question",
            "answer",
            "source_document",
            "llm_s_model",
            "llm_a_model",
            "is_answerable_without_context",
            "is_answerable_with_context",
            "answer_with_context",
            "answer_without_context",
        )
    )


@query
def placeholder_pairs(spark, sf_dir):
    videos = view(spark, sf_dir, "v_videos")
    pairs = op.generate_qa(op.consecutive_segments(videos, keep_title=True), splits=SPLITS)
    return op.flatten_pairs(pairs)


@query
def caption_pairs(spark, sf_dir):
    """Pairs of packed captions, with titles looked up and the model's answers kept."""
    pairs = op.generate_qa(
        op.pack_captions(view(spark, sf_dir, "v_captions")),
        view(spark, sf_dir, "v_videos"),
        keep_answers=True,
    )
    return pairs.select(
        "split",
        "source_document.video_id",
        "source_document.start_time",
        "source_document.video_ref",
        "answer",
        "answer_with_context",
        "answer_without_context",
        "is_answerable_with_context",
        "is_answerable_without_context",
    )


@query
def prompt_columns(spark, sf_dir):
    question, context = F.col("question"), F.col("answer")
    parsed = view(spark, sf_dir, "v_responses").select(
        "*", F.inline(fn.parsed_pairs(F.col("response"))).alias("question", "parsed_answer")
    )
    return op.complete_pairs(parsed).select(
        "conv_id",
        "turn",
        fn.synthesis_prompt(context).alias("synthesis"),
        fn.closed_book_prompt(question).alias("closed_book"),
        fn.closed_book_prompt(question, strict=False).alias("closed_book_again"),
        fn.open_book_prompt(question, context).alias("open_book"),
    )


@query
def prompt_dedup(spark, sf_dir):
    """Distinct requests of a prompt that most rows share and of one that few share."""
    videos = view(spark, sf_dir, "v_videos").withColumn("model", F.lit("reader"))
    shared = op.chat_requests(
        videos, "model", fn.closed_book_prompt(fn.placeholder_question()), CLOSED_BOOK
    )
    kind = F.regexp_extract("title", "^(.*)-[^-]*$", 1)
    rare = op.chat_requests(videos, "model", fn.synthesis_prompt(kind), SYNTHESIS)
    return op.dedup_prompts(op.union_splits(shared, rare)).select(
        "model", op.prompt_hash(F.col("prompt")).alias("prompt_hash"), "prompt"
    )


@query
def flat_pairs(spark, sf_dir):
    return op.flatten_pairs(labelled_pairs(spark, sf_dir))


@query
def validated_pairs(spark, sf_dir):
    """Re-validation of placeholder pairs."""
    videos = view(spark, sf_dir, "v_videos")
    pairs = op.generate_qa(op.consecutive_segments(videos, keep_title=True), splits=SPLITS)
    return op.validate_qa(pairs).select(
        "split",
        "source_document.video_id",
        "source_document.start_time",
        "is_answerable_without_context",
        "context_similarity",
        "no_context_similarity",
    )


@query
def context_dependent(spark, sf_dir):
    pairs = op.context_dependent_only(labelled_pairs(spark, sf_dir))
    return pairs.select("source_document.video_id", "source_document.start_time", "question")


@query
def min_confidence(spark, sf_dir):
    pairs = op.min_confidence(op.with_confidence(labelled_pairs(spark, sf_dir)), 0.7)
    return pairs.select(
        "source_document.video_id", "source_document.start_time", "confidence_score"
    )


# -- splits and statistics ---------------------------------------------------------------------


@query
def expanded_splits(spark, sf_dir):
    return op.expand_splits(view(spark, sf_dir, "v_videos").select("video_id"), SPLITS)


@query
def ratio_split(spark, sf_dir):
    return op.assign_split(view(spark, sf_dir, "v_videos").select("video_id"), 0.8)


@query
def split_stats(spark, sf_dir):
    splits = (*PAIR_SPLITS, op.SplitConfig("unused", "writer-c", "reader-c"))
    return op.split_stats(labelled_pairs(spark, sf_dir), splits)


@query
def stats_report(spark, sf_dir):
    stats = op.split_stats(labelled_pairs(spark, sf_dir), PAIR_SPLITS)
    return op.stats_report(stats, PAIR_SPLITS)


@query
def third_split(spark, sf_dir):
    """The report of three splits, none of them left out."""
    stats = op.split_stats(labelled_pairs(spark, sf_dir, THREE_SPLITS), THREE_SPLITS)
    return op.stats_report(stats, THREE_SPLITS)


@query
def dataset_totals(spark, sf_dir):
    videos = view(spark, sf_dir, "v_videos")
    segments = op.consecutive_segments(videos, keep_title=True)
    return op.dataset_totals(videos, segments, op.generate_qa(segments, splits=SPLITS))


@query
def dataset_info(spark, sf_dir):
    videos = view(spark, sf_dir, "v_videos")
    pairs = labelled_pairs(spark, sf_dir)
    totals = op.dataset_totals(videos, op.consecutive_segments(videos))
    config = {"segment_duration": 30, "openai_api_key": "never written"}
    return sinks.dataset_info(totals, pairs, "set", "from tables", config).drop("created_at")


@query
def info_roundtrip(spark, sf_dir):
    """The manifest of three splits, written and read."""
    videos = view(spark, sf_dir, "v_videos")
    pairs = labelled_pairs(spark, sf_dir, THREE_SPLITS)
    totals = op.dataset_totals(videos, op.consecutive_segments(videos))
    info = sinks.dataset_info(totals, pairs, "set", "from tables", splits=THREE_SPLITS)
    path = scratch_path(spark, "info")
    sinks.write_dataset_info(info, path)
    return spark.read.schema(info.schema).json(path).drop("created_at", "config")


@query
def analyze_dataset(spark, sf_dir):
    stored = view(spark, sf_dir, "v_stored").select(
        F.from_json("document", DATASET).alias("document")
    )
    return op.analyze_dataset(stored.select("document.*"))


@query
def dataset_pairs(spark, sf_dir):
    """Pairs inside stored documents."""
    stored = view(spark, sf_dir, "v_stored").select(
        F.from_json("document", DATASET).alias("document")
    )
    return sources.dataset_pairs(stored.select("document.*")).select(
        "dataset", "split", "question", "answer"
    )


@query
def nested_splits(spark, sf_dir):
    nested = op.nest_splits(labelled_pairs(spark, sf_dir))
    return nested.select(
        "name",
        "llm_s_model",
        "llm_a_model",
        "video_id",
        "block",
        F.transform("qa_pairs", lambda p: p["question"]).alias("questions"),
        F.col("created_at").isNotNull().alias("dated"),
    )


# -- model calls, files, streams ---------------------------------------------------------------


def template_provider(requests):
    """A model that answers from the prompt alone, for tests."""
    answers = []
    for request in requests:
        if request.max_tokens == SYNTHESIS.max_tokens:
            passage = request.prompt.split("Transcript: ", 1)[1].split("\n\nReply with", 1)[0]
            answers.append(f"Question: What is said here?\nAnswer: {' '.join(passage.split())}")
        elif "Context: " in request.prompt:
            context = request.prompt.split("Context: ", 1)[1].split("\n\nQuestion: ", 1)[0]
            answers.append(" ".join(context.split()))
        else:
            answers.append("unknown")
    return answers


@query
def infer_batch(spark, sf_dir):
    """Open-book requests over conversation turns, answered in batches."""
    turns = view(spark, sf_dir, "v_responses").withColumn("model", F.lit("reader"))
    prompt = fn.open_book_prompt(F.lit("What is said here?"), F.col("answer"))
    requests = op.dedup_prompts(op.chat_requests(turns, "model", prompt, OPEN_BOOK))
    answered = op.infer_batch(requests, template_provider)
    answers = answered.select("request_id", "response", "error")
    return requests.join(answers, "request_id").select(
        op.prompt_hash(F.col("prompt")).alias("prompt_hash"), "response", "error"
    )


def failing_provider(requests):
    """A model that fails on prompts of certain lengths, for tests."""
    return [None if len(r.prompt) % 3 == 0 else "answer" for r in requests]


@query
def failed_calls(spark, sf_dir):
    """The failure report of a model that fails now and then."""
    turns = view(spark, sf_dir, "v_responses").withColumn("model", F.lit("reader"))
    prompt = fn.open_book_prompt(F.lit("What is said here?"), F.col("answer"))
    requests = op.dedup_prompts(op.chat_requests(turns, "model", prompt, OPEN_BOOK))
    return op.call_report(op.infer_batch(requests, failing_provider))


def dying_provider(requests):
    """A model that goes down at prompts of certain lengths, for tests."""
    if any(len(r.prompt) % 11 == 0 for r in requests):
        raise op.Outage("down")
    return [f"answer to {len(r.prompt)}" for r in requests]


def healthy_provider(requests):
    return [f"answer to {len(r.prompt)}" for r in requests]


@query
def resumed_calls(spark, sf_dir):
    """A run that an outage ends and a second one: every request is answered once by either."""
    turns = view(spark, sf_dir, "v_responses").withColumn("model", F.lit("reader"))
    prompt = fn.open_book_prompt(F.lit("What is said here?"), F.col("answer"))
    requests = op.dedup_prompts(op.chat_requests(turns, "model", prompt, OPEN_BOOK))
    log = op.ResponseLog(scratch_path(spark, "response-log"), buckets=16)
    try:
        op.infer_batch(requests, dying_provider, batch_size=8, log=log).count()
    except PythonException as problem:
        if "Outage" not in str(problem):
            raise
    answered = op.infer_batch(requests, healthy_provider, batch_size=8, log=log)
    answered = materialize(answered.select("request_id", "response", "error"), "answered")
    kept = log.rows(spark).groupBy("request_id").agg(F.count("*").alias("answers"))
    return (
        requests.join(answered, "request_id")
        .join(kept, "request_id")
        .select(op.prompt_hash(F.col("prompt")).alias("prompt_hash"), "response", "error", "answers")
    )


def settings_provider(requests):
    """A model that answers with the settings it was called with, for tests."""
    return [f"{r.model} {r.temperature} {r.max_tokens}" for r in requests]


@query
def request_settings(spark, sf_dir):
    """One prompt sent with two settings: one row for every row, each with its own responses."""
    turns = view(spark, sf_dir, "v_responses").withColumn("model", F.lit("reader"))
    prompt = F.col("answer")
    requests = op.union_splits(
        op.chat_requests(turns, "model", prompt, SYNTHESIS),
        op.chat_requests(turns, "model", prompt, OPEN_BOOK),
    )
    stored = materialize(op.infer_batch(op.dedup_prompts(requests), settings_provider), "answers")
    first = op.attach_responses(turns, stored, "model", prompt, SYNTHESIS, "first")
    both = op.attach_responses(first, stored, "model", prompt, OPEN_BOOK, "second")
    return both.select("conv_id", "turn", "first", "second")


@query
def provider_pairs(spark, sf_dir):
    """Generation with a called model for one split and templates for the other."""
    segments = op.pack_captions(view(spark, sf_dir, "v_captions"))
    splits = (op.SplitConfig("training", "writer", "reader"), op.SplitConfig("validation"))
    pairs = op.generate_qa(
        segments, view(spark, sf_dir, "v_videos"), splits, provider=template_provider
    )
    return pairs.select(
        "split",
        "source_document.video_id",
        "source_document.start_time",
        "question",
        "llm_a_model",
        "is_answerable_without_context",
        "is_answerable_with_context",
    )


@query
def validated_pairs_called(spark, sf_dir):
    """Generation and re-validation with a called model."""
    segments = op.pack_captions(view(spark, sf_dir, "v_captions"))
    splits = (op.SplitConfig("training", "writer", "reader"),)
    videos = view(spark, sf_dir, "v_videos")
    pairs = op.generate_qa(segments, videos, splits, provider=template_provider)
    return op.validate_qa(pairs, template_provider).select(
        "source_document.video_id",
        "source_document.start_time",
        "is_answerable_without_context",
        "context_similarity",
        "no_context_similarity",
    )


@query
def built_dataset(spark, sf_dir):
    """From videos, a few of them with captions, to the stored flat pairs."""
    out = scratch_path(spark, "built")
    plans.build_dataset(
        view(spark, sf_dir, "v_videos"), out, "set", captions=view(spark, sf_dir, "v_captions")
    )
    return sources.read_flat(spark, f"{out}/flat").select(
        "split", "video_id", "start_time", "end_time", "video_ref", "transcript", "question"
    )


@query
def build_report(spark, sf_dir):
    """What a build leaves out: videos of unusable durations and segments of blank captions."""
    number = F.col("video_id").cast("bigint")
    duration = (
        F.when(number % 7 == 0, F.lit(float("inf")))
        .when(number % 7 == 1, F.lit(None))
        .when(number % 7 == 2, 0.0)
        .otherwise(F.col("duration"))
    )
    videos = view(spark, sf_dir, "v_videos").withColumn("duration", duration)
    blank = F.col("video_id").cast("bigint") % 3 == 0
    text = F.when(blank, " ").otherwise(F.col("text"))
    captions = view(spark, sf_dir, "v_captions").withColumn("text", text)
    out = scratch_path(spark, "reported")
    plans.build_version(videos, out, "set", captions=captions).release()
    return spark.read.schema("stage string, reason string, rows bigint").json(
        f"{plans.current_version(out)}/report"
    )


@query
def late_captions(spark, sf_dir):
    """Captions that reach a stream after later ones of their video: every second one."""
    out = scratch_path(spark, "stream-late")
    captions = view(spark, sf_dir, "v_captions")
    for odd in (0, 1):
        part = captions.filter(F.col("seq") % 2 == odd)
        part.coalesce(1).write.mode("append").parquet(f"{out}/captions")
    stream = (
        spark.readStream.schema(captions.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{out}/captions")
    )
    segments = streaming.stream_segments(stream)
    with streaming.state_store(spark):
        (
            segments.writeStream.format("parquet")
            .option("path", f"{out}/segments")
            .option("checkpointLocation", f"{out}/checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    return streaming.late_captions(spark.read.schema(segments.schema).parquet(f"{out}/segments"))


@query
def validated_rows(spark, sf_dir):
    """Rows as text against a schema: good ones with its types, bad ones with the reason."""
    number = F.col("doc_id")
    raw = table(spark, sf_dir, "documents").select(
        number.cast("string").alias("row"),
        F.when(number % 6 == 0, "many").otherwise(F.col("n_chars").cast("string")).alias("length"),
        F.when(number % 7 != 0, F.col("source")).alias("source"),
        F.when(number % 4 == 0, F.lit(None)).otherwise(F.lit("1")).alias("passes"),
    )
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("source", T.StringType()),
            T.StructField("passes", T.IntegerType()),
        ]
    )
    good, bad = op.validate_rows(raw, schema, {"passes": 2})
    none = F.lit(None).cast("string")
    return good.withColumn("error", none).unionByName(
        bad.select(
            F.col("row").cast("bigint").alias("row"),
            F.lit(None).cast("bigint").alias("length"),
            none.alias("source"),
            F.lit(None).cast("int").alias("passes"),
            "error",
        )
    )


@query
def flat_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "flat")
    sinks.write_flat(labelled_pairs(spark, sf_dir), path)
    return sources.read_flat(spark, path)


@query
def splits_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "splits")
    sinks.write_splits_json(labelled_pairs(spark, sf_dir), path)
    return op.flatten_pairs(sources.read_splits_json(spark, path))


@query
def document_roundtrip(spark, sf_dir):
    """A nested document of three splits in several parts, written and read back."""
    path = scratch_path(spark, "document")
    pairs = labelled_pairs(spark, sf_dir, THREE_SPLITS).repartition(5)
    videos = view(spark, sf_dir, "v_videos")
    totals = op.dataset_totals(videos, op.consecutive_segments(videos))
    info = sinks.dataset_info(totals, pairs, "set", "from tables", splits=THREE_SPLITS)
    sinks.write_document(pairs, info, path, THREE_SPLITS)
    return op.flatten_pairs(sources.read_document_pairs(spark, path))


@query
def analyzed_documents(spark, sf_dir):
    """Documents of three and of two splits, in several parts each, analysed from their files."""
    root = scratch_path(spark, "documents")
    videos = view(spark, sf_dir, "v_videos")
    totals = op.dataset_totals(videos, op.consecutive_segments(videos))
    for name, splits in (("three", THREE_SPLITS), ("two", PAIR_SPLITS)):
        pairs = labelled_pairs(spark, sf_dir, splits).repartition(5)
        info = sinks.dataset_info(totals, pairs, name, f'"{name}" splits', splits=splits)
        sinks.write_document(pairs, info, f"{root}/{name}", splits)
    lines = op.analyze_documents(sources.read_document_frames(spark, root))
    return lines.filter(F.col("metric") != "created_at").drop("document")


@query
def document_lines(spark, sf_dir):
    """Lines of the nested document that hold a pair."""
    path = scratch_path(spark, "document")
    pairs = labelled_pairs(spark, sf_dir)
    videos = view(spark, sf_dir, "v_videos")
    totals = op.dataset_totals(videos, op.consecutive_segments(videos))
    info = sinks.dataset_info(totals, pairs, "set", "from tables")
    sinks.write_document(pairs, info, path, PAIR_SPLITS)
    line = F.regexp_replace("value", r"\A,(?=\{)", "")
    question = F.get_json_object(line, "$.question")
    video = F.get_json_object(line, "$.source_document.video_id")
    return (
        spark.read.text(path)
        .select(question.alias("question"), video.alias("video_id"))
        .filter(F.col("question").isNotNull())
    )


@query
def stream_pairs(spark, sf_dir):
    """Segments of a stream of videos, paired per micro-batch and stored."""
    videos = spark.readStream.schema(table(spark, sf_dir, "documents").schema).parquet(
        f"{sf_dir}/documents*.parquet"
    )
    videos = videos.select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.concat_ws("-", "lang", "source", F.col("doc_id").cast("string")).alias("title"),
        (F.col("n_chars") / F.lit(10.0)).alias("duration"),
    )
    out = scratch_path(spark, "stream-pairs")
    streaming.write_pairs_stream(
        op.consecutive_segments(videos),
        view(spark, sf_dir, "v_videos"),
        f"{out}/pairs",
        f"{out}/checkpoint",
        SPLITS,
    ).awaitTermination()
    return op.flatten_pairs(spark.read.parquet(f"{out}/pairs").drop("batch"))


@query
def stream_pairs_called(spark, sf_dir):
    """Segments of a stream of files, paired per micro-batch by a called model and stored."""
    out = scratch_path(spark, "stream-called")
    segments = op.pack_captions(view(spark, sf_dir, "v_captions"))
    segments.repartition(3).write.parquet(f"{out}/segments")
    stream = (
        spark.readStream.schema(segments.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{out}/segments")
    )
    streaming.write_pairs_stream(
        stream,
        view(spark, sf_dir, "v_videos"),
        f"{out}/pairs",
        f"{out}/checkpoint",
        (op.SplitConfig("training", "writer", "reader"),),
        template_provider,
    ).awaitTermination()
    return spark.read.parquet(f"{out}/pairs").select(
        "split",
        "source_document.video_id",
        "source_document.start_time",
        "question",
        "is_answerable_without_context",
        "is_answerable_with_context",
    )


@query
def stream_segments(spark, sf_dir):
    """Captions packed as a stream of several files, one per micro-batch, videos pausing between."""
    out = scratch_path(spark, "stream-segments")
    captions = view(spark, sf_dir, "v_captions")
    # files by the order of turns; a video of even number skips the second one
    part = F.least(F.floor(F.col("seq") / 2), F.lit(3))
    even = F.col("video_id").cast("bigint") % 2 == 0
    part = F.when(even & (part == 1), 2).otherwise(part)
    for number in range(4):
        captions.filter(part == number).coalesce(1).write.mode("append").parquet(f"{out}/captions")
    stream = (
        spark.readStream.schema(captions.schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(f"{out}/captions")
    )
    segments = streaming.stream_segments(stream)
    with streaming.state_store(spark):
        (
            segments.writeStream.format("parquet")
            .option("path", f"{out}/segments")
            .option("checkpointLocation", f"{out}/checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    return streaming.latest_segments(spark.read.schema(segments.schema).parquet(f"{out}/segments"))


@query
def stream_split_stats(spark, sf_dir):
    """Running counts over a stream of stored pairs."""
    out = scratch_path(spark, "stream-stats")
    sinks.write_flat(labelled_pairs(spark, sf_dir), f"{out}/pairs")
    counts = streaming.stream_split_stats(sources.read_flat(spark, f"{out}/pairs", stream=True))
    streaming.replace_each_batch(
        counts, f"{out}/stats", f"{out}/checkpoint", {"availableNow": True}
    ).awaitTermination()
    return streaming.latest_state(spark, f"{out}/stats")
