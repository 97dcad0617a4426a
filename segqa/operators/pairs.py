"""Question-answer pairs: generation, re-validation, filters and the flat form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prompts import (
    CLOSED_BOOK,
    OPEN_BOOK,
    SYNTHESIS,
    closed_book_prompt,
    is_placeholder,
    open_book_prompt,
    placeholder_answer_with_context,
    placeholder_answer_without_context,
    placeholder_qa,
    synthesis_prompt,
)
from ..functions.text import (
    answer_similarity,
    answerable_with_context,
    answerable_without_context,
    parsed_pairs,
    strip,
)
from ..schemas import FLAT_PAIR, SPLIT_PAIR
from ..session import materialize
from .responses import ResponseLog
from .inference import Provider, attach_responses, chat_requests, dedup_prompts, infer_batch
from .splits import DEFAULT_SPLITS, SplitConfig, expand_splits

UNKNOWN_VIDEO = "Unknown Video"


def attach_video(segments: DataFrame, videos: DataFrame) -> DataFrame:
    """Add the video's title as ``video_ref``, ``Unknown Video`` if there is none.

    No strategy is forced, as the videos grow with the data: they are broadcast while small, beyond
    that the adaptive planner splits the side that holds a long video.
    """
    titles = videos.select("video_id", F.col("title").alias("video_ref"))
    return segments.join(titles, "video_id", "left").withColumn(
        "video_ref", F.coalesce("video_ref", F.lit(UNKNOWN_VIDEO))
    )


def with_source_document(segments: DataFrame) -> DataFrame:
    """Nest the provenance of a segment; needs ``video_ref``."""
    return segments.withColumn(
        "source_document",
        F.struct(
            F.col("text").alias("transcript"),
            "video_ref",
            F.col("timestamp").alias("timecode"),
            "video_id",
            "start_time",
            "end_time",
        ),
    )


def complete_pairs(df: DataFrame) -> DataFrame:
    """Drop pairs without a question or an answer."""
    return df.filter((F.col("question") != "") & (F.col("answer") != ""))


def generate_qa(
    segments: DataFrame,
    videos: DataFrame | None = None,
    splits: Sequence[SplitConfig] = DEFAULT_SPLITS,
    provider: Provider | None = None,
    keep_answers: bool = False,
    parallelism: int | None = None,
    calls: list[DataFrame] | None = None,
    log: ResponseLog | None = None,
) -> DataFrame:
    """At most one pair per segment and split, flagged by what the answering model can do.

    Placeholder models answer by fixed templates, wholly as column expressions. Other models need a
    ``provider``; its responses are stored before use, so no call is repeated and all consumers see
    the same text. ``videos`` is not needed if the segments carry ``video_ref``. ``keep_answers``
    keeps the model's two answers as columns. Stored responses are appended to ``calls``, whose
    failures ``call_report`` counts. Requests that ``log`` knows are not asked again.
    """
    _check_provider(splits, provider)
    titled = segments if "video_ref" in segments.columns else attach_video(segments, videos)
    sourced = with_source_document(titled).select("source_document")
    if provider is None:
        # templates do not depend on the split: make every pair once, then hand it to the splits
        made = _flagged(_template_pairs(sourced))
        pairs = expand_splits(made, splits, where=F.col("answer").isNotNull())
    else:
        # stored, as segments and questions are read both to ask about them and to add the answers
        sourced = materialize(sourced, "sourced")
        asked = materialize(
            _called_pairs(expand_splits(sourced, splits), provider, parallelism, calls, log), "asked"
        )
        pairs = _flagged(_both_answers(asked, provider, parallelism, True, calls, log))
    kept = ["answer_with_context", "answer_without_context"] if keep_answers else []
    return pairs.select(*SPLIT_PAIR.names, *kept)


def _template_pairs(sourced: DataFrame) -> DataFrame:
    transcript = F.col("source_document.transcript")
    made = placeholder_qa(transcript)
    # complete wherever there is a transcript, else the answer is null
    return sourced.select(
        "*",
        made["question"].alias("question"),
        made["answer"].alias("answer"),
        placeholder_answer_with_context(transcript).alias("answer_with_context"),
        placeholder_answer_without_context(made["question"]).alias("answer_without_context"),
    )


def _called_pairs(
    base: DataFrame,
    provider: Provider,
    parallelism: int | None,
    responses: list[DataFrame] | None,
    log: ResponseLog | None,
) -> DataFrame:
    transcript = F.col("source_document.transcript")
    call = {"synthesis": ("llm_s_model", synthesis_prompt(transcript), SYNTHESIS)}
    written = _answered(base, call, provider, parallelism, responses, log)
    made = F.when(
        is_placeholder(F.col("llm_s_model")), F.array(placeholder_qa(transcript))
    ).otherwise(parsed_pairs(F.col("synthesis")))
    return complete_pairs(written.select(*base.columns, F.inline(made)))


def _flagged(answered: DataFrame) -> DataFrame:
    expected = F.col("answer")
    return answered.withColumn(
        "is_answerable_without_context",
        answerable_without_context(F.col("answer_without_context"), expected),
    ).withColumn(
        "is_answerable_with_context",
        answerable_with_context(F.col("answer_with_context"), expected),
    )


def validate_qa(
    pairs: DataFrame,
    provider: Provider | None = None,
    parallelism: int | None = None,
    calls: list[DataFrame] | None = None,
    log: ResponseLog | None = None,
) -> DataFrame:
    """Ask again with and without context and renew ``is_answerable_without_context``.

    Both similarities are kept as columns; no pair is removed and the other flag is left alone. A
    failed call counts as an empty answer; stored responses are appended to ``calls``. Requests that
    ``log`` knows are not asked again.
    """
    if provider is not None:
        pairs = materialize(pairs, "to-validate")  # read to ask and to add the answers
    answered = _both_answers(pairs, provider, parallelism, False, calls, log)
    expected = F.col("answer")
    return (
        answered.withColumn(
            "context_similarity", answer_similarity(F.col("answer_with_context"), expected)
        )
        .withColumn(
            "no_context_similarity", answer_similarity(F.col("answer_without_context"), expected)
        )
        .withColumn(
            "is_answerable_without_context",
            answerable_without_context(F.col("answer_without_context"), expected),
        )
        .select(*pairs.columns, "context_similarity", "no_context_similarity")
    )


def _check_provider(splits: Sequence[SplitConfig], provider: Provider | None) -> None:
    real = {
        model
        for split in splits
        for model in (split.llm_s_model, split.llm_a_model)
        if not model.startswith("placeholder-")
    }
    if real and provider is None:
        raise ValueError(f"a provider is needed for {sorted(real)}")


def _answered(
    df: DataFrame,
    calls: dict[str, tuple],
    provider: Provider | None,
    parallelism: int | None,
    stored: list[DataFrame] | None,
    log: ResponseLog | None,
) -> DataFrame:
    """Add one response column per call ``(model column, prompt, settings)``.

    All calls share one stored table of distinct requests. Placeholder models are never called.
    """
    if provider is None:
        return df
    real = [
        chat_requests(df.filter(~is_placeholder(F.col(model))), model, prompt, settings)
        for model, prompt, settings in calls.values()
    ]
    requests = real[0]
    for more in real[1:]:
        requests = requests.unionByName(more)
    responses = materialize(
        infer_batch(dedup_prompts(requests), provider, parallelism=parallelism, log=log),
        "responses",
    )
    if stored is not None:
        stored.append(responses)
    for name, (model, prompt, settings) in calls.items():
        df = attach_responses(df, responses, model, prompt, settings, name)
    return df


def _both_answers(
    pairs: DataFrame,
    provider: Provider | None,
    parallelism: int | None,
    strict: bool,
    responses: list[DataFrame] | None,
    log: ResponseLog | None,
) -> DataFrame:
    """Add ``answer_with_context`` and ``answer_without_context`` of the answering model."""
    question, context = F.col("question"), F.col("source_document.transcript")
    model = F.col("llm_a_model")
    calls = {
        "open_book": ("llm_a_model", open_book_prompt(question, context), OPEN_BOOK),
        "closed_book": ("llm_a_model", closed_book_prompt(question, strict), CLOSED_BOOK),
    }
    answered = _answered(pairs, calls, provider, parallelism, responses, log)

    def answer(name: str, by_template: Column) -> Column:
        if provider is None:
            missing = F.raise_error(F.concat(F.lit("no provider for model "), model))
            return F.when(is_placeholder(model), by_template).otherwise(missing.cast("string"))
        return F.when(is_placeholder(model), by_template).otherwise(
            strip(F.coalesce(F.col(name), F.lit("")))
        )

    return answered.select(
        *pairs.columns,
        answer("open_book", placeholder_answer_with_context(context)).alias("answer_with_context"),
        answer("closed_book", placeholder_answer_without_context(question)).alias(
            "answer_without_context"
        ),
    )


def flatten_pairs(pairs: DataFrame) -> DataFrame:
    """The twelve flat columns of a pair, after ``split`` if there is one."""
    split = ["split"] if "split" in pairs.columns else []
    nested = {"transcript", "video_ref", "timecode", "video_id", "start_time", "end_time"}
    return pairs.select(
        *split,
        *[F.col(f"source_document.{c}" if c in nested else c) for c in FLAT_PAIR.names],
    )


def context_dependent_only(pairs: DataFrame) -> DataFrame:
    """Drop questions that are answerable without their context."""
    return pairs.filter(~F.col("is_answerable_without_context"))


def with_confidence(pairs: DataFrame) -> DataFrame:
    """Add ``confidence_score``: how close the answer given the context is to the expected one."""
    score = answer_similarity(F.col("answer_with_context"), F.col("answer"))
    # exploded, so that a filter on the score is not pushed below it together with a second copy
    return pairs.select("*", F.explode(F.array(score)).alias("confidence_score"))


def min_confidence(pairs: DataFrame, threshold: float = 0.7) -> DataFrame:
    return pairs.filter(F.col("confidence_score") >= threshold)
