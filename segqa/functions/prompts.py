"""Prompt texts and the template answers of placeholder models, as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import timecode


@dataclass(frozen=True)
class ChatSettings:
    """What accompanies every prompt of one kind of call; ``call`` names it in reports."""

    system: str
    temperature: float
    max_tokens: int
    call: str = "chat"


# Temperature and token limit per kind of call.
SYNTHESIS = ChatSettings(
    "You write precise question and answer pairs about passages of video transcripts.",
    0.7,
    300,
    "synthesis",
)
CLOSED_BOOK = ChatSettings("You answer questions from general knowledge.", 0.3, 150, "closed_book")
OPEN_BOOK = ChatSettings("You answer questions from the passage you are given.", 0.3, 150, "open_book")


def is_placeholder(model: Column) -> Column:
    return model.startswith("placeholder-")


def placeholder_transcript(number: Column, start: Column, end: Column, title: Column) -> Column:
    """Stand-in text of a segment that has no transcript; ``number`` counts from 1."""
    # Wording of the stand-in text.
    return F.concat(
        F.lit("Transcript segment "),
        number.cast("string"),
        F.lit(" from "),
        timecode(start),
        F.lit(" to "),
        timecode(end),
        F.lit(" of video "),
        title,
    )


def synthesis_prompt(transcript: Column) -> Column:
    """Ask for one question and its answer in two tagged lines."""
    return F.concat(
        F.lit(
            "Read this passage of a video transcript and write one natural, specific question"
            " that the passage answers, with a short and direct answer.\n\nTranscript: "
        ),
        transcript,
        F.lit("\n\nReply with exactly these two lines:\nQuestion: <question>\nAnswer: <answer>"),
    )


def closed_book_prompt(question: Column, strict: bool = True) -> Column:
    """Ask without context. ``strict`` (generation) also forbids assuming one; re-validation does not."""
    rule = " Do not assume any particular context." if strict else ""
    return F.concat(
        F.lit(f"Answer this question from general knowledge.{rule}\n\nQuestion: "),
        question,
        F.lit("\n\nGive a concise answer."),
    )


def open_book_prompt(question: Column, context: Column) -> Column:
    """Ask with the segment as the only source."""
    return F.concat(
        F.lit("Answer the question from the context alone.\n\nContext: "),
        context,
        F.lit("\n\nQuestion: "),
        question,
        F.lit("\n\nGive a concise answer that uses nothing but the context."),
    )


# The template answers of placeholder models below.


def placeholder_question() -> Column:
    return F.lit("What is discussed in this transcript segment?")


def placeholder_answer(transcript: Column) -> Column:
    return F.concat(
        F.lit("This segment discusses: "), F.substring(transcript, 1, 100), F.lit("...")
    )


def placeholder_qa(transcript: Column) -> Column:
    """``struct(question, answer)`` of a placeholder model."""
    return F.struct(
        placeholder_question().alias("question"), placeholder_answer(transcript).alias("answer")
    )


def placeholder_answer_with_context(context: Column) -> Column:
    return F.concat(
        F.lit("Based on the context: "),
        F.substring(context, 1, 50),
        F.lit("... The answer is related to the provided transcript."),
    )


def placeholder_answer_without_context(question: Column) -> Column:
    return F.concat(F.lit("General knowledge answer for: "), question)
