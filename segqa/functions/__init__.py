from .prompts import (
    closed_book_prompt,
    is_placeholder,
    open_book_prompt,
    placeholder_answer_with_context,
    placeholder_answer_without_context,
    placeholder_question,
    placeholder_answer,
    placeholder_qa,
    placeholder_transcript,
    synthesis_prompt,
)
from .text import (
    answer_similarity,
    answerable,
    answerable_with_context,
    answerable_without_context,
    file_stem,
    has_question_word,
    parse_qa,
    parsed_pairs,
    strip,
    timecode,
    tokens,
    youtube_id,
)

__all__ = [
    "answer_similarity",
    "answerable",
    "answerable_with_context",
    "answerable_without_context",
    "closed_book_prompt",
    "file_stem",
    "has_question_word",
    "is_placeholder",
    "open_book_prompt",
    "parse_qa",
    "parsed_pairs",
    "placeholder_answer",
    "placeholder_answer_with_context",
    "placeholder_answer_without_context",
    "placeholder_qa",
    "placeholder_question",
    "placeholder_transcript",
    "strip",
    "synthesis_prompt",
    "timecode",
    "tokens",
    "youtube_id",
]
