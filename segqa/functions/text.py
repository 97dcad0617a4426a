"""Scalar text functions as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python's str.isspace() accepts.
BLANK_POINTS = (
    *range(0x09, 0x0E),
    *range(0x1C, 0x21),
    0x85,
    0xA0,
    0x1680,
    *range(0x2000, 0x200B),
    0x2028,
    0x2029,
    0x202F,
    0x205F,
    0x3000,
)
BLANKS = "".join(map(chr, BLANK_POINTS))
# The same set as a pattern; listing the ranges would be three times slower.
BLANK_RUN = r"(?U)[\s\x1c-\x1f]+"

# The two URL shapes that carry a platform id, tried in this order. The flag d makes
# `.` stop at a line feed only.
URL_PATTERNS = (
    r"(?:youtube\.com/watch\?v=|youtu\.be/|youtube\.com/embed/)([^&\n?#]+)",
    r"(?d)youtube\.com/watch\?.*v=([^&\n?#]+)",
)

# Question words.
QUESTION_WORDS = ("what", "when", "where", "who", "how", "why")

# Fixed value: above this similarity an answer counts as the expected one.
ANSWERABLE_ABOVE = 0.7


def strip(text: Column) -> Column:
    """Remove leading and trailing Unicode blanks."""
    return F.btrim(text, F.lit(BLANKS))


def timecode(seconds: Column) -> Column:
    """``HH:MM:SS`` with the fraction cut off; hours grow beyond two digits when needed."""
    whole = F.floor(seconds)
    in_hour = F.pmod(whole, F.lit(3600))
    parts = (
        F.floor((whole - in_hour) / 3600),
        F.floor(in_hour / 60),
        F.pmod(in_hour, F.lit(60)),
    )
    return F.concat_ws(":", *(_two_digits(part) for part in parts))


def _two_digits(number: Column) -> Column:
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(2)), F.lit("0"))


def youtube_id(url: Column) -> Column:
    """Platform id in a video URL, null if there is none."""
    found = [F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in URL_PATTERNS]
    return F.coalesce(*found)


def file_stem(path: Column) -> Column:
    """File name without folders and without its last suffix."""
    return F.regexp_replace(
        F.substring_index(path, "/", -1), r"(?s)\A(.+)\.[^.]+\z", "$1"
    )


def parse_qa(response: Column) -> Column:
    """``struct(question, answer)`` of a tagged response; both null unless both are present.

    The last tagged line wins, every occurrence of the tag in it is removed.
    """
    nothing = F.lit(None).cast("string")
    return F.coalesce(
        F.try_element_at(parsed_pairs(response), F.lit(1)),
        F.struct(nothing.alias("question"), nothing.alias("answer")),
    )


def parsed_pairs(response: Column) -> Column:
    """The parsed pair as an array of one, empty if incomplete.

    Exploding it (``inline``) parses each response once; a later filter on the fields of
    :func:`parse_qa` would be pushed down together with a second copy of the parsing.
    """
    lines = F.split(response, "\n")

    def last_tagged(tag: str) -> Column:
        tagged = F.filter(lines, lambda line: strip(line).startswith(tag))
        return strip(F.replace(F.try_element_at(tagged, F.lit(-1)), F.lit(tag), F.lit("")))

    pair = F.struct(
        last_tagged("Question:").alias("question"), last_tagged("Answer:").alias("answer")
    )
    return F.filter(F.array(pair), lambda p: (p["question"] != "") & (p["answer"] != ""))


def tokens(text: Column) -> Column:
    """Distinct lower-cased words."""
    return F.array_distinct(_words(text))


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), BLANK_RUN), "")


def answer_similarity(first: Column, second: Column) -> Column:
    """Jaccard similarity of the word sets, 0.0 if either is empty or missing.

    Intersection and union treat the word lists as sets; two empty ones have a union of size 0.
    """
    a, b = _words(first), _words(second)
    common, either = F.array_size(F.array_intersect(a, b)), F.array_size(F.array_union(a, b))
    return F.coalesce(F.try_divide(common.cast("double"), either), F.lit(0.0))


def answerable(answer: Column, expected: Column) -> Column:
    """Whether ``answer`` matches the expected one, strictly above the threshold."""
    return answer_similarity(answer, expected) > ANSWERABLE_ABOVE


def answerable_without_context(answer: Column, expected: Column) -> Column:
    """Whether the answer given without the segment matches; a failed answer does not."""
    return answerable(answer, expected)


def answerable_with_context(answer: Column, expected: Column) -> Column:
    """Whether the answer given from the segment matches; a failed answer does not."""
    return answerable(answer, expected)


def has_question_word(question: Column) -> Column:
    return F.lower(question).rlike("|".join(QUESTION_WORDS))
