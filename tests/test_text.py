import sys

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segqa import functions as fn
from segqa.functions.prompts import CLOSED_BOOK, OPEN_BOOK, SYNTHESIS

from . import plain

few = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
BLANKS = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0  　"
text = st.text(
    st.sampled_from("abAB:é​?." + BLANKS) | st.characters(codec="utf-8", max_codepoint=0x2FFF),
    max_size=24,
)


def values(spark, rows, schema, *columns):
    """Rows of the given columns in input order."""
    numbered = [(i, *row) for i, row in enumerate(rows)]
    df = spark.createDataFrame(numbered, f"i int, {schema}").orderBy("i")
    return [tuple(r) for r in df.select(*columns).collect()]


def one(spark, value, schema, column):
    return values(spark, [(value,)], schema, column)[0][0]


@pytest.mark.parametrize(
    "seconds,expected",
    [
        (0.0, "00:00:00"),
        (61.0, "00:01:01"),
        (3661.0, "01:01:01"),
        (59.999, "00:00:59"),
        (360000.0, "100:00:00"),
    ],
)
def test_timecode(spark, seconds, expected):
    assert one(spark, seconds, "s double", fn.timecode(F.col("s"))) == expected


def test_timecode_many(spark):
    seconds = [i * 7.31 for i in range(3000)] + [float(3600 * i) for i in range(300)]
    got = values(spark, [(s,) for s in seconds], "s double", fn.timecode(F.col("s")))
    assert [g for (g,) in got] == [plain.clock(s) for s in seconds]


def test_strip_every_character(spark):
    points = [c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(c, chr(c)) for c in range(0, 0x3100) if not 0xD800 <= c < 0xE000], "c int, t string")
    blank = {r.c for r in df.filter(fn.strip(F.col("t")) == "").collect()}
    assert blank == {c for c in points if chr(c).isspace()}


@few
@given(st.lists(text, min_size=50, max_size=200))
def test_strip_matches_python(spark, texts):
    got = values(spark, [(t,) for t in texts], "t string", fn.strip(F.col("t")))
    assert [g for (g,) in got] == [t.strip() for t in texts]


def test_strip_long_inner_blanks(spark):
    long = "a" + " " * 200_000 + "b"
    assert one(spark, f"  {long}\n", "t string", fn.strip(F.col("t"))) == long


@pytest.mark.parametrize(
    "url,expected",
    [
        ("https://www.youtube.com/watch?v=abc&t=1", "abc"),
        ("https://youtu.be/abc?t=1", "abc"),
        ("https://youtube.com/embed/abc#x", "abc"),
        ("youtube.com/watch?list=1&v=L2&v=L3", "L3"),
        ("youtube.com/watch?v=", None),
        ("example.com/watch?v=1", None),
        ("youtube.com/watch?\rx&v=a", "a"),
    ],
)
def test_youtube_id(spark, url, expected):
    assert one(spark, url, "u string", fn.youtube_id(F.col("u"))) == expected


@pytest.mark.parametrize(
    "path,stem",
    [("/a/b.mp4", "b"), ("/a/b.tar.gz", "b.tar"), ("/a/.mp4", ".mp4"), ("c", "c"), ("/a.b/c.", "c.")],
)
def test_file_stem(spark, path, stem):
    assert one(spark, path, "p string", fn.file_stem(F.col("p"))) == stem


RESPONSES = [
    "\n   Question: What is machine learning?\n   Answer: A subset of artificial intelligence.\n",
    "   Question: What is machine learning?\n   ",
    "Question: a\nQuestion:\nAnswer: c",
    "question: a\nAnswer: b",
    "Question: a\r\nAnswer: Answer: b Answer: c\n",
    "Answer: b\nQuestion: a\nQuestion: z",
    "",
]


def test_parse_qa(spark):
    got = values(
        spark, [(r,) for r in RESPONSES], "r string", fn.parse_qa(F.col("r")).alias("qa")
    )
    assert [tuple(g) for (g,) in got] == [plain.tagged(r) for r in RESPONSES]
    assert tuple(got[1][0]) == (None, None)
    assert tuple(got[0][0])[0] == "What is machine learning?"


@few
@given(
    st.lists(
        st.lists(st.sampled_from(["Question:", "Answer:", "\n", " ", "a", "b ", "\r\n", "Question"]))
        .map("".join),
        min_size=50,
        max_size=150,
    )
)
def test_parse_qa_matches_plain(spark, responses):
    got = values(
        spark, [(r,) for r in responses], "r string", fn.parse_qa(F.col("r")).alias("qa")
    )
    assert [tuple(g) for (g,) in got] == [plain.tagged(r) for r in responses]


def similarity(spark, pairs):
    got = values(
        spark, pairs, "a string, b string", fn.answer_similarity(F.col("a"), F.col("b"))
    )
    return [g for (g,) in got]


def test_similarity_vectors(spark):
    base = "Machine learning is a subset of artificial intelligence"
    pairs = [
        (base, "Machine learning is a subset of AI"),
        (base, "The weather is sunny today"),
        ("", "a"),
        ("A a", "a"),
        (None, "a"),
        (" \n", ""),
    ]
    assert similarity(spark, pairs) == [6 / 9, 1 / 12, 0.0, 1.0, 0.0, 0.0]


@few
@given(st.lists(st.tuples(text, text), min_size=50, max_size=150))
def test_similarity_matches_plain(spark, pairs):
    got = similarity(spark, pairs)
    assert got == [plain.jaccard(a, b) for a, b in pairs]
    assert got == similarity(spark, [(b, a) for a, b in pairs])
    assert all(0 <= s <= 1 for s in got)
    same = similarity(spark, [(a, a) for a, _ in pairs])
    assert same == [1.0 if a.split() else 0.0 for a, _ in pairs]


def test_threshold_is_strict(spark):
    ten = "a b c d e f g h i j"
    rows = [("a b c d e f g", ten), ("a b c d e f g h", ten), (None, ten)]
    got = values(spark, rows, "a string, b string", fn.answerable(F.col("a"), F.col("b")))
    assert [g for (g,) in got] == [False, True, False]


def test_models_and_words(spark):
    names = ["placeholder-llm-s", "placeholder-llm-a", "gpt-4", "gpt-3.5-turbo"]
    got = values(spark, [(n,) for n in names], "m string", fn.is_placeholder(F.col("m")))
    assert [g for (g,) in got] == [True, True, False, False]
    got = values(
        spark, [("Somewhat",), ("is it?",), ("WHY",)], "q string", fn.has_question_word(F.col("q"))
    )
    assert [g for (g,) in got] == [True, False, True]


def test_templates(spark):
    long = "x" * 120
    row = values(
        spark,
        [(long,)],
        "t string",
        fn.placeholder_question(),
        fn.placeholder_answer(F.col("t")),
        fn.placeholder_answer_with_context(F.col("t")),
        fn.placeholder_answer_without_context(F.lit("why?")),
    )[0]
    assert row == (
        "What is discussed in this transcript segment?",
        f"This segment discusses: {'x' * 100}...",
        f"Based on the context: {'x' * 50}... The answer is related to the provided transcript.",
        "General knowledge answer for: why?",
    )


def test_prompts_carry_their_parts(spark):
    row = values(
        spark,
        [("passage", "why?")],
        "t string, q string",
        fn.synthesis_prompt(F.col("t")),
        fn.closed_book_prompt(F.col("q")),
        fn.closed_book_prompt(F.col("q"), strict=False),
        fn.open_book_prompt(F.col("q"), F.col("t")),
    )[0]
    assert "passage" in row[0] and "Question:" in row[0] and "Answer:" in row[0]
    assert "why?" in row[1] and "passage" not in row[1]
    assert row[1] != row[2]
    assert "why?" in row[3] and "passage" in row[3]
    assert (SYNTHESIS.temperature, SYNTHESIS.max_tokens) == (0.7, 300)
    assert (OPEN_BOOK.temperature, OPEN_BOOK.max_tokens) == (0.3, 150)
    assert (CLOSED_BOOK.temperature, CLOSED_BOOK.max_tokens) == (0.3, 150)
