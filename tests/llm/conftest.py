import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names that operators use for what they add or for work of their own
    "kept string, score string, piece string, pos string, `key` string, size string, "
    "n_lines string, copies string, _id string, name string, line string"
)


def words(rng, count, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(count))


def table(spark, rows, partitions=3):
    """Documents of (doc_id, text, lang, source) with columns that clash."""
    full = [(i, t, g, s, None if t is None else len(t), *["own"] * 10) for i, t, g, s in rows]
    full = [r + (None,) * (16 - len(r)) for r in full]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions)


@pytest.fixture(scope="session")
def awkward_rows():
    rng = random.Random(5)
    prose = words(rng, 300)
    lines = "\n".join(words(rng, 12) for _ in range(20))
    long = "\n".join(words(rng, 15, 5000) for _ in range(1500))
    rows = [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, "   \n\t ", "en", None),
        (4, prose, "en", "a"),
        (5, prose, "en", "b"),
        (5, prose, "en", "b"),  # the whole row again
        (6, prose + " ", "en", "a"),
        (None, prose, "fr", "a"),
        (None, lines, "fr", "c"),
        (7, lines, "en", "a"),
        (8, lines.upper() + "\nmore of it here", "en", "é"),
        (9, long, "en", "a"),
        (10, "x", "en", "a"),
        (11, "Été ǅ \U0001f600 naïve " * 40, "fr", "c"),
        (12, "a" * 5000, "en", "a"),
        (13, "12345 !!! 67890", None, "b"),
        (-4, lines + "\n" + prose, "en", "zz"),
        (2**62, "the same line of text\n" * 50, "en", "a"),
    ]
    return rows


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    return table(spark, awkward_rows).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return table(spark, [], 1)
