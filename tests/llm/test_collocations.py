"""Phrases against plain counts of all phrases."""

import random
import re
from collections import Counter

import pytest

from segqa.llm import collocations

from .conftest import table


def plain(rows, least, top):
    counts, totals = {}, Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            own = counts.setdefault(lang, Counter())
            for k in range(1, 6):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        often = {g: n for g, n in own.items() if len(g) > 1 and n >= least}
        ranked = []
        for gram, a in often.items():
            if any(
                len(h) > len(gram) and n >= a
                and any(h[i : i + len(gram)] == gram for i in range(len(h) - len(gram) + 1))
                for h, n in often.items()
            ):
                continue
            cuts = [(1000 * a * totals[lang] // (own[gram[:k]] * own[gram[k:]]), k) for k in range(1, len(gram))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(gram).encode(), own[gram[:k]], own[gram[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("least,top,cells", [(2, 40, None), (3, 1000, 64), (5, 7, 1 << 20)])
def test_phrases_equal_plain_counts(spark, awkward_rows, least, top, cells):
    rng = random.Random(least)
    units = ["the end of", "New York, state", "a b a b a", "x", "Été", "of the\tthe", "\v", "wait! what", "z\x1cz"]
    rows = [r for r in awkward_rows if r[0] != 9]
    rows += [(100 + k, " ".join(rng.choices(units, k=40)), rng.choice(["en", "fr", None, "und"]), "s") for k in range(25)]
    found = collocations.collocations(table(spark, rows), least, top, cells).collect()
    assert sorted(tuple(r) for r in found) == plain(rows, least, top)


def test_large_numbers_stay_exact(spark):
    big = spark.createDataFrame([(10**15 + 7, 10**16 - 9, 10**15 + 9, 10**15 + 11)], "a long, n long, l long, r long")
    (row,) = big.select(collocations._score(big.a, big.n, big.l, big.r).alias("s")).collect()
    assert row.s == 1000 * (10**15 + 7) * (10**16 - 9) // ((10**15 + 9) * (10**15 + 11))


def test_no_phrases(spark, empty):
    assert collocations.collocations(empty).count() == 0
    assert collocations.collocations(table(spark, [(1, None, "en", "a"), (2, "one two", None, "a")])).count() == 0
