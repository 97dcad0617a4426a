"""Language identification and the n-gram model against plain restatements."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from segqa.llm import elias_fano, langid, ngram_model

from .conftest import table, words


def plain_bits(training, text):
    """Code length of ``text`` by escape method C over contexts of three bytes and less."""
    counts = [defaultdict(Counter) for _ in range(4)]
    for t in training:
        data = b"   " + t
        for i in range(3, len(data)):
            for k in range(4):
                counts[k][data[i - k : i]][data[i]] += 1
    data, bits = b"   " + text, 0.0
    for i in range(3, len(data)):
        p, escape = 0.0, 1.0
        for k in (3, 2, 1, 0):
            seen = counts[k].get(data[i - k : i])
            if seen:
                total, kinds = sum(seen.values()), len(seen)
                if data[i] in seen:
                    p = escape * seen[data[i]] / (total + kinds)
                    break
                escape *= kinds / (total + kinds)
        else:
            p = escape / 256
        bits -= math.log2(p)
    return bits


def test_code_lengths_equal_plain_matching(spark):
    rng = random.Random(3)
    docs = [(k, words(rng, 30, 40) + " été", "xy"[k % 2], "s") for k in range(30)]
    trees = langid.train(table(spark, docs))
    texts = ["", "w1 w2", "zz é w3", docs[0][1]]
    bits = langid.code_lengths(trees, [t.encode() for t in texts])
    for column, lang in enumerate(trees.languages):
        training = [t.encode() for _, t, g, _ in docs if g == lang]
        for row, text in enumerate(texts):
            assert bits[row, column] == pytest.approx(plain_bits(training, text.encode()), rel=1e-4)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    trees = langid.train(docs.filter("doc_id % 2 = 0"))
    told = langid.identify(docs.filter("doc_id % 2 = 1"), trees)
    hits = told.selectExpr("avg(cast(lang = lang_pred as int)) a", "min(score) s").first()
    assert hits.a >= 0.97 and 0 <= hits.s <= 1


def test_identify_awkward(awkward, awkward_rows):
    trees = langid.train(awkward)
    rows = langid.identify(awkward, trees).collect()
    assert len(rows) == len(awkward_rows)
    for r in rows:
        if not any(map(str.isalpha, r.text or "")):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in trees.languages and 0 <= r.score <= 1
    alone = langid.identify(awkward.select("doc_id", "text"), trees).collect()
    assert Counter((r.doc_id, r.lang_pred, r.score) for r in alone) == Counter(
        (r.doc_id, r.lang_pred, r.score) for r in rows
    )


def test_identify_without_languages(awkward, empty):
    nothing = langid.train(empty)
    assert {r.lang_pred for r in langid.identify(awkward, nothing).collect()} == {"und"}
    assert langid.identify(empty, langid.train(awkward)).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 1), (5, 10), (1000, 3), (1000, 10**6), (20_000, 2**63)):
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        words_ = elias_fano.encode(values)
        sequence = elias_fano.EliasFano(words_)
        assert (elias_fano.decode(words_) == values).all()
        assert (sequence.access(np.arange(n)) == values).all()
        asked = np.concatenate([values, values + np.uint64(1), np.array([0, top], np.uint64)])
        assert (sequence.successor(asked) == np.searchsorted(values, asked)).all()
    assert len(words_) * 64 / n < 3.5 + math.log2(2**63 / n)


def plain_scores(rows, order):
    end = object()
    tokens = [[*(t or "").encode().lower().split(), end] for _, t, *_ in rows]
    grams = [Counter() for _ in range(order)]
    for own in tokens:
        for k in range(order):
            grams[k].update(tuple(own[i - k : i + 1]) for i in range(k, len(own)))
    total, kinds = [Counter() for _ in range(order)], [Counter() for _ in range(order)]
    for k in range(1, order):
        for gram, n in grams[k].items():
            total[k][gram[:-1]] += n
            kinds[k][gram[:-1]] += 1
    n_all, v = sum(grams[0].values()), len(grams[0])
    out = []
    for own in tokens:
        base = score = 0.0
        for i in range(len(own)):
            p = (grams[0][own[i],] + 0.1) / (n_all + 0.1 * (v + 1))
            base += math.log10(p)
            for k in range(1, min(order, i + 1)):
                context = tuple(own[i - k : i])
                if total[k][context]:
                    found = max(grams[k][(*context, own[i])] - ngram_model.DISCOUNT, 0)
                    p = (found + ngram_model.DISCOUNT * kinds[k][context] * p) / total[k][context]
            score += math.log10(p)
        out.append((len(own), base, score))
    return out


@pytest.mark.parametrize("order,shard_tokens", [(1, 10**6), (2, 300), (3, 300), (4, 10**6)])
def test_scores_equal_plain_model(spark, awkward_rows, order, shard_tokens):
    rng = random.Random(9)
    rows = [*awkward_rows, *((300 + k, words(rng, 60, 50), "en", "a") for k in range(30))]
    docs = table(spark, rows)
    model = ngram_model.train(docs, order, shard_tokens)
    found = ngram_model.score(docs, model).collect()
    expected = plain_scores(rows, order)
    assert model.tokens == sum(n for n, *_ in expected)
    by_text = {t: e for (_, t, *_), e in zip(rows, expected)}
    for r in found:
        n, base, score = by_text[r.text]
        assert (r.n_tokens, r.n_known) == (n, n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(score, abs=0.001 * n)
        assert r.name in ("own", None)


def test_model_without_training(spark, awkward, empty):
    rows = ngram_model.score(awkward, ngram_model.train(empty)).collect()
    assert len(rows) == awkward.count() and {r.n_known for r in rows} == {0}
    assert ngram_model.score(empty, ngram_model.train(awkward)).count() == 0
