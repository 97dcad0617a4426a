"""Periodic runs against their definition."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from segqa.llm import periodic
from segqa.llm.queries import op12_periodic_runs
from segqa.llm.wavelet import WaveletMatrix

from .conftest import table


def plain_runs(words):
    """Every (start, length, period) by trying all periods."""
    names = {w: k for k, w in enumerate(words)}
    own = np.array([names[w] for w in words])
    found = {}
    for q in range(1, len(own) // 4 + 1):
        same = np.concatenate([[False], own[q:] == own[:-q], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for i, j in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(
    st.lists(st.sampled_from("ab"), max_size=40),
    st.lists(st.sampled_from("abc"), max_size=12).flatmap(
        lambda unit: st.integers(0, 9).map(lambda k: unit * k + unit[: k // 2])),
    st.lists(st.sampled_from(["a", "aab", "b"]), max_size=30),
    st.integers(0, 60).map(lambda n: ["x"] * n),
), min_size=1, max_size=6))
def test_runs_of_a_batch_equal_the_definition(texts):
    names = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}))}
    symbols = []
    for k, text in enumerate(texts):
        symbols += [names[w] for w in text] + [len(names) + k]
    start, length, period = periodic.find_runs(np.array(symbols), max(map(len, texts)))
    expected, at = [], 0
    for text in texts:
        expected += [(at + s, n, q) for s, n, q in plain_runs(text)]
        at += len(text) + 1
    assert list(zip(start.tolist(), length.tolist(), period.tolist())) == expected


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    values = rng.permutation(300)
    tree = WaveletMatrix(values)
    left = rng.integers(0, 299, 200)
    right = left + 1 + rng.integers(0, 300 - left)
    bound = rng.integers(0, 300, 200)
    rank = rng.integers(0, right - left)
    assert tree.less(left, right, bound).tolist() == [
        int((values[a:b] < x).sum()) for a, b, x in zip(left, right, bound)
    ]
    assert tree.nth(left, right, rank).tolist() == [
        int(np.sort(values[a:b])[k]) for a, b, k in zip(left, right, rank)
    ]


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_query_equals_the_definition(spark, tmp_path, awkward_rows):
    rows = [r for r in awkward_rows if r[0] is not None]
    rows += [(1000 + k, f"w{k} " + "some words here\tand  more " * (k % 7), "en", "a") for k in range(120)]
    table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = {(r.doc_id, r.collapsed_sha256): r for r in op12_periodic_runs(spark, str(tmp_path)).collect()}
    planted_runs = 0
    for doc_id, text, *_ in rows:
        before = re.findall("[^\x20\x09-\x0d]+", text or "")
        words = planted(doc_id, before)
        runs = plain_runs(words)
        planted_runs += bool(runs) and words != before
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        digest = hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
        r = found[doc_id, digest]
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        if runs:
            s, n, q = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, n, q, 1000 * n // q)
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
    assert planted_runs > 3


def test_awkward_tables(spark, awkward, awkward_rows, empty):
    rows = periodic.periodic_runs(awkward).collect()
    assert len(rows) == len(awkward_rows)
    for r in rows:
        words = re.findall("[^\x20\x09-\x0d]+", r.text or "")
        assert r.n_words == len(words) and r.name in ("own", None)
        assert [tuple(x) for x in r.runs] == plain_runs(words)
        assert r.collapsed == plain_collapse(words, plain_runs(words))
    assert periodic.periodic_runs(empty).count() == 0
