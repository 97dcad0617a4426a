"""Exact, line, near and substring deduplication against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from segqa.llm import exact_dedup, line_dedup, near, suffix_dedup
from segqa.llm.suffix_array import suffix_array

from .conftest import table, words

BLANKS = " \t\n\x0b\x0c\r"


def exact_expected(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups["".join(c for c in text or "" if c not in BLANKS)].append((doc_id, len(text or "")))
    out = Counter()
    for content, own in groups.items():
        best = min(own, key=lambda r: (-r[1], r[0] is None, r[0] or 0))
        sha = hashlib.sha256(content.encode()).hexdigest()
        for row in own:
            out[row[0], best[0], len(own), row == best, sha] += 1
    return out


@pytest.mark.parametrize("table_bytes", [exact_dedup.TABLE_BYTES, 2000])
def test_exact(spark, awkward, awkward_rows, table_bytes):
    rows = exact_dedup.exact_duplicates(awkward, table_bytes).collect()
    assert Counter(tuple(r) for r in rows) == exact_expected(awkward_rows)


def test_grace_partitions_recursively(tmp_path):
    rng = random.Random(1)
    contents = [words(rng, 20).encode() for _ in range(300)] * 3
    records = [(hashlib.sha256(c).digest(), c, len(c), k, 1) for k, c in enumerate(contents)]
    tables = list(exact_dedup._grace(iter(records), str(tmp_path), 3000))
    assert len(tables) > 16  # deeper than one level of files
    found = Counter({row[1]: row[4] for rows in tables for row in rows})
    assert found == Counter(contents)
    assert not list(tmp_path.rglob("*.spill"))


def test_contents_are_compared(spark):
    table_ = exact_dedup.ContentTable()
    key = b"k" * 32
    table_.add(key, b"one", 3, 1, 1)
    with pytest.raises(ValueError):
        table_.add(key, b"two", 3, 2, 1)
    table_.add(b"k" * 8 + b"other" + b"." * 19, b"three", 5, 3, 1)  # the same first slot
    assert len(table_.rows) == 2


def test_exact_empty(empty):
    assert exact_dedup.exact_duplicates(empty).count() == 0


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def lines_expected(rows, min_docs=2):
    last = 2**63 - 1
    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders[ascii_lower(line.strip(BLANKS))].add(last if doc_id is None else doc_id)
    out = Counter()
    for doc_id, text, *_ in rows:
        lines, own = (text or "").split("\n"), last if doc_id is None else doc_id
        kept = []
        for line in lines:
            key = ascii_lower(line.strip(BLANKS))
            if len(key) < 10 or len(holders[key]) < min_docs or min(holders[key]) == own:
                kept.append(line)
        out[doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


@pytest.mark.parametrize("min_docs", [2, 3])
def test_lines(awkward, awkward_rows, min_docs):
    done = line_dedup.dedup_lines(awkward, min_docs=min_docs)
    assert set(done.columns) == set(awkward.columns) | {"n_dropped"}
    rows = done.select("doc_id", "n_lines", "n_dropped", "text", "name").collect()
    assert Counter(tuple(r)[:4] for r in rows) == lines_expected(awkward_rows, min_docs)
    assert {r.name for r in rows} <= {"own", None}


def test_lines_empty(empty):
    assert line_dedup.dedup_lines(empty).count() == 0


def test_lines_native(awkward):
    plan = line_dedup.dedup_lines(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def near_expected(rows, n=5, similarity=0.8):
    texts = defaultdict(list)
    for doc_id, text, *_ in rows:
        texts[tuple(w for w in (text or "").replace("\x0b", " ").split())].append(doc_id)
    keys = list(texts)
    sets = [{k[i : i + n] for i in range(max(1, len(k) - n + 1))} if k else set() for k in keys]
    parent = list(range(len(keys)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    links = Counter()
    for a in range(len(keys)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and shared >= similarity * (len(sets[a] | sets[b])) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    classes = defaultdict(list)
    for k, key in enumerate(keys):
        classes[find(k)] += [i for i in texts[key] if i is not None]
    out = Counter()
    for k, key in enumerate(keys):
        for doc_id in texts[key]:
            out[doc_id, min(classes[find(k)], default=None), links[k], len(texts[key])] += 1
    return out


def near_rows(count=60, edits=12, seed=3):
    rng = random.Random(seed)
    base = words(rng, 200, 5000).split()
    rows, k = [], 100
    for _ in range(count):
        own = list(base)
        for _ in range(rng.randrange(edits)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(own), "en", "a"))
        k += 1
    rows += [(k + i, words(rng, 100, 10**6), "en", "b") for i in range(40)]
    return rows + rows[:7]


@pytest.mark.parametrize("block", [near.BLOCK_TEXTS, 8])
def test_near(spark, awkward_rows, block):
    rows = [*awkward_rows, *near_rows()]
    found = near.near_classes(table(spark, rows), recall=0.999999, hashes=400, block_texts=block)
    got = Counter((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in found.collect())
    assert got == near_expected(rows)


def test_bands_reach_the_recall():
    bands, rows = near.choose_bands(0.8, 0.999, 160)
    assert bands * rows <= 160 and 1 - (1 - 0.8**rows) ** bands >= 0.999
    with pytest.raises(ValueError):
        near.choose_bands(0.8, 0.999, 3)


def test_keep_one(spark, awkward, awkward_rows):
    kept = near.keep_one(awkward)
    assert kept.columns == awkward.columns
    firsts = {c for _, c, *_ in near_expected(awkward_rows)}
    assert {r.doc_id for r in kept.collect()} == firsts


def test_near_empty(empty):
    assert near.near_classes(empty).count() == 0
    assert near.keep_one(empty).count() == 0


def test_suffix_array():
    rng = np.random.default_rng(2)
    for n in [*range(20), 100, 301, 1000]:
        for letters in (1, 2, 30):
            text = rng.integers(1, letters + 1, n)
            expected = sorted(range(n), key=lambda i: tuple(text[i:]))
            assert suffix_array(text).tolist() == expected


def spans_expected(rows, length):
    count = Counter()
    texts = [(doc_id, (text or "").encode()) for doc_id, text, *_ in rows]
    for _, text in texts:
        count.update(text[i : i + length] for i in range(len(text) - length + 1))
    out = Counter()
    for doc_id, text in texts:
        gone = np.zeros(len(text) + 1, bool)
        for i in range(len(text) - length + 1):
            if count[text[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(int)))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out[doc_id, len(text), kept, tuple(zip(edges[::2].tolist(), edges[1::2].tolist()))] += 1
    return out


def suffix_rows(seed=4):
    rng = random.Random(seed)
    passage = words(rng, 40)
    rows = [(k, words(rng, 30) + passage[k % 7 :] + words(rng, 30), "en", "a") for k in range(40)]
    rows += [(50 + k, passage[: 30 + 2 * k] + words(rng, 5), "en", "a") for k in range(40)]
    rows += [(100, "ab" * 400, "en", "a"), (101, "abc" * 9 + "ab" * 30, "en", "a")]
    return rows


@pytest.mark.parametrize("length,task_bytes", [(64, suffix_dedup.TASK_BYTES), (64, 600), (400, 10**6)])
def test_repeated_strings(spark, awkward_rows, length, task_bytes):
    rows = [*awkward_rows, *suffix_rows()]
    done = suffix_dedup.remove_repeats(table(spark, rows), length, task_bytes=task_bytes)
    got = Counter(
        (r.doc_id, r.n_bytes, bytes(r.kept), tuple((s.a, s.b) for s in r.spans))
        for r in done.collect()
    )
    assert got == spans_expected(rows, length)
    sums = done.selectExpr("sum(n_removed) r", "sum(n_bytes - length(kept)) k").first()
    assert sums.r == sums.k


def test_repeated_strings_empty(empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0
