import random
import re
from collections import Counter

import pytest

from segqa.llm import mixing, quality

from .conftest import table

WORD = re.compile("[^\x20\x09-\x0d]+")


def measured(text):
    ws = WORD.findall(text or "")
    windows = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    covered = set()
    for i in range(len(ws) - 2):
        if windows[tuple(ws[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines), len(lines) - len(set(lines)), len(covered),
    )


EXTRA = [
    (200, "a b c a b c a b c", "en", "a"),
    (201, "a a a a a " * 30, "en", "a"),
    (202, "# $ % word " * 60, "en", "a"),
    (203, "one\n\n \none\nOne\none two", "en", "a"),
]


def test_measurements(spark, awkward_rows):
    rows = [*awkward_rows, *EXTRA]
    ledger = quality.apply_policy(quality.quality_ledger(table(spark, rows)))
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
    found = ledger.select("doc_id", *names, "base_failed", "kept", "name").collect()
    expected = Counter()
    for doc_id, text, *_ in rows:
        m = measured(text)
        expected[(doc_id, *m, m[0] < 50 or 100 * m[5] > 50 * m[0])] += 1
    assert Counter(tuple(r)[:-2] for r in found) == expected
    assert not any(r.kept and r.base_failed for r in found)


def test_policies_and_ablations_read_the_ledger(spark, awkward_rows):
    ledger = quality.quality_ledger(table(spark, [*awkward_rows, *EXTRA]))
    rows = ledger.select("failures").collect()
    for version, mask in quality.POLICIES.items():
        kept = quality.apply_policy(ledger, version).filter("kept").count()
        assert kept == sum(r.failures & (mask | quality.BASE) == 0 for r in rows)
    for r in quality.ablations(ledger).collect():
        mask, own = quality.POLICIES[r.version], 1 << list(quality.RULES).index(r.rule)
        hits = [row.failures & mask for row in rows]
        assert r.rejected == sum(h & own != 0 for h in hits)
        assert r.rejected_alone == hits.count(own)
        assert r.kept == hits.count(0)


def test_quality_native_without_shuffle(awkward):
    plan = quality.quality_ledger(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange hash" not in plan


def test_quality_empty(empty):
    assert quality.quality_ledger(empty).count() == 0
    assert all(r.rejected == 0 for r in quality.ablations(quality.quality_ledger(empty)).collect())


def targets(sizes, weights, share, passes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    rest, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if rest * weight[s] / total > passes * sizes[s]]
        if not full:
            return out | {s: rest * weight[s] / total for s in open_}
        out |= {s: passes * sizes[s] for s in full}
        rest -= sum(out[s] for s in full)
        open_ -= set(full)
    return out


def mix_rows(seed=8):
    import random

    rng = random.Random(seed)
    rows = []
    for k in range(3000):
        source = "hot" if k % 3 == 0 else rng.choice(["a", "b", "é", "Z", None])
        rows.append((k, " ".join("w" * rng.randrange(1, 60)), "en", source))
    return rows


@pytest.mark.parametrize("bucket_rows", [mixing.BUCKET_ROWS, 50, 5])
def test_mix(spark, bucket_rows):
    rows = mix_rows()
    docs = table(spark, rows)
    plan = mixing.mixing_plan(docs, bucket_rows=bucket_rows).collect()
    sizes, source = Counter(), {}
    for doc_id, text, _, name in rows:
        sizes[name] += len(WORD.findall(text))
        source[doc_id] = name
    expected = targets(dict(sizes), mixing.WEIGHTS, 1.5, 2)
    taken = Counter()
    for r in plan:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(expected[source[r.doc_id]])
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[source[r.doc_id]] += r.taken
    assert len(plan) == len(rows)
    budget = 1.5 * sum(sizes.values())
    assert budget - 60 <= sum(taken.values()) <= budget
    for name, target in expected.items():
        assert abs(taken[name] - target) <= 60
    again = mixing.mixing_plan(docs.repartition(7)).collect()
    assert {(r.doc_id, r.copies) for r in again} == {(r.doc_id, r.copies) for r in plan}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    counts = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert counts == Counter({r.doc_id: r.copies for r in plan if r.copies})


def test_mix_awkward(awkward, awkward_rows):
    plan = mixing.mixing_plan(awkward).collect()
    assert Counter((r.doc_id, r.size) for r in plan) == Counter(
        (i, len(WORD.findall(t or ""))) for i, t, *_ in awkward_rows
    )
    assert set(mixing.mixed_documents(awkward).columns) == set(awkward.columns)
    assert mixing.mixed_documents(awkward).count() > 0


def test_mix_empty(empty):
    assert mixing.mixing_plan(empty).count() == 0
    assert mixing.mixed_documents(empty).count() == 0


def test_mix_deals_copies_of_equal_rows_exactly(spark):
    rng = random.Random(12)
    rows = []
    for source in "abcdef":
        for k in range(6):
            text = " ".join(rng.choices("xyz", k=rng.randrange(1, 9)))
            rows += [(ord(source) * 100 + k, text, "en", source)] * rng.choice([1, 2, 3, 7])
    docs = table(spark, rows)
    uneven = 0
    for share in (0.6, 1.1, 1.5):
        planned = Counter()
        for r in mixing.mixing_plan(docs, share=share).collect():
            planned[r.doc_id] += r.copies
        mixed = mixing.mixed_documents(docs, share=share)
        assert mixed.columns == docs.columns
        counts = Counter(r.doc_id for r in mixed.collect())
        assert counts == +planned
        uneven += sum(n % sum(1 for r in rows if r[0] == i) > 0 for i, n in planned.items())
    assert uneven
