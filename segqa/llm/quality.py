"""Quality rules as a ledger of bits, with DataFrame functions only.

Every rule is measured and judged once per document; its verdict is one bit of ``failures``. Policies
are versioned masks over the bits: applying another version, or asking what each rule costs, reads
the ledger and never the texts again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, clear_text

SYMBOLS = "[#*$%&|<>]"

# Bit of each rule, by position; new rules are appended so that stored ledgers stay valid.
RULES: dict[str, Column | Callable[[], Column]] = {
    "few_words": lambda: F.col("n_words") < 50,
    "repeated_words": lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
    "many_symbols": lambda: 10 * F.col("n_symbols") > 3 * F.col("n_words"),
    "repeated_lines": lambda: 10 * F.col("n_dup_lines") > 5 * F.col("n_lines"),
    "short_words": lambda: F.col("word_chars") < 2 * F.col("n_words"),
    "long_words": lambda: F.col("word_chars") > 20 * F.col("n_words"),
    "few_letters": lambda: 10 * F.col("n_letters") < 5 * F.col("word_chars"),
}


def mask_of(*names: str) -> int:
    order = list(RULES)
    return sum(1 << order.index(name) for name in names)


# What each version of the policy rejects.
POLICIES = {
    1: mask_of("few_words", "repeated_words"),
    2: mask_of(*RULES),
}
BASE = POLICIES[1]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is referred to."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words in a window of three that occurs at least twice; equal windows meet in a sort."""

    def covered(places: Column) -> Column:
        steps = F.transform(
            places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3)))
        )
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    def places(ranked: Column) -> Column:
        def equal(e: Column, k: Column) -> Column:
            return F.coalesce(F.get(ranked, k) ["h"] == e["h"], F.lit(False))

        twice = F.filter(ranked, lambda e, k: equal(e, k - 1) | equal(e, k + 1))
        return _let(F.sort_array(F.transform(twice, lambda e: e["i"])), covered)

    def count(hashes: Column) -> Column:
        ranked = F.sort_array(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        return F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes), _let(ranked, places)
        ).otherwise(F.lit(0))

    windows = F.transform(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )
    return _let(windows, count)


def quality_ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the measurements (long) and ``failures`` (long, a bit per rule).

    Measurements: ``n_words, word_chars, n_letters, n_symbols, n_lines`` (lines with a word),
    ``n_dup_lines, n_repeat_words``. A null or empty text has no words and fails ``few_words``.
    Every row is judged by itself: repeated rows get equal verdicts, columns of ``docs`` with the
    names of measurements are replaced and all others are kept. Works row by row without a shuffle.
    """
    text = clear_text(text_col)
    words = F.filter(F.split(text, BLANKS + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))

    def of_words(ws: Column) -> Column:
        joined = F.array_join(ws, "")
        return F.struct(
            F.size(ws).alias("n_words"),
            F.length(joined).alias("word_chars"),
            F.regexp_count(joined, F.lit(SYMBOLS)).alias("n_symbols"),
            F.length(F.regexp_replace(joined, "[^\\p{L}]+", "")).alias("n_letters"),
            _repeat_words(ws).alias("n_repeat_words"),
        )

    def of_lines(ls: Column) -> Column:
        return F.struct(
            F.size(ls).alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).alias("n_dup_lines"),
        )

    measured = docs.withColumns(
        {"__segqa_w": _let(words, of_words), "__segqa_l": _let(lines, of_lines)}
    )
    names = ["n_words", "word_chars", "n_symbols", "n_letters", "n_repeat_words"]
    measured = measured.withColumns(
        {n: F.col(f"__segqa_w.{n}").cast("long") for n in names}
        | {n: F.col(f"__segqa_l.{n}").cast("long") for n in ("n_lines", "n_dup_lines")}
    ).drop("__segqa_w", "__segqa_l")
    bits = F.lit(0).cast("long")
    for bit, rule in enumerate(RULES.values()):
        bits = bits.bitwiseOR(F.when(rule(), F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("failures", bits)


def apply_policy(ledger: DataFrame, version: int = max(POLICIES)) -> DataFrame:
    """``ledger`` with ``base_failed`` and ``kept`` under one version of the policy."""
    failures = F.col("failures")
    base = failures.bitwiseAND(F.lit(BASE)) != 0
    kept = failures.bitwiseAND(F.lit(POLICIES[version] | BASE)) == 0
    return ledger.withColumns({"base_failed": base, "kept": kept})


def ablations(ledger: DataFrame) -> DataFrame:
    """Per policy version and rule: documents it rejects, rejects alone, and that the version keeps.

    One aggregation of bit counts over the ledger; an empty ledger gives zeros.
    """
    failures, sums, keys = F.col("failures"), [], []
    for version, mask in POLICIES.items():
        hit = failures.bitwiseAND(F.lit(mask))
        sums.append(F.count_if(hit == 0).alias(f"kept_{version}"))
        for bit, name in enumerate(RULES):
            if mask >> bit & 1:
                own = F.lit(1 << bit)
                sums.append(F.count_if(hit.bitwiseAND(own) != 0).alias(f"all_{version}_{bit}"))
                sums.append(F.count_if(hit == own).alias(f"only_{version}_{bit}"))
                keys.append((version, bit, name))
    rows = F.array(
        *[
            F.struct(
                F.lit(v).alias("version"),
                F.lit(name).alias("rule"),
                F.col(f"all_{v}_{b}").alias("rejected"),
                F.col(f"only_{v}_{b}").alias("rejected_alone"),
                F.col(f"kept_{v}").alias("kept"),
            )
            for v, b, name in keys
        ]
    )
    return ledger.agg(*sums).select(F.inline(rows))
