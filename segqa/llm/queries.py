"""Queries of the corpus operators over the test tables, and their SQL equivalents."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, exact_dedup, langid, line_dedup, mixing, near, ngram_model, packing, periodic, quality, suffix_dedup, tokenfile, wrappers
from .common import documents

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _remainder(divisor: int):
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(documents(spark, sf_dir), TOKENIZER)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_classes(documents(spark, sf_dir))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = tokenfile.token_folder(spark)
    manifest = tokenfile.write_token_files(documents(spark, sf_dir), folder, TOKENIZER)
    return tokenfile.read_token_files(manifest, folder)


def op4_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = ngram_model.train(docs.filter(_remainder(10) != 0))
    return ngram_model.score(docs, model).select(
        "doc_id", (_remainder(10) == 0).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score",
    )


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_removed") > 0).alias("has_repeats"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(documents(spark, sf_dir))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op7_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mixing_plan(documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality.quality_ledger(documents(spark, sf_dir))
    return quality.apply_policy(ledger).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failures", "n_lines", "n_letters",
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    trees = langid.train(docs.filter(_remainder(4) != 2))
    return langid.identify(docs.select("doc_id", "text"), trees).select(
        "doc_id", (_remainder(4) == 2).alias("held_out"), "lang_pred", "score"
    )


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = wrappers.extract_main(pages)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def _planted(batch, sizes):
    """Where a text starts to repeat and with which period, by the hash of its id; see op12."""
    ids = batch.column("doc_id").to_pylist()
    h = np.array([1 if i is None else zlib.crc32(str(i).encode()) for i in ids], np.int64)
    g, n = h // 10, np.maximum(sizes, 1)
    first = g % n
    return first, np.where((h % 10 == 0) & (sizes > 0), 1 + (n - first) // (3 + g % 8), 0)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = periodic.periodic_runs(docs, repeat=_planted)
    # the greatest length / period as an exact fraction; of equal ones the first
    best = F.expr(
        "aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), (b, r) -> "
        "if(b is null or r.length * b.period > b.length * r.period, r, b))"
    )
    listed = F.expr(
        "concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))"
    )
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length",
        "best.period", F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


QUERIES = {
    name: value
    for name, value in list(globals().items())
    if name.startswith("op") and name[2].isdigit()
}

_B = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES = {
    "op6_line_dedup": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
split AS (SELECT doc_id, string_split(t, chr(10)) AS ls FROM d),
lines AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split),
keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, {_B}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
hits AS (
  SELECT k, min(doc_id) AS keep FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT l.*, h.k IS NOT NULL AND l.doc_id <> h.keep AS gone
  FROM keyed l LEFT JOIN hits h ON l.k = h.k)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
    AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op13_phrase_collocations": r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (
  SELECT lang, row_number() OVER () AS id,
    list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM d),
starts AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM p),
grams AS (
  SELECT lang, array_to_string(ws[i:i + s - 1], ' ') AS phrase, s AS size
  FROM starts, range(1, 6) t(s) WHERE i + s - 1 <= len(ws)),
f AS (SELECT lang, phrase, size, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= 100),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM p GROUP BY lang),
gone AS (
  SELECT lang, array_to_string(w[a:a + s - 1], ' ') AS phrase, max(n) AS most
  FROM (SELECT lang, string_split(phrase, ' ') AS w, size, n FROM f), range(2, 5) t(s),
    range(1, 5) u(a) WHERE s < size AND a + s - 1 <= size GROUP BY ALL),
kept AS (
  SELECT f.* FROM f LEFT JOIN gone g ON f.lang = g.lang AND f.phrase = g.phrase
  WHERE f.size > 1 AND (g.most IS NULL OR g.most < f.n)),
cuts AS (
  SELECT lang, phrase, n AS a, k, array_to_string(w[1:k], ' ') AS head,
    array_to_string(w[k + 1:], ' ') AS tail
  FROM (SELECT *, string_split(phrase, ' ') AS w FROM kept), range(1, 5) t(k) WHERE k < size),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.n AS l, y.n AS r, t.n, c.k,
    (1000::HUGEINT * c.a * t.n // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.head
  JOIN f y ON y.lang = c.lang AND y.phrase = c.tail JOIN totals t ON t.lang = c.lang),
best AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best)
SELECT lang, rank::BIGINT AS rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
    "op9_exact_dedup": f"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    translate(coalesce(text, ''), {_B}, '') AS t FROM documents),
ranked AS (
  SELECT doc_id, t, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS g
  FROM d WINDOW w AS (PARTITION BY t ORDER BY n DESC, doc_id))
SELECT doc_id, keep_id, g::BIGINT AS group_size, doc_id = keep_id AS kept,
  sha256(t) AS text_sha256
FROM ranked""",
    "op8_quality_rules": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
lists AS (
  SELECT doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
words AS (SELECT doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM lists),
windows AS (
  SELECT *, lead(a) OVER p AS b, lead(a, 2) OVER p AS c FROM words
  WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
twice AS (
  SELECT doc_id, i, c IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, a, b, c) > 1 AS f
  FROM windows),
covered AS (
  SELECT doc_id, f OR coalesce(lag(f) OVER p, false) OR coalesce(lag(f, 2) OVER p, false) AS r
  FROM twice WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
repeats AS (SELECT doc_id, count(*) FILTER (WHERE r) AS n FROM covered GROUP BY doc_id),
measured AS (
  SELECT l.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(array_to_string(ws, ''), '[^\p{L}]+', '', 'g'))::BIGINT AS n_letters,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM lists l LEFT JOIN repeats r ON l.doc_id = r.doc_id),
ledger AS (
  SELECT *, ((n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
    + 4 * (10 * n_symbols > 3 * n_words)::BIGINT + 8 * (10 * n_dup_lines > 5 * n_lines)::BIGINT
    + 16 * (word_chars < 2 * n_words)::BIGINT + 32 * (word_chars > 20 * n_words)::BIGINT
    + 64 * (10 * n_letters < 5 * word_chars)::BIGINT) AS failures
  FROM measured)
SELECT *, failures & 3 <> 0 AS base_failed, failures = 0 AS kept FROM ledger""",
}
