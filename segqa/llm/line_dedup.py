"""Line deduplication with DataFrame functions only.

Lines are exploded to the hash of their key, documents are counted per hash, and each document's
lines that go are flagged in the order of the lines; the text itself moves once, to meet the flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KEY, clear_text, row_key, same_row

_BLANKS = " \t\n\u000b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LAST = 2**63 - 1
_GONE = "__segqa_gone"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else unchanged."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def line_key(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANKS))


def repeated_lines(lines: DataFrame, min_docs: int = 2) -> DataFrame:
    """``(k1, k2, keep)`` of keys in at least ``min_docs`` documents; ``keep`` is the smallest id.

    Documents of a key are counted in two steps, both combined before their shuffle, so that a line
    of every document crowds no task.
    """
    once = lines.select("k1", "k2", "_doc").distinct()
    counted = once.groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("n_docs"), F.min("_doc").alias("keep")
    )
    return counted.filter(F.col("n_docs") >= min_docs).select("k1", "k2", "keep")


def dedup_lines(
    docs: DataFrame, min_chars: int = 10, min_docs: int = 2, text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``text`` rid of repeated lines, and ``n_lines, n_dropped`` (long).

    A key of at least ``min_chars`` code points that occurs in ``min_docs`` documents keeps its lines
    in the smallest ``doc_id`` that holds it and loses all others. A null or empty text is one empty
    line and becomes an empty text. A null ``doc_id`` counts as one document, after all others; rows
    that repeat a ``doc_id`` count as one document. Columns of ``docs`` called ``n_lines`` or
    ``n_dropped`` are replaced, all others are kept.
    """
    text = clear_text(text_col)
    doc = F.coalesce(F.col("doc_id"), F.lit(_LAST))
    key = ascii_lower(line_key(F.col("line")))
    lines = (
        docs.select(
            *(c.alias(n) for n, c in row_key("doc_id", text).items()),
            doc.alias("_doc"),
            F.posexplode(F.split(text, "\n")),
        )
        .withColumnRenamed("col", "line")
        .withColumn("key", key)
        .filter(F.length("key") >= min_chars)
        .select(
            *KEY, "_doc", "pos",
            F.xxhash64("key").alias("k1"), F.xxhash64(F.lit("2"), "key").alias("k2"),
        )
    )
    gone = (
        lines.join(repeated_lines(lines, min_docs), ["k1", "k2"])
        .filter(F.col("_doc") != F.col("keep"))
        .groupBy(*KEY)
        .agg(F.sort_array(F.collect_set("pos")).alias(_GONE))
    )
    keyed = docs.drop("n_lines", "n_dropped").withColumns(row_key("doc_id", text))
    joined = keyed.join(gone, same_row(keyed, gone), "left").select(keyed["*"], gone[_GONE])
    return _without(joined, text, text_col).drop(*KEY, _GONE)


def _without(df: DataFrame, text: Column, text_col: str) -> DataFrame:
    """Drop the lines whose positions stand in the sorted column ``_GONE``.

    The kept runs lie between the positions that go; each is one slice, so that the work follows the
    number of lines even where most of a long document goes.
    """
    lines = F.split(text, "\n")
    bounds = F.concat(F.array(F.lit(-1)), F.col(_GONE), F.array(F.size(lines)))

    def run(lines_: Column, bounds_: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(0), F.size(bounds_) - 2),
            lambda i: F.slice(
                lines_, F.get(bounds_, i) + 2, F.get(bounds_, i + 1) - F.get(bounds_, i) - 1
            ),
        )
        return F.array_join(F.flatten(pairs), "\n")

    # bound to lambda variables, so that neither is evaluated again for each run
    kept = F.get(
        F.transform(
            F.array(lines),
            lambda ls: F.get(F.transform(F.array(bounds), lambda bs: run(ls, bs)), F.lit(0)),
        ),
        F.lit(0),
    )
    return df.withColumns(
        {
            text_col: F.when(F.col(_GONE).isNull(), text).otherwise(kept),
            "n_lines": F.size(lines).cast("long"),
            "n_dropped": F.coalesce(F.size(_GONE), F.lit(0)).cast("long"),
        }
    )
