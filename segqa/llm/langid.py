"""Language identification by prediction by partial matching.

Each language has a context tree over bytes: how often each byte followed each context of up to three
bytes. A byte costs its probability in the longest context that the language knows, or an escape and
the same question one byte shorter, down to uniform bytes. The statistics are frozen after training,
so a text's code length under a language is exact, and the language with the shortest code wins.

Frozen trees of all languages become one automaton: each context known to any of them is a state
holding the cost of every next byte in every language. Texts are scored by two table look-ups a byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import slices

ORDER = 3
SAMPLE_DOCS = 1000  # per language, about; bounds what training reads and the driver gathers
UNKNOWN = "und"
_BLOCK = 512  # contexts frozen together
_PART = 1 << 18  # bytes scored together
_START = np.frombuffer(b" " * ORDER, np.uint8)


class Trees(NamedTuple):
    languages: list[str]
    classes: np.ndarray  # 256: byte -> class; 0 stands for bytes never seen in training
    states: np.ndarray  # classes ** 3: last three classes -> state
    bits: np.ndarray  # states x classes x languages: code length in bits


def _with_start(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each behind the start context, and where each begins."""
    parts = [part for text in texts for part in (_START, np.frombuffer(text, np.uint8))]
    sizes = np.array([len(text) + ORDER for text in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    return np.concatenate(parts) if parts else np.empty(0, np.uint8), begins


def training_sample(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``(lang, text)``: about ``sample_docs`` whole documents of every language.

    A language's documents are taken by a hash of their id below a threshold that its count sets, so
    the choice needs no sort, is the same in every run and crowds no task.
    """
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # stored, so that its size is known and the texts stay where they are while it is small
    counts = materialize(
        labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("_n")), "language-counts"
    )
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_003)) / 1_000_003.0
    return (
        labelled.select("lang", "text", place.alias("_place"))
        .join(counts, "lang")
        .filter(F.col("_place") * F.col("_n") <= sample_docs)
        .select("lang", "text")
    )


def context_counts(sample: DataFrame) -> DataFrame:
    """``(lang, gram, n)``: how often each byte followed three bytes; ``gram`` holds the four."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            names = np.array(batch.column("lang").to_pylist(), object)
            texts = np.array([t.encode() for t in batch.column("text").to_pylist()], object)
            for lang in dict.fromkeys(names):
                data, begins = _with_start(list(texts[names == lang]))
                if len(data) <= ORDER:
                    continue
                gram = _grams(data)
                gram = gram[~_crossing(begins, len(data))]
                values, n = np.unique(gram, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(values), pa.string()),
                        pa.array(values.astype(np.int64)),
                        pa.array(n.astype(np.int64)),
                    ],
                    ["lang", "gram", "n"],
                )

    return (
        sample.mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )


def _grams(data: np.ndarray) -> np.ndarray:
    wide = data.astype(np.uint32)
    return wide[:-3] << 24 | wide[1:-2] << 16 | wide[2:-1] << 8 | wide[3:]


def _crossing(begins: np.ndarray, size: int) -> np.ndarray:
    """Grams whose last byte is a start byte: they would join two texts."""
    ends_in_start = np.zeros(size, bool)
    for k in range(ORDER):
        ends_in_start[begins[:-1] + k] = True
    return ends_in_start[ORDER:]


def build_trees(languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Trees:
    """Freeze the counts: ``lang`` indexes ``languages``, ``gram`` and ``n`` as counted."""
    gram = gram.astype(np.int64)
    seen = np.unique(np.concatenate([gram >> s & 255 for s in (0, 8, 16, 24)]))
    classes = np.zeros(256, np.int64)
    classes[seen] = np.arange(1, len(seen) + 1)
    size, count = len(seen) + 1, len(languages)
    path = [classes[gram >> s & 255] for s in (0, 8, 16, 24)]  # next byte, then backwards
    # contexts of each order as numbers whose lowest digits are the nearest bytes
    contexts = [
        sum((path[k + 1] * size**k for k in range(order)), np.zeros_like(gram))
        for order in range(ORDER + 1)
    ]
    known = [np.unique(context) for context in contexts]
    firsts = np.concatenate([[0], np.cumsum([len(k) for k in known])])
    states = np.zeros(size**ORDER, np.int32)
    bits = np.empty((firsts[-1], size, count), np.float32)
    for order in range(ORDER + 1):
        at = np.argsort(contexts[order], kind="stable")
        ranked = contexts[order][at]
        for begin in range(0, len(known[order]), _BLOCK):
            own = known[order][begin : begin + _BLOCK]
            rows = at[np.searchsorted(ranked, own[0]) : np.searchsorted(ranked, own[-1], "right")]
            counts = np.zeros((len(own), size, count))
            place = np.searchsorted(own, contexts[order][rows])
            np.add.at(counts, (place, path[0][rows], lang[rows]), n[rows])
            if order == 0:
                below = np.full_like(counts, 1 / 256)  # uniform bytes
            else:
                shorter = np.searchsorted(known[order - 1], own % size ** (order - 1))
                below = np.exp2(-bits[firsts[order - 1] + shorter].astype(np.float64))
            total = counts.sum(axis=1, keepdims=True)
            kinds = (counts > 0).sum(axis=1, keepdims=True)
            safe = np.maximum(total + kinds, 1)
            here = np.where(counts > 0, counts / safe, below * kinds / safe)
            # a language without the context stays below
            first = firsts[order] + begin
            bits[first : first + len(own)] = -np.log2(np.where(total > 0, here, below))
        width = size**order
        for k in range(0, size**ORDER, width):
            block = states[k : k + width]
            block[known[order]] = firsts[order] + np.arange(len(known[order]))
    return Trees(languages, classes.astype(np.int64), states, bits)


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Trees:
    """Trees of all languages in ``docs`` (``doc_id, text, lang``), from a bounded sample.

    The driver gathers counts of distinct four-byte strings: bounded by the sample, not the corpus.
    Without any labelled text there are no languages.
    """
    counts = context_counts(training_sample(docs, sample_docs)).toArrow().combine_chunks()
    if not counts.num_rows:
        return Trees([], np.zeros(256, np.int64), np.zeros(1, np.int32), np.zeros((1, 1, 0)))
    names = sorted(set(counts.column("lang").to_pylist()))
    index = {name: k for k, name in enumerate(names)}
    lang = np.array([index[name] for name in counts.column("lang").to_pylist()])
    gram, n = counts.column("gram").to_numpy(), counts.column("n").to_numpy()
    order = np.lexsort((gram, lang))
    return build_trees(names, lang[order], gram[order], n[order])


def code_lengths(trees: Trees, texts: list[bytes]) -> np.ndarray:
    """Bits of every text (row) under every language (column); a long text is taken in parts."""
    data, begins = _with_start(texts)
    size = int(round(len(trees.states) ** (1 / ORDER)))
    bits = np.zeros((len(texts), len(trees.languages)))
    real = begins[:-1] + ORDER  # first byte of each text
    for begin in range(0, len(data) - ORDER, _PART):
        end = min(begin + _PART, len(data) - ORDER)
        cls = trees.classes[data[begin : end + ORDER]]
        context = (cls[:-3] * size + cls[1:-2]) * size + cls[2:-1]
        cost = trees.bits[trees.states[context], cls[ORDER:]].astype(np.float64)
        # costs stand three places before their bytes; start bytes cost nothing
        at = np.arange(begin + ORDER, end + ORDER)
        owner = np.searchsorted(begins, at, side="right") - 1
        cost[at < real[owner]] = 0
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        bits[owner[first]] += np.add.reduceat(cost, first, axis=0)
    return bits


def identify(docs: DataFrame, trees: Trees) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``.

    ``score`` is the probability of the language given the code lengths of all. A null text, or one
    without any letter, or any text when no language was learned, is ``und`` with score 0. Only the
    text decides; existing columns ``lang_pred`` and ``score`` are replaced, all others are kept.
    Each text is read whole; ties go to the language first in code point order.
    """
    # bounded by the training sample; plain arrays, as tasks need not know this package
    shared = docs.sparkSession.sparkContext.broadcast(tuple(trees))
    docs = docs.drop("lang_pred", "score")
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    schema = T.StructType([*docs.schema.fields, *added])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = Trees(*shared.value)
        for batch in slices(batches, "text", 1 << 20):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            lettered = [k for k, t in enumerate(texts) if any(map(str.isalpha, t))]
            if lettered and trees.languages:
                bits = code_lengths(trees, [texts[k].encode() for k in lettered])
                best = bits.argmin(axis=1)
                excess = bits - bits.min(axis=1, keepdims=True)
                chance = 1 / np.exp2(-np.minimum(excess, 1000)).sum(axis=1)
                for k, b, p in zip(lettered, best, chance):
                    names[k], scores[k] = trees.languages[b], p
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores)],
                names=[*batch.schema.names, "lang_pred", "score"],
            )

    return docs.mapInArrow(predict, schema)
