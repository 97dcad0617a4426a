"""Phrases that recur more than their parts suggest, counted in a weighted de Bruijn graph.

Texts are cut into pieces at marks and pieces into words. From every word an edge starts: the phrase
of five words there, or, as a correction at the end of a piece, the shorter one that is left. Edges
are added up over the corpus. A node is an edge without its last word; its count is the flow through
it, the sum of all edges that start with it, so the counts of all shorter phrases follow from the
edges alone, one word less at a time. A node whose whole flow goes into one longer phrase lies on a
unary path and is compacted into that phrase.

Edges stop early where no phrase can reach ``least``: all words and pairs of neighbours are first
counted in hashed cells, and a word or pair whose cell stays below ``least`` is in no such phrase. The
cells become one bit each in sharded files that tasks map. Too few cells only weaken that filter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .common import shuffle_tasks, slices, worker_store
from .ngram_model import _BLOB, _map, _mixed, _save, _ship, _unpack_counts, word_hashes

WORDS = 5  # of the longest phrase
LEAST, TOP = 100, 2000
CELL_BYTES, MOST_CELLS = 24, 1 << 33  # bytes of text per cell; cells at most
SHARD_CELLS = 1 << 21  # 256 KB of bits
BATCH_BYTES = 4 << 20
FLUSH_ENTRIES = 1_500_000
UNKNOWN = "und"
_PARTS = 64

_KIND = np.zeros(256, np.uint8)  # of a byte: 0 in a word, 1 blank, 2 end of a piece
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def pieces_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, every word's index among them, and the number of its piece in the batch."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    _, bounds, values = texts.buffers()
    offsets = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    size = int(offsets[-1] - offsets[0])
    if not size:
        return pa.array([], pa.large_string()), np.empty(0, np.int64), np.empty(0, np.int64)
    data = np.frombuffer(values, np.uint8)[offsets[0] : offsets[-1]]
    kind = _KIND[data]
    inside = kind == 0
    heads = np.zeros(size + 1, bool)  # texts begin here; words end there too
    heads[offsets[:-1] - offsets[0]] = True
    begin = inside & heads[:-1]
    begin[0] |= inside[0]
    begin[1:] |= inside[1:] & ~inside[:-1]
    begins = np.flatnonzero(begin)
    piece = np.cumsum((kind == 2).astype(np.int32) + heads[:-1])
    # words without what lies between them, end to end
    before = np.cumsum(inside) - inside
    edges = np.append(before[begins], np.count_nonzero(inside)).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_string(),
        len(begins),
        [None, pa.py_buffer(edges), pa.py_buffer(_LOWER[data[inside]])],
    )
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), piece[begins]


def _slices_by_lang(batches: Iterator[pa.RecordBatch]):
    """``(lang, texts)`` of about ``BATCH_BYTES`` each."""
    for batch in slices(batches, "text", BATCH_BYTES):
        lang = batch.column("lang").dictionary_encode()
        codes = lang.indices.to_numpy()
        for code, name in enumerate(lang.dictionary.to_pylist()):
            yield name, batch.column("text").take(pa.array(np.flatnonzero(codes == code)))


def _cells(lang: str, words: pa.Array, index: np.ndarray, piece: np.ndarray, cells: int):
    """Cells of all words, and of all pairs of neighbours with the place of their first words."""
    seed = word_hashes(pa.array([lang]))[0]
    hashes = _mixed(word_hashes(words) ^ seed)
    spread = np.uint64(cells - 1)
    pairs = np.flatnonzero(piece[1:] == piece[:-1])
    both = _mixed(hashes[index[pairs]] * _PAIR + hashes[index[pairs + 1]])
    return (hashes & spread)[index], both & spread, pairs


class _Often:
    """The cells that reach the least count, one bit each."""

    def __init__(self, folder: str, files: dict[int, str]):
        self.folder, self.files, self.open = folder, files, {}

    def __call__(self, cells: np.ndarray) -> np.ndarray:
        out = np.zeros(len(cells), bool)
        shards = (cells // np.uint64(SHARD_CELLS)).astype(np.int64)
        present = np.unique(shards)
        for shard in present.tolist():
            if shard not in self.files:
                continue
            if shard not in self.open:
                self.open[shard] = _map(self.folder, self.files[shard])
            rows = slice(None) if len(present) == 1 else np.flatnonzero(shards == shard)
            at = cells[rows] % np.uint64(SHARD_CELLS)
            word = self.open[shard][(at >> np.uint64(6)).astype(np.int64)]
            out[rows] = (word >> (at & np.uint64(63)) & np.uint64(1)) > 0
        return out


def _count_cells(texts: DataFrame, cells: int, least: int) -> tuple[str, dict[int, str]]:
    """Folder and files, by shard, of the cells that ``least`` words or pairs fall into."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for lang, texts in _slices_by_lang(batches):
            words, index, piece = pieces_of(texts)
            single, double, _ = _cells(lang, words, index, piece, cells)
            parts.append(np.unique(np.concatenate([single, double]), return_counts=True))
            held += len(parts[-1][0])
            if held > FLUSH_ENTRIES:
                yield from ship(parts)
                parts, held = [], 0
        if parts:
            yield from ship(parts)

    def ship(parts):
        return _ship(
            parts,
            lambda keys: (keys // np.uint64(SHARD_CELLS)).astype(np.int64),
            lambda keys, shard: keys % np.uint64(SHARD_CELLS),
        )

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come by shard; only one shard's counts are held
        held, counts = None, np.zeros(SHARD_CELLS, np.int64)
        done = []
        for batch in batches:
            for shard, keys, n in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if held is not None and shard != held:
                    done.append((held, _save_bits(folder, counts >= least)))
                    counts[:] = 0
                held = shard
                cells, own = _unpack_counts(keys, n)
                counts[cells.astype(np.int64)] += own
        if held is not None:
            done.append((held, _save_bits(folder, counts >= least)))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["shard", "file"])

    spark = texts.sparkSession
    folder = scratch_path(spark, "phrase-cells")
    blobs = texts.mapInArrow(count, _BLOB)
    tasks = min(shuffle_tasks(spark), max(1, cells // SHARD_CELLS))
    sorted_ = blobs.repartition(tasks, "shard").sortWithinPartitions("shard")
    manifest = materialize(sorted_.mapInArrow(mark, "shard long, file string"), "phrase-cell-files")
    return folder, {row.shard: row.file for row in manifest.collect()}  # a row per shard


def _save_bits(folder: str, bits: np.ndarray) -> str:
    return _save(folder, np.packbits(bits, bitorder="little").view(np.uint64))


def _edges(codes: list[np.ndarray], words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Distinct rows of ``codes`` (word numbers from 1, 0 behind the last) as phrases, with counts."""
    if len(words) < 1 << 21:  # three numbers to a key, two to another
        wide = [c.astype(np.uint64) for c in codes]
        keys = [
            wide[0] << np.uint64(42) | wide[1] << np.uint64(21) | wide[2],
            wide[3] << np.uint64(21) | wide[4],
        ]
    else:
        keys = codes
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    heads = np.flatnonzero(new)
    own = np.stack([c[order[heads]] for c in codes], 1)
    kept = own > 0
    lists = pa.LargeListArray.from_arrays(
        np.concatenate([[0], np.cumsum(kept.sum(axis=1))]), words.take(pa.array(own[kept] - 1))
    )
    counts = np.diff(np.append(heads, len(order)))
    return pc.binary_join(lists, pa.scalar(" ", pa.large_string())), counts


def count_edges(texts: DataFrame, least: int = LEAST, cells: int | None = None) -> DataFrame:
    """``(lang, phrase, size, n)``: the longest phrase that starts at each word, added up.

    The row of size 0 counts all words. Phrases end after five words, with their piece, and before a word or pair too rare for ``least``.
    Words too rare start none.
    """
    if cells is None:
        total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        cells = min(MOST_CELLS, max(1 << 16, 1 << int(total // CELL_BYTES).bit_length()))
    folder, files = _count_cells(texts, cells, least)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = worker_store().setdefault(folder, _Often(folder, files))
        for lang, texts in _slices_by_lang(batches):
            words, index, piece = pieces_of(texts)
            if not len(index):
                continue
            single, double, pairs = _cells(lang, words, index, piece, cells)
            known = often(single)
            joined = np.zeros(len(index) + WORDS, bool)  # this word and the next
            joined[pairs] = known[pairs] & known[pairs + 1]
            rows = np.flatnonzero(joined[pairs])
            joined[pairs[rows]] = often(double[rows])
            starts = np.flatnonzero(known)
            codes, going = [index[starts] + 1], np.ones(len(starts), bool)
            padded = np.append(index, np.zeros(WORDS, np.int64))
            for k in range(1, WORDS):
                going = going & joined[starts + k - 1]
                codes.append(np.where(going, padded[starts + k] + 1, 0))
            phrase, n = _edges(codes, words) if len(starts) else (pa.array([], pa.large_string()), [])
            size = pc.add(pc.count_substring(phrase, " "), 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (len(n) + 1)),
                    pa.concat_arrays([phrase.cast(pa.string()), pa.array([""])]),
                    pa.concat_arrays([size.cast(pa.int32()), pa.array([0], pa.int32())]),
                    pa.array(np.append(n, len(index)).astype(np.int64)),
                ],
                ["lang", "phrase", "size", "n"],
            )

    found = texts.mapInArrow(cut, "lang string, phrase string, size int, n long")
    return found.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))


def node_flows(edges: DataFrame) -> DataFrame:
    """``(lang, phrase, size, n)`` for the phrases of every length that ``edges`` start with."""
    levels = []
    flow = edges.filter(F.col("size") == WORDS)
    for size in range(WORDS, 0, -1):
        levels.append(flow)
        if size > 1:
            shorter = F.substring_index("phrase", " ", size - 1)
            ending = edges.filter(F.col("size") == size - 1)
            flow = (
                flow.select("lang", shorter.alias("phrase"), F.lit(size - 1).alias("size"), "n")
                .unionByName(ending)
                .groupBy("lang", "phrase", "size")
                .agg(F.sum("n").alias("n"))
            )
            flow = materialize(flow, f"phrase-flow-{size - 1}")
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) in exact whole numbers, up to 10**16 for each count."""
    a, n, left, right = (c.cast("decimal(16,0)") for c in (a, n, left, right))
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * a * n, left * right)


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, cells: int | None = None
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of every language.

    Phrases of two to five words with ``least`` occurrences or more, overlaps included, within pieces
    that end at any of ``.,;:!?`` or a line's end; A-Z are lower-cased. ``score`` is that of the cut
    into two parts that explains the phrase best. A phrase all of whose occurrences lie in a longer
    one gives way to it. Ties go to the more frequent and then to the smaller phrase in byte order.
    A null text has no words, a null language is ``und``; repeated rows count as often as they occur;
    no documents, no phrases. Other columns are ignored.
    """
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    edges = materialize(count_edges(texts, least, cells), "phrase-edges")
    often = materialize(node_flows(edges).filter(F.col("n") >= least), "phrases")
    phrases = often.filter("size > 1")

    # unary paths: the whole flow of a phrase goes on, or comes, in one longer phrase
    longer = often.filter("size > 2")
    head = F.expr("substring_index(phrase, ' ', size - 1)")
    tail = F.expr("substring_index(phrase, ' ', 1 - size)")
    inside = (
        longer.select("lang", F.explode(F.array(head, tail)).alias("phrase"), "n")
        .groupBy("lang", "phrase")
        .agg(F.max("n").alias("most"))
    )
    phrases = phrases.join(inside, ["lang", "phrase"], "left").filter(
        F.col("most").isNull() | (F.col("most") < F.col("n"))
    )

    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1))
    cuts = phrases.select("lang", "phrase", F.col("n").alias("a"), "size", cut.alias("k")).select(
        "lang", "phrase", "a", "k",
        F.expr("substring_index(phrase, ' ', k)").alias("head"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("tail"),
    )
    part = often.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    rest = often.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    totals = edges.filter("size = 0").select("lang", "n")
    scored = (
        cuts.join(part, ["lang", "head"])
        .join(rest, ["lang", "tail"])
        .join(totals, "lang")
        .withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
        .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score")
    )
    best = (F.desc("score"), F.desc("a"), "phrase")
    # the first of every part of a language, then of the language: no task gets all its phrases
    part = F.pmod(F.xxhash64("phrase"), F.lit(_PARTS))
    places = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best))
    few = scored.withColumn("part", part).withColumn("place", places).filter(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")
    return (
        few.withColumn("rank", rank)
        .filter(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
