"""Near-duplicate join on word n-grams: MinHash bands propose, full n-gram sets decide.

Copies of one word sequence are one text and take part once. Texts that agree in a band are linked
into candidate groups; each text's n-gram set then moves once, to where its group is verified. All
pairs of a group are compared in blocks by counting shared n-grams; pairs themselves are never rows.
A group beyond a block is dealt as pairs of blocks, so no task grows with a group, and no partner is
left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import batch_rows, materialize
from .common import TEXT_ROWS, shuffle_tasks, slices
from .components import connected

WORDS, SIMILARITY, RECALL, HASHES = 5, 0.8, 0.999, 160
BLOCK_TEXTS, BLOCK_GRAMS = 512, 1_000_000
FILTER_BITS = 1 << 22


def choose_bands(similarity: float, recall: float, hashes: int) -> tuple[int, int]:
    """Bands and rows that find a pair at ``similarity`` with probability ``recall``.

    The most rows (fewest false candidates) whose bands stay within ``hashes`` hash functions.
    """
    best = None
    for rows in range(1, 33):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows)))
        if bands * rows <= hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"{hashes} hash functions cannot reach a recall of {recall}")
    return best


def gram_sets(texts: pa.Array, n: int = WORDS) -> Iterator[tuple[bytes, np.ndarray]]:
    """For each text the key of its word sequence and its sorted set of hashed ``n``-grams.

    Fewer than ``n`` words are one shorter n-gram; no words give an empty set.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    bounds = lists.offsets.to_numpy()
    coded = lists.values.dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = pd.util.hash_array(np.array(words, object), categorize=False) if words else np.empty(0)
    full = np.array([w != "" for w in words], bool)
    flat, real = hashes.astype(np.uint64)[coded.indices], full[coded.indices]
    for a, b in zip(bounds, bounds[1:]):
        own = flat[a:b][real[a:b]]
        key = xxhash.xxh3_128_digest(own.tobytes())
        count = max(1, len(own) - n + 1) if len(own) else 0
        grams = np.zeros(count, np.uint64)
        for k in range(min(n, len(own))):
            grams = (grams ^ own[k : k + count]) * np.uint64(0x9E3779B97F4A7C15)
            grams ^= grams >> np.uint64(32)
        yield key, np.unique(grams)


def band_hashes(grams: np.ndarray, bands: int, rows: int, factors: np.ndarray) -> np.ndarray:
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for begin in range(0, len(grams), 8192):
        part = grams[begin : begin + 8192, None] * factors[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    mixed = np.arange(bands, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for column in least.reshape(bands, rows).T:
        mixed = (mixed ^ column) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


def signatures(docs: DataFrame, n: int, bands: int, rows: int, seed: int = 17) -> DataFrame:
    """``(doc_id, key, n_grams, bands)`` per row; texts without words have no bands."""
    factors = np.random.default_rng(seed).integers(0, 2**63, bands * rows, np.uint64) * 2 + 1

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys, counts, hashed = [], [], []
            for key, grams in gram_sets(batch.column("text"), n):
                keys.append(key)
                counts.append(len(grams))
                hashed.append(band_hashes(grams, bands, rows, factors) if len(grams) else [])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(keys, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.array(hashed, pa.list_(pa.int64())),
                ],
                ["doc_id", "key", "n_grams", "bands"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        sign, "doc_id long, key binary, n_grams long, bands array<long>"
    )


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each two of ``sets`` share."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    grams, column, count = np.unique(
        np.concatenate(sets), return_inverse=True, return_counts=True
    )
    common = count > 1
    number = np.cumsum(common) - 1
    use = common[column]
    owner, column = owner[use], number[column[use]]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = 4096
    for begin in range(0, int(common.sum()), width):
        a, b = np.searchsorted(column, [begin, begin + width])
        present = np.zeros((len(sets), width), np.float32)
        present[owner[a:b], column[a:b] - begin] = 1
        shared += present @ present.T
    return shared


def linked(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which two of ``sets`` have the Jaccard ``similarity`` (a set is not linked to itself)."""
    size = np.array([len(s) for s in sets], np.float64)
    shared = shared_counts(sets).astype(np.float64)
    # shared / union >= similarity, without the division
    found = shared >= similarity * (size[:, None] + size[None, :] - shared) - 1e-9
    np.fill_diagonal(found, False)
    return found


def _roots(found: np.ndarray) -> np.ndarray:
    """The first member of each member's connected group."""
    root = np.full(len(found), -1)
    for k in range(len(found)):
        if root[k] < 0:
            root[k], edge = k, np.array([k])
            while len(edge):
                reached = found[edge].any(axis=0) & (root < 0)
                root[reached] = k
                edge = np.flatnonzero(reached)
    return root


def near_classes(
    docs: DataFrame,
    n: int = WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    hashes: int = HASHES,
    block_texts: int = BLOCK_TEXTS,
    block_grams: int = BLOCK_GRAMS,
) -> DataFrame:
    """``(doc_id, class_id, n_links, n_copies)`` for every row.

    Texts are linked when the Jaccard similarity of their sets of ``n`` words reaches
    ``similarity``; a class is what links connect, and ``class_id`` its smallest ``doc_id`` (null only
    if all its ids are). ``n_links`` counts other texts (different word sequences) linked to the
    row's text, ``n_copies`` the rows with its very words. Texts without words, null ones included,
    are copies of each other. A text of fewer than ``n`` words has one shorter n-gram. Rows that
    repeat a ``doc_id`` are judged by their texts. Other columns of ``docs`` are ignored.
    """
    bands, rows = choose_bands(similarity, recall, hashes)
    spark = docs.sparkSession
    with batch_rows(spark, TEXT_ROWS):
        signed = materialize(signatures(docs, n, bands, rows), "signatures")
    texts = materialize(
        signed.groupBy("key").agg(
            F.any_value("bands").alias("bands"),
            F.max("n_grams").alias("n_grams"),
            F.min("doc_id").alias("first_id"),
            F.count(F.lit(1)).alias("n_copies"),
        ),
        "near-texts",
    )

    # candidate groups: texts of a band bucket are linked to the least of them
    bucketed = texts.select("key", F.explode("bands").alias("bucket"))
    least = (
        bucketed.groupBy("bucket")
        .agg(F.min("key").alias("b"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .select("bucket", "b")
    )
    groups = connected(bucketed.join(least, "bucket").select(F.col("key").alias("a"), "b"))
    members = groups.join(
        texts.select(F.col("key").alias("node"), "n_grams", "first_id"), "node"
    )
    sizes = members.groupBy("root").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / block_texts), F.ceil(F.sum("n_grams") / block_grams)
        ).cast("int").alias("blocks")
    )
    members = materialize(
        members.join(sizes, "root").withColumn(
            "block", F.pmod(F.xxhash64("node", F.lit("block")), "blocks").cast("int")
        ),
        "near-members",
    )
    verified = _verify(docs, members, n, similarity, block_texts)
    with batch_rows(spark, TEXT_ROWS):
        verified = materialize(verified, "near-links")
    links = verified.groupBy("key").agg(F.sum("links").alias("n_links"))
    classes = connected(verified.select(F.col("key").alias("a"), F.col("root").alias("b")))

    # a class is named by its smallest id
    named = texts.join(classes.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "root", F.coalesce("root", "key")
    )
    names = named.groupBy("root").agg(F.min("first_id").alias("class_id"))
    named = (
        named.join(names, "root")
        .join(links, "key", "left")
        .select(
            "key", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_copies"
        )
    )
    return signed.select("doc_id", "key").join(named, "key").drop("key")


def _verify(
    docs: DataFrame, members: DataFrame, n: int, similarity: float, block_texts: int
) -> DataFrame:
    """``(key, root, links)``: links found per text and task, and the group the task puts it in."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys = batch.column("node").to_pylist()
            found = list(gram_sets(batch.column("text"), n))
            # a row that repeats the id but not the text is not the member
            rows = [k for k, (key, _) in enumerate(found) if key == keys[k]]
            taken = batch.take(pa.array(rows, pa.int64())).drop_columns(["text"])
            grams = pa.array([found[k][1].view(np.int64) for k in rows], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, grams], names=[*taken.schema.names, "grams"]
            )

    spark = docs.sparkSession
    tasks = shuffle_tasks(spark)
    texts = _likely(docs.select(F.col("doc_id").cast("long"), "text"), members)
    matched = texts.join(members, F.col("doc_id").eqNullSafe(F.col("first_id")))
    member_sets = matched.select("text", "node", "root", "blocks", "block").mapInArrow(
        sets, "node binary, root binary, blocks int, block int, grams array<long>"
    )
    # every pair of a group's blocks, the block with itself included, is a task
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = member_sets.withColumn("_other", other).select(
        "node", "root", "block", "grams",
        F.least("block", "_other").alias("low"), F.greatest("block", "_other").alias("high"),
        # small groups share a task
        F.when(F.col("blocks") > 1, F.xxhash64("root", F.least("block", "_other"),
               F.greatest("block", "_other")))
        .otherwise(F.pmod(F.xxhash64("root"), F.lit(8 * tasks))).alias("task"),
    )

    def compare(table: pa.Table) -> pa.Table:
        nodes, roots = table.column("node").to_pylist(), table.column("root").to_pylist()
        low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
        block = table.column("block").to_numpy()
        grams = table.column("grams").combine_chunks()
        grams = grams.chunk(0) if isinstance(grams, pa.ChunkedArray) else grams
        flat, at = grams.values.to_numpy().view(np.uint64), grams.offsets.to_numpy()
        parts: dict[tuple, dict[bytes, int]] = {}
        for k, place in enumerate(zip(roots, low, high)):
            parts.setdefault(place, {})[nodes[k]] = k  # rows that repeat a text count once
        out = []
        for (_, a, b), own in parts.items():
            rows = sorted(own.values(), key=lambda k: nodes[k])
            found = linked([flat[at[k] : at[k + 1]] for k in rows], similarity)
            if a != b:  # pairs within a block belong to that block's own task
                found &= block[rows][:, None] != block[rows][None, :]
            root, count = _roots(found), found.sum(axis=1)
            out += [(nodes[k], nodes[rows[r]], int(c)) for k, r, c in zip(rows, root, count)]
        return pa.table(
            [pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.binary(), pa.int64()))],
            names=["key", "root", "links"],
        )

    return dealt.groupBy("task").applyInArrow(compare, "key binary, root binary, links long")


def _likely(texts: DataFrame, members: DataFrame) -> DataFrame:
    """``texts`` that can be members: most others are left out before the join moves texts.

    The members' ids set bits of a map of ``FILTER_BITS``, which is all that is broadcast: half a
    megabyte at most, whatever the number of members. A full map lets all pass.
    """

    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))

    maps = members.groupBy(F.bitmap_bucket_number(place("first_id")).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place("first_id"))).alias("_bits")
    )
    at = F.bitmap_bit_position(place("doc_id")).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10)
    is_set = byte.cast("int").bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) != 0
    return (
        texts.withColumn("_bucket", F.bitmap_bucket_number(place("doc_id")))
        .join(F.broadcast(maps), "_bucket")
        .filter(is_set)
        .select(texts.columns)
    )


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the row of the smallest id of every class; rows that repeat an id go together."""
    kept = near_classes(docs, **options).filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    kept = kept.select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")
