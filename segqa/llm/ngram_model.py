"""N-gram language model as an Elias-Fano trie in memory-mapped level files.

Level 1 holds the words: sorted 64-bit hashes with exact counts. A level above holds, for each entry
of the level below (its context), the words that follow it: pointers to where a context's followers
begin, and the followers themselves. Both are monotone and stored in Elias-Fano form, followers as
numbers relative to their context's start. From level 3 on a follower is not named by its word but by
its place among the followers of the shorter context, a far smaller number. Each entry carries its
discounted probability and each context its back-off weight, both quantised to 16 bits of log10.

Levels are cut into shards by context. Tasks count on their own, ship sorted and compressed counts per
shard, and one task per shard merges and writes its file into the shared folder; a file counts once
the stored manifest names it. Scoring tasks map the files and look up all their n-grams at once, each
distinct one a single time.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from . import elias_fano
from .common import shuffle_tasks, slices, worker_store
from .elias_fano import EliasFano
from .tokenfile import _place

ORDER = 3
DISCOUNT = 0.75
STEP = 4096.0  # quantisation steps per unit of log10; 16 bits reach 10**-16
SHARD_TOKENS = 4_000_000  # training tokens per shard, about
BATCH_BYTES = 6 << 20  # of texts looked up together
READ_BYTES = 256 << 20  # of model files a worker holds where they cannot be mapped
FLUSH_ENTRIES = 1_500_000
END = " "  # no word holds a blank


class Level(NamedTuple):
    shards: int
    files: dict[int, str]  # by shard; a shard without entries has none
    ids: int  # numbers of its entries lie below this
    symbols: int  # numbers of the followers of one context lie below this
    bases: dict[int, int]  # of level 1: number of the first word of a shard


class Model(NamedTuple):
    folder: str
    levels: list[Level]
    tokens: int
    words: int


def quantise(p: np.ndarray) -> np.ndarray:
    return np.minimum(np.round(-np.log10(p) * STEP), 65534).astype("<u2")


def restore(q: np.ndarray) -> np.ndarray:
    return 10.0 ** (q.astype(np.float64) / -STEP)


def _words_of(data: np.ndarray) -> np.ndarray:
    """A 16-bit array as 64-bit words."""
    padded = np.zeros((len(data) + 3) // 4 * 4, "<u2")
    padded[: len(data)] = data
    return padded.view("<u8")


def _save(folder: str, words: np.ndarray) -> str:
    name = f"{uuid.uuid4().hex}.eft"
    store, path = _place(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/{name}") as out:
        out.write(words.astype("<u8").tobytes())
    return name


def _map(folder: str, name: str) -> np.ndarray:
    """The file's words: mapped where the folder is a file system's, else read."""
    store, path = _place(folder)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(f"{path}/{name}", "<u8", "r").view(np.ndarray)
    with store.open_input_file(f"{path}/{name}") as source:
        return np.frombuffer(source.read(), "<u8")


class Vocabulary:
    """One shard of level 1: hashes (from ``base``) and counts."""

    def __init__(self, words: np.ndarray, low: int):
        self.hashes = EliasFano(words)
        self.counts = words[self.hashes.size :]
        self.low = np.uint64(low)


class Shard:
    """One shard of a level above: pointers, followers, back-off weights, probabilities."""

    def __init__(self, words: np.ndarray):
        self.pointers = EliasFano(words)
        rest = words[self.pointers.size :]
        self.followers = EliasFano(rest)
        rest = rest[self.followers.size :]
        contexts = self.pointers.n - 1
        split = (contexts + 3) // 4
        self.backoff = rest[:split].view("<u2")
        self.probability = rest[split:].view("<u2")

    def find(self, context: np.ndarray, symbol: np.ndarray):
        """Entry index (-1: none), place among the context's followers, probability, back-off."""
        n = len(context)
        index, place, chance = np.full(n, -1), np.full(n, -1), np.zeros(n)
        known = (context >= 0) & (context < self.pointers.n - 1)
        weight = np.ones(n)
        rows = np.flatnonzero(known)
        weight[rows] = restore(self.backoff[context[rows]])
        rows = rows[(symbol[rows] >= 0)]
        begin, end = (p.astype(np.int64) for p in self.pointers.access_pair(context[rows]))
        some = begin < end
        rows, begin, end = rows[some], begin[some], end[some]
        # followers are stored after the last one of the context before
        base = np.zeros(len(rows), np.uint64)
        later = begin > 0
        base[later] = self.followers.access(begin[later] - 1) + np.uint64(1)
        wanted = base + symbol[rows].astype(np.uint64)
        # numbers of a context's followers lie in a range of their own, so an element is one of them
        at = self.followers.find(wanted)
        hit = (at >= begin) & (at < end)
        rows, at, begin = rows[hit], at[hit], begin[hit]
        index[rows], place[rows] = at, at - begin
        chance[rows] = restore(self.probability[at])
        return index, place, chance, weight


def _build_shard(keys: np.ndarray, counts: np.ndarray, symbols: int, contexts: int) -> np.ndarray:
    """Words of a shard from sorted distinct ``context * symbols + symbol`` and their counts."""
    context = (keys // np.uint64(symbols)).astype(np.int64)
    symbol = keys % np.uint64(symbols)
    per = np.bincount(context, minlength=contexts)
    pointers = np.concatenate([[0], np.cumsum(per)])
    total = np.bincount(context, weights=counts.astype(np.float64), minlength=contexts)
    ends = pointers[1:][per > 0]
    spans = np.zeros(contexts, np.uint64)
    spans[per > 0] = symbol[ends - 1] + np.uint64(1)
    base = np.concatenate([[0], np.cumsum(spans)[:-1]]).astype(np.uint64)
    chance = np.maximum(counts - DISCOUNT, 1e-9) / total[context]
    backoff = np.where(per > 0, DISCOUNT * per / np.maximum(total, 1), 1.0)
    return np.concatenate(
        [
            elias_fano.encode(pointers),
            elias_fano.encode(symbol + base[context]),
            _words_of(quantise(backoff)),
            _words_of(quantise(chance)),
        ]
    )


class Reader:
    """Maps a model's files as they are needed.

    Mapped files take no memory of the worker's. Of files that must be read, at most ``READ_BYTES``
    are held, those used last.
    """

    def __init__(self, model: Model):
        self.model, self.open, self.read = model, {}, {}

    def shard(self, level: int, shard: int):
        key = (level, shard)
        if key in self.read:
            self.read[key] = self.read.pop(key)
        if key not in self.open:
            held = self.model.levels[level]
            name = held.files.get(shard)
            words = _map(self.model.folder, name) if name else None
            if words is not None and not isinstance(words.base, np.memmap):
                self.read[key] = words.nbytes
                while len(self.read) > 1 and sum(self.read.values()) > READ_BYTES:
                    oldest = next(iter(self.read))
                    del self.read[oldest], self.open[oldest]
            if words is None:
                self.open[key] = None
            elif level == 0:
                self.open[key] = Vocabulary(words, _low_hash(shard, held.shards))
            else:
                self.open[key] = Shard(words)
        return self.open[key]

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1: unknown) and count of each word."""
        held = self.model.levels[0]
        number, count = np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        for shard, rows in _by(_hash_shard(hashes, held.shards)):
            part = self.shard(0, shard)
            if part is not None:
                at = part.hashes.find(hashes[rows] - part.low)
                rows, at = rows[at >= 0], at[at >= 0]
                number[rows], count[rows] = at + held.bases[shard], part.counts[at]
        return number, count

    def follow(self, level: int, context: np.ndarray, symbol: np.ndarray):
        """For each (context, symbol): entry number, place, probability and back-off weight."""
        held = self.model.levels[level]
        number, place = np.full(len(context), -1), np.full(len(context), -1)
        chance, weight = np.zeros(len(context)), np.ones(len(context))
        rows = np.flatnonzero(context >= 0)
        if not len(rows):
            return number, place, chance, weight
        # each distinct pair once
        pairs, back = _distinct(context[rows], symbol[rows] + 1)
        ctx, sym = pairs[0], pairs[1] - 1
        found = [np.full(len(ctx), -1), np.full(len(ctx), -1), np.zeros(len(ctx)), np.ones(len(ctx))]
        for shard, own in _by(ctx % held.shards):
            part = self.shard(level, shard)
            if part is not None:
                index, *rest = part.find(ctx[own] // held.shards, sym[own])
                found[0][own] = np.where(index >= 0, index * held.shards + shard, -1)
                for target, values in zip(found[1:], rest):
                    target[own] = values
        for target, values in zip((number, place, chance, weight), found):
            target[rows] = values[back]
        return number, place, chance, weight


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    span = int(b.max()) + 1
    if int(a.max()) * span < 2**62:
        keys, back = np.unique(a * span + b, return_inverse=True)
        return (keys // span, keys % span), back
    pairs, back = np.unique(np.stack([a, b], 1), axis=0, return_inverse=True)
    return (pairs[:, 0], pairs[:, 1]), back.ravel()


def _by(shards: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that occurs with its rows."""
    if len(shards) and shards.max() < 1 << 16:
        shards = shards.astype(np.uint16)  # sorted by digits
    order = np.argsort(shards, kind="stable")
    values, begin = np.unique(shards[order], return_index=True)
    for value, rows in zip(values, np.split(order, begin[1:])):
        yield int(value), rows


def _hash_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _low_hash(shard: int, shards: int) -> int:
    """The least hash of a shard."""
    return -(-(shard << 32) // shards) << 32


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of strings: their bytes' codes weighted by place, all words at once."""
    data = words.cast(pa.large_binary())
    offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    lengths = np.diff(offsets)
    out = lengths.astype(np.uint64)
    if len(data) and offsets[-1] > offsets[0]:
        codes = _BYTE_CODES[np.frombuffer(data.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]]
        place = np.arange(len(codes)) - np.repeat(offsets[:-1] - offsets[0], lengths)
        weights = _mixed(np.arange(1, int(lengths.max()) + 1, dtype=np.uint64) * _ODD) | np.uint64(1)
        some = lengths > 0
        out[some] += np.add.reduceat(codes * weights[place], (offsets[:-1] - offsets[0])[some])
    return _mixed(out * _ODD)


_ODD = np.uint64(0x9E3779B97F4A7C15)
_BYTE_CODES = _mixed(np.arange(1000, 1256, dtype=np.uint64) * _ODD)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct tokens, every token's index among them, where each text begins.

    Every text is its words, A-Z lower-cased, and one end.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    bounds, values = lists.offsets.to_numpy(), lists.values
    real = pc.not_equal(values, "").to_numpy(zero_copy_only=False)
    coded = values.dictionary_encode()
    names = coded.dictionary
    hashes = np.append(word_hashes(names), word_hashes(pa.array([END])))
    kept = np.concatenate([[0], np.cumsum(real)])[bounds]
    index = np.insert(coded.indices.to_numpy()[real].astype(np.int64), kept[1:], len(names))
    return hashes, index, kept + np.arange(len(kept))


def _combine(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their counts added up."""
    keys = np.concatenate([k for k, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _pack_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    return elias_fano.encode(keys).tobytes(), zlib.compress(counts.astype("<u4").tobytes(), 1)


def _unpack_counts(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(zlib.decompress(counts), "<u4").astype(np.int64)
    return elias_fano.decode(np.frombuffer(keys, "<u8")), found


_BLOB = "shard long, keys binary, counts binary"


def _ship(parts: list[tuple[np.ndarray, np.ndarray]], shard_of, local_of):
    """Batches of one row per shard with the counts in ``parts``."""
    keys, counts = _combine(parts)
    rows = []
    for shard, own in _by(shard_of(keys)):
        rows.append((shard, *_pack_counts(local_of(keys[own], shard), counts[own])))
        if len(rows) == 64:
            yield _blobs(rows)
            rows = []
    if rows:
        yield _blobs(rows)


def _blobs(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], ["shard", "keys", "counts"]
    )


def _merge_shards(blobs: DataFrame, folder: str, build) -> list:
    """Write a file per shard; rows of ``(shard, file, n_entries, n_tokens, most)``."""

    def merge(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        pairs = zip(table.column("keys").to_pylist(), table.column("counts").to_pylist())
        keys, counts = _combine([_unpack_counts(k, c) for k, c in pairs])
        words, most = build(shard, keys, counts)
        row = (shard, _save(folder, words), len(keys), int(counts.sum()), most)
        return pa.table([pa.array([v]) for v in row], names=_MANIFEST)

    spark = blobs.sparkSession
    merged = blobs.repartition(shuffle_tasks(spark), "shard").groupBy("shard").applyInArrow(
        merge, "shard long, file string, n_entries long, n_tokens long, most long"
    )
    # one row per shard
    return materialize(merged, "ngram-manifest").collect()


_MANIFEST = ["shard", "file", "n_entries", "n_tokens", "most"]


def train(docs: DataFrame, order: int = ORDER, shard_tokens: int = SHARD_TOKENS) -> Model:
    """The model of all texts of ``docs``; without rows it knows no word."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "ngram-model")
    texts = docs.select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // (6 * shard_tokens)))  # about six bytes a token
    level, tokens, words = _words_level(texts, folder, shards)
    model = Model(folder, [level], tokens, words)
    for k in range(1, order):
        model = model._replace(levels=[*model.levels, _upper_level(texts, model, shards + k)])
    return model


def _words_level(texts: DataFrame, folder: str, shards: int) -> tuple[Level, int, int]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in slices(batches, "text", BATCH_BYTES):
            hashes, index, _ = tokens_of(batch.column("text"))
            counts = np.bincount(index, minlength=len(hashes))
            parts.append((hashes[counts > 0], counts[counts > 0]))
            held += len(hashes)
            if held > FLUSH_ENTRIES:
                parts = [_combine(parts)]
                held = len(parts[0][0])
            if held > FLUSH_ENTRIES:
                yield from ship(parts)
                parts, held = [], 0
        if parts:
            yield from ship(parts)

    def ship(parts):
        return _ship(
            parts,
            lambda keys: _hash_shard(keys, shards),
            lambda keys, shard: keys - np.uint64(_low_hash(shard, shards)),
        )

    def build(shard: int, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
        return np.concatenate([elias_fano.encode(keys), counts.astype("<u8")]), 0

    rows = _merge_shards(texts.mapInArrow(count, _BLOB), folder, build)
    bases, total = {}, 0
    for row in sorted(rows):
        bases[row.shard] = total
        total += row.n_entries
    files = {row.shard: row.file for row in rows}
    return Level(shards, files, total, total, bases), sum(r.n_tokens for r in rows), total


def _upper_level(texts: DataFrame, model: Model, shards: int) -> Level:
    below = model.levels[-1]
    symbols, ids = max(below.symbols, 1), below.ids
    if ids * symbols >= 2**64:
        raise ValueError("too many n-grams for 64-bit keys")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(model)
        parts, held = [], 0
        for batch in slices(batches, "text", BATCH_BYTES):
            context, symbol = Walk(reader, batch.column("text")).next_pairs()
            seen = (context >= 0) & (symbol >= 0)
            keys = context[seen].astype(np.uint64) * np.uint64(symbols)
            parts.append(np.unique(keys + symbol[seen].astype(np.uint64), return_counts=True))
            held += len(parts[-1][0])
            if held > FLUSH_ENTRIES:
                yield from ship(parts)
                parts, held = [], 0
        if parts:
            yield from ship(parts)

    def ship(parts):
        # a context's number in its shard stands for it from here on
        return _ship(
            parts,
            lambda keys: (keys // np.uint64(symbols) % np.uint64(shards)).astype(np.int64),
            lambda keys, shard: keys // np.uint64(symbols) // np.uint64(shards) * np.uint64(symbols)
            + keys % np.uint64(symbols),
        )

    def build(shard: int, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int]:
        contexts = (ids - shard + shards - 1) // shards
        most = int(np.bincount((keys // np.uint64(symbols)).astype(np.int64)).max())
        return _build_shard(keys, counts, symbols, contexts), most

    rows = _merge_shards(texts.mapInArrow(count, _BLOB), model.folder, build)
    entries = max((r.n_entries for r in rows), default=0)
    files = {row.shard: row.file for row in rows}
    return Level(shards, files, entries * shards, max((r.most for r in rows), default=0), {})


def _reader(model: Model) -> Reader:
    """This worker's reader of a model; levels that were added since are opened on demand."""
    key = f"{model.folder}/{len(model.levels)}"
    store = worker_store()
    if key not in store:
        for old in [k for k in store if k.startswith(f"{model.folder}/")]:
            del store[old]
        store[key] = Reader(model)
    return store[key]


class Walk:
    """The tokens of some texts, followed up the levels of a model."""

    def __init__(self, reader: Reader, texts: pa.Array):
        self.reader = reader
        hashes, index, self.bounds = tokens_of(texts)
        number, count = reader.words(hashes)
        self.number, self.count = number[index], count[index]
        self.heads = self.bounds[:-1]
        model = reader.model
        self.base = (self.count + 0.1) / (model.tokens + 0.1 * (model.words + 1))
        self.chance, self.place = self.base, self.number
        for level in range(1, len(model.levels)):
            context, symbol = self.next_pairs()
            self.number, self.place, own, weight = reader.follow(level, context, symbol)
            self.chance = own + weight * self.chance

    def next_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Context and symbol of every token for the level above; -1 where there is none."""
        context = np.concatenate([[-1], self.number[:-1]])
        context[self.heads] = -1
        return context, self.place


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``n_tokens, n_known`` (long), ``base_score`` and ``score`` (double).

    Scores are sums of log10 probabilities over the text's tokens and its end: ``base_score`` by
    smoothed single counts, ``score`` by the trie, where a token's probability is its discounted one
    in the longest context plus the back-off weight times that in the next shorter context. A null
    text is an end alone. Columns of these names are replaced, all others kept; repeated rows score
    alike; an empty table stays empty.
    """
    names = ["n_tokens", "n_known", "base_score", "score"]
    docs = docs.drop(*names)
    types = ["long", "long", "double", "double"]
    schema = ", ".join(
        [*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema),
         *(f"{n} {t}" for n, t in zip(names, types))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _reader(model)
        for batch in slices(batches, "text", BATCH_BYTES):
            walk = Walk(reader, batch.column("text"))
            begin = walk.bounds[:-1]
            sums = [
                np.add.reduceat(values, begin)
                for values in (
                    np.ones(len(walk.count), np.int64), (walk.count > 0).astype(np.int64),
                    np.log10(walk.base), np.log10(walk.chance),
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *map(pa.array, sums)], names=[*batch.schema.names, *names]
            )

    return docs.mapInArrow(run, schema)
