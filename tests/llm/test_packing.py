import mmap
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from segqa.llm import common, packing
from segqa.llm.packing import Capacity, best_fit
from segqa.llm.queries import TOKENIZER
from segqa.llm.tokens import WordEncoder

ENCODER = WordEncoder(TOKENIZER, word_bytes=3000)
DIRECT = Tokenizer.from_file(TOKENIZER)


def direct(text):
    return DIRECT.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.none()
        | st.text(max_size=40)
        | st.text(alphabet="aAbÉß'sΣ  ́\n\t\x0b\x1c<|>\U0001f600", max_size=30)
        | st.sampled_from(["<|endoftext|> x", "a<|startoftext|>b c", "it's THE  end"])
        | st.sampled_from(["H\u0331T\u0308 ÷, é,x. Ç!", "T", "\u0308a", "<|ENDofTEXT|>,<|ABC,"]),
        max_size=8,
    )
)
def test_word_cache_equals_direct_encoding(texts):
    ids, bounds = ENCODER.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [direct(t) for t in texts]


def test_look_up_needs_no_copy_of_the_known_words():
    encoder = WordEncoder(TOKENIZER)
    encoder.encode(pa.array([" ".join(f"w{k}" for k in range(50_000))]))
    usual, watched = pa.default_memory_pool(), pa.proxy_memory_pool(pa.default_memory_pool())
    pa.set_memory_pool(watched)
    try:
        ids, _ = encoder.encode(pa.array(["w7 w49999 w7"]))
    finally:
        pa.set_memory_pool(usual)
    assert ids.tolist() == direct("w7 w49999 w7")
    assert watched.max_memory() < encoder.words.nbytes


def test_texts_come_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            rows = pa.array([batch.num_rows] * batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, rows], ["doc_id", "piece", "length", "rows"])

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    pieces = spark.range(3000, numPartitions=1).selectExpr("id doc_id", "0 piece", "1L length")
    seen = packing.pack(
        pieces.mapInArrow(sizes, "doc_id long, piece int, length long, rows long")
    ).collect()
    assert len(seen) == 3000 and max(r.rows for r in seen) <= common.TEXT_ROWS
    assert spark.conf.get(name) == before


def test_a_worker_keeps_no_freed_memory_after_a_task():
    def resident():
        return int(Path("/proc/self/statm").read_text().split()[1]) * mmap.PAGESIZE

    freed = [np.ones(8192) for _ in range(2000)]  # 64 KB each, which glibc keeps when let go
    last = np.ones(8192)  # and above them one that stays
    full = resident()
    del freed
    assert list(common.slices([], "text")) == []
    assert full - resident() > 64 << 20 and len(last)


@settings(max_examples=100, deadline=None)
@given(
    st.lists(st.integers(1, 50), max_size=60),
    st.sampled_from(["norm", "dot"]),
    st.sampled_from([Capacity(50, 99, 9999), Capacity(80, 3, 9999), Capacity(60, 99, 2500)]),
)
def test_every_capacity_binds(lengths, rule, capacity):
    lengths = np.array(sorted(lengths, reverse=True), np.int64)
    where, offset = best_fit(lengths, capacity, rule)
    for sequence in set(where.tolist()):
        own = where == sequence
        assert lengths[own].sum() <= capacity.tokens
        assert own.sum() <= capacity.documents
        assert (lengths[own] ** 2).sum() <= capacity.attention
        order = np.argsort(offset[own])
        assert offset[own][order].tolist() == [0, *np.cumsum(lengths[own][order])[:-1].tolist()]
    # no two sequences could have been one
    left = [capacity.tokens - lengths[where == s].sum() for s in set(where.tolist())]
    if capacity.documents == 99 and capacity.attention == 9999 and len(left) > 1:
        assert sorted(left)[-2] < capacity.tokens / 2 or len(lengths) == 0


def test_norm_takes_the_fullest_and_dot_the_emptiest():
    capacity = Capacity(10, 99, 10**6, (1.0, 0.0, 0.0))
    # 7 and 6 open a sequence each; 3 fits both
    assert best_fit(np.array([7, 6, 3]), capacity, "norm")[0].tolist() == [0, 1, 0]
    assert best_fit(np.array([7, 6, 3]), capacity, "dot")[0].tolist() == [0, 1, 1]


def test_too_long_a_piece_is_an_error():
    with pytest.raises(ValueError):
        best_fit(np.array([11]), Capacity(10, 9, 999))


def test_packed_documents(spark, awkward, awkward_rows):
    capacity = Capacity(tokens=100)
    rows = packing.packed_documents(awkward, TOKENIZER, capacity).collect()
    expected = defaultdict(int)
    for doc_id, text, *_ in awkward_rows:
        ids = [*direct(text), 1]
        for piece, start in enumerate(range(0, len(ids), 100)):
            part = np.array(ids[start : start + 100], "<u4")
            expected[doc_id, piece, start, len(part), zlib.crc32(part.tobytes())] += 1
    found = defaultdict(int)
    sequences = defaultdict(list)
    for r in rows:
        found[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert found == expected
    total = sum(r.length for r in rows)
    assert len(sequences) <= total / 100 * 1.05 + 1
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 100


def test_groups_are_packed_apart_and_alike(spark, awkward):
    pieces = packing.token_pieces(awkward, TOKENIZER, 100)
    once = packing.pack(pieces, Capacity(100), group_pieces=20)
    again = packing.pack(pieces.repartition(5), Capacity(100), group_pieces=20)
    assert sorted(map(str, once.collect())) == sorted(map(str, again.collect()))


def test_empty(spark, empty):
    assert packing.packed_documents(empty, TOKENIZER).count() == 0
