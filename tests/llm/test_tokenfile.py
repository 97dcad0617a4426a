import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from segqa.llm import tokenfile
from segqa.llm.queries import TOKENIZER

from .test_packing import direct


@settings(max_examples=200, deadline=None)
@given(
    st.lists(
        st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), min_size=1, max_size=600
    ),
    st.sampled_from([0.0, 0.5, 0.9, 1.0]),
)
def test_block_round_trip(ids, percentile):
    data = tokenfile.encode_block(np.array(ids, np.uint32), percentile)
    assert tokenfile.decode_block(memoryview(data)).tolist() == ids


def test_outliers_do_not_widen_a_block():
    ids = np.arange(512, dtype=np.uint32) % 200 + 40_000
    plain = len(tokenfile.encode_block(ids))
    ids[7] = 2**31
    assert len(tokenfile.encode_block(ids)) <= plain + 8


def test_write_and_read(spark, awkward, awkward_rows):
    folder = tokenfile.token_folder(spark)
    manifest = tokenfile.write_token_files(awkward, folder, TOKENIZER, block_ids=64)
    rows = sorted(tokenfile.read_token_files(manifest, folder).collect(), key=lambda r: r.start)
    ordered = sorted(awkward_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start = 0
    for row, (doc_id, text, *_) in zip(rows, ordered, strict=True):
        ids = [*direct(text), 2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row.doc_id, row.start, row.n_tokens, row.ids_crc32) == (doc_id, start, len(ids), crc)
        start += len(ids)


def test_random_access(spark, awkward):
    folder = tokenfile.token_folder(spark)
    manifest = tokenfile.write_token_files(awkward, folder, TOKENIZER, block_ids=64)
    row = manifest.orderBy(manifest.n_tokens.desc()).first()
    store, path = tokenfile._place(folder)
    with store.open_input_file(f"{path}/{row.file}") as source:
        file = tokenfile.TokenFile(source, row.n_bytes)
        everything = np.concatenate(list(file.blocks()))
        assert len(everything) == row.n_tokens
        for a, b in ((0, 1), (63, 65), (100, 100), (row.n_tokens - 3, row.n_tokens)):
            assert file.ids(a, b).tolist() == everything[a:b].tolist()


def test_files_of_lost_tasks_do_not_count(spark, awkward):
    folder = tokenfile.token_folder(spark)
    first = tokenfile.write_token_files(awkward, folder, TOKENIZER)
    tokenfile.write_token_files(awkward, folder, TOKENIZER)  # leaves files that no one names
    assert tokenfile.read_token_files(first, folder).count() == awkward.count()


def test_empty(spark, empty):
    folder = tokenfile.token_folder(spark)
    manifest = tokenfile.write_token_files(empty, folder, TOKENIZER)
    assert tokenfile.read_token_files(manifest, folder).count() == 0
