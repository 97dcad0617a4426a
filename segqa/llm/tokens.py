"""Token ids of whole texts, one encoding per distinct word.

The tokenizer lower-cases, drops blanks and never joins text across them, nor a letter and the mark
behind it. So texts are first lower-cased (A-Z) and get a blank between a letter and a mark, in whole
arrays, and a text's ids are the ids of its blank-separated words in turn (held against the direct
encoding in the tests). Each worker encodes a word the first time it meets it and looks it up
afterwards.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import worker_store

TEXT_BYTES = 2 << 20  # of texts encoded together
WORD_BYTES = 16 << 20  # of known words, their bounds and ids; a worker keeps them between tasks

_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
# ASCII marks but for the apostrophe, which may open an ending, and the bar of special tokens
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "'|"]] = True
_SPECIAL = 32  # bytes of the longest special token, at least
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def parted(texts: pa.Array) -> pa.Array:
    """``texts`` (nulls empty) in lower case, with a blank between a letter and a mark.

    A capital before a combining accent stays, as the two may be one letter, and so does what may
    be a special token.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, bounds, values = texts.buffers()
    offsets = np.frombuffer(bounds, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first, last = (int(offsets[0]), int(offsets[-1])) if len(texts) else (0, 0)
    if first == last:
        return texts
    raw = np.frombuffer(values, np.uint8)[first:last]
    data = _LOWER[raw]
    accent = np.flatnonzero((raw[1:] == 0xCC) | (raw[1:] == 0xCD))
    data[accent] = raw[accent]
    opened = np.flatnonzero((raw[:-1] == 60) & (raw[1:] == 124))  # <|
    if len(opened):
        inside = np.zeros(len(raw) + _SPECIAL, np.int32)
        inside[opened] += 1
        inside[opened + _SPECIAL] -= 1
        special = np.cumsum(inside[: len(raw)]) > 0
        data[special] = raw[special]
    letter = _LETTER[data]
    # U+00C0 to U+00FF but for the two operators among them
    second = np.flatnonzero(data[:-1] == 0xC3) + 1
    letter[second] = (data[second] != 0x97) & (data[second] != 0xB7)
    cut = np.flatnonzero(letter[:-1] & _MARK[data[1:]]) + 1
    grown = np.insert(data, cut, np.uint8(32))
    offsets = offsets - first + np.searchsorted(cut, offsets - first, side="right")
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(grown)]
    return pa.Array.from_buffers(pa.large_string(), len(texts), buffers)


class WordEncoder:
    """Ids of blank-separated words, looked up in whole arrays.

    ``words`` are the known ones, row for row with ``start`` and ``length`` in ``pool``. Beyond
    ``word_bytes`` those that no text asked for again are forgotten.
    """

    def __init__(self, path: str, word_bytes: int = WORD_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        # ids that end a run of letters, marks or the like
        self.closing = np.array(
            [(self.tokenizer.id_to_token(k) or "").endswith("</w>") for k in range(size)]
        )
        self.word_bytes = word_bytes
        self._keep(np.empty(0, np.int64))

    def _keep(self, rows: np.ndarray) -> None:
        """Know these rows of the words only, and the empty word."""
        if len(rows):
            self.pool, self.length = self.gather(rows)
            self.words = self.words.take(pa.array(rows))
        else:
            self.pool, self.length = np.empty(0, np.uint32), np.zeros(1, np.int64)
            self.words = pa.array([""], pa.large_string())
        self.start = np.cumsum(self.length) - self.length
        self.asked = np.zeros(len(self.length), bool)
        self.asked[0] = True

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in ``rows`` in turn, and their numbers."""
        lengths = self.length[rows]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.start[rows] - (ends - lengths), lengths)
        shift += np.arange(len(shift))
        return self.pool[shift], lengths

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return _flat([e.ids for e in found])

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters alone: one text of them all, parted where a run of letters ends."""
        text = " ".join(words)
        ids = np.array(
            self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32
        )
        ends = np.flatnonzero(self.closing[ids]) + 1
        if len(ends) != len(words) or (len(ids) and ends[-1] != len(ids)):
            return self._each(words)  # lower case turned some letter into more than letters
        return ids, np.diff(np.concatenate([[0], ends]))

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of a to z: already what the merges work on."""
        tokenize = self.tokenizer.model.tokenize
        return _flat([[token.id for token in tokenize(word)] for word in words])

    def _learn(self, words: pa.Array) -> None:
        small = pc.ascii_is_lower(words).to_numpy(zero_copy_only=False)
        alpha = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
        small &= alpha & pc.string_is_ascii(words).to_numpy(zero_copy_only=False)
        pools, used = [self.pool], len(self.pool)
        start, length = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        for encode, chosen, most in (
            (self._plain, small, 8192),
            (self._letters, alpha & ~small, 500),
            (self._each, ~alpha, 500),
        ):
            rows = np.flatnonzero(chosen)
            for part in np.split(rows, range(most, len(rows), most)):
                ids, lengths = encode(words.take(pa.array(part)).to_pylist())
                start[part], length[part] = used + np.cumsum(lengths) - lengths, lengths
                pools.append(ids)
                used += len(ids)
        self.pool = np.concatenate(pools)
        self.start = np.concatenate([self.start, start])
        self.length = np.concatenate([self.length, length])
        self.asked = np.concatenate([self.asked, np.zeros(len(words), bool)])
        self.words = pa.concat_arrays([self.words, words])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``texts`` in one array, and where each text begins (one bound more)."""
        pa.default_memory_pool().release_unused()  # of the texts before
        lists = pc.ascii_split_whitespace(parted(texts))
        bounds, values = lists.offsets.to_numpy(), lists.values
        if self.words.nbytes + 8 * len(self.words) * 3 + self.pool.nbytes > self.word_bytes:
            kept = np.flatnonzero(self.asked)
            self._keep(kept if len(kept) < len(self.asked) // 2 else kept[:1])
        coded = values.dictionary_encode()
        # the hash table is of the texts' words, not of all known ones
        place = pc.fill_null(pc.index_in(self.words, coded.dictionary), -1).to_numpy()
        known = np.flatnonzero(place >= 0)
        rows = np.full(len(coded.dictionary), -1, np.int64)
        rows[place[known]] = known
        self.asked[known] = True
        del place, known
        new = np.flatnonzero(rows < 0)
        if len(new):
            rows[new] = len(self.words) + np.arange(len(new))
            self._learn(coded.dictionary.take(pa.array(new)))
        rows = rows[coded.indices.to_numpy()]
        ids, lengths = self.gather(rows)
        return ids, np.concatenate([[0], np.cumsum(lengths)])[bounds]


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return (
        np.fromiter(chain.from_iterable(ids), np.uint32),
        np.fromiter(map(len, ids), np.int64, len(ids)),
    )


def word_encoder(path: str) -> WordEncoder:
    """This worker's encoder for a vocabulary file."""
    store = worker_store()
    if path not in store:
        store[path] = WordEncoder(path)
    return store[path]
