"""Token ids of whole texts by the tokenizers library, one call for each new word."""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .batches import give_back, raw_bytes, texts

#: Words that a Python worker remembers at most (twice over), and the longest of them.
REMEMBERED, LONGEST = 400_000, 32
#: Pieces given to the library at once: what it returns is much larger than the ids.
_ASKED = 4096
_SPACE, _WORD, _MARK, _APOSTROPHE = range(4)
_KIND = np.full(256, _WORD, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[[b for b in range(128) if not chr(b).isalnum() and _KIND[b] != _SPACE]] = _MARK
_KIND[ord("'")] = _APOSTROPHE


def _plain(raw: np.ndarray) -> bool:
    """Whether all characters beyond ASCII are letters below U+02C0 other than U+0130, and no marker string begins."""
    high = np.bincount(raw, minlength=256)
    if high[0xC2] or high[0xCB:].any():
        return False
    data = raw.tobytes()
    return not any(x in data for x in (b"\xc3\x97", b"\xc3\xb7", b"\xc4\xb0", b"<|"))


class WordEncoder:
    """Ids of texts under a tokenizer that lowers case, drops white space and splits words from marks.

    A text's ids are those of its pieces, so a piece is given to the library
    once and its ids are gathered for every occurrence. Pieces are parted by ASCII
    white space. Where a batch has nothing but ASCII and plain Latin letters,
    they are also lower-cased and parted before marks, and after marks other than
    an apostrophe, which the tokenizer may join with what follows. The ids are
    those of ``encode(text, add_special_tokens=False)``.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if self.vocabulary <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _pieces(self, column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The pieces of all texts, and the n + 1 offsets of the texts in them."""
        raw, offsets = raw_bytes(column)
        plain = _plain(raw)
        if plain:
            raw, offsets = raw_bytes(pc.utf8_lower(column))
        kind = _KIND[raw]
        inside = kind != _SPACE
        begin = inside.copy()
        if plain:
            begin[1:] &= ~inside[:-1] | ((kind[:-1] == _WORD) & (kind[1:] >= _MARK)) | ((kind[:-1] == _MARK) & (kind[1:] == _WORD))
        else:
            begin[1:] &= ~inside[:-1]
        first = offsets[:-1][np.diff(offsets) > 0]
        begin[first] = inside[first]
        start = np.flatnonzero(begin)
        ends = np.append(np.cumsum(inside)[start] - 1, np.count_nonzero(inside))  # places without the white space
        packed = pa.LargeStringArray.from_buffers(
            len(start), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw[inside]))
        return packed, np.searchsorted(start, offsets)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and the n + 1 offsets of the texts."""
        if len(self.known) > REMEMBERED:
            self.known, self.before = {}, self.known
        packed, offsets = self._pieces(column)
        coded = packed.dictionary_encode()
        pieces, known, before = coded.dictionary.to_pylist(), self.known, self.before
        lists = list(map(known.get, pieces))
        new = [i for i, x in enumerate(lists) if x is None]
        ask = []
        for i in new:
            lists[i] = x = before.get(pieces[i])
            if x is None:
                ask.append(i)
        found = [e.ids for k in range(0, len(ask), _ASKED) for e in self.tokenizer.encode_batch_fast(
            [pieces[i] for i in ask[k:k + _ASKED]], add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        raw = np.fromiter(chain.from_iterable(found), self.kind, counts.sum()).tobytes()
        ends = (np.cumsum(counts) * self.kind.itemsize).tolist()
        for i, a, b in zip(ask, [0, *ends], ends):
            lists[i] = raw[a:b]
        for i in new:
            if len(pieces[i]) <= LONGEST:
                known[pieces[i]] = lists[i]
        counts = np.fromiter(map(len, lists), np.int64, len(lists)) // self.kind.itemsize
        flat = np.frombuffer(b"".join(lists), self.kind)
        at = coded.indices.to_numpy()
        begin, counts = (np.cumsum(counts) - counts)[at], counts[at]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        ids = flat[np.repeat(begin - ends + counts, counts) + np.arange(total)]
        return ids, np.concatenate([[0], ends])[offsets]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """The worker's own encoder: kept as long as Spark reuses the worker."""
    return WordEncoder(path)


def encoded(path: str, batches: Iterator[pa.RecordBatch], end: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each batch with its ids and offsets (:func:`encode_with_end`); what the task has freed is given back at its end."""
    for batch in batches:
        yield batch, *encode_with_end(path, batch, end)
    give_back()


def forget() -> None:
    """Drop the worker's encoders with all words, up to some hundred MB: other work that the worker is reused for has no use for them."""
    if encoder.cache_info().currsize:
        encoder.cache_clear()
        give_back()


def encode_with_end(path: str, batch: pa.RecordBatch, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the batch's texts, id ``end`` after each, and the n + 1 offsets. Ids are as wide as the vocabulary needs."""
    ids, offsets = encoder(path).encode(texts(batch))
    lengths = np.diff(offsets)
    out = np.full(len(ids) + len(lengths), end, ids.dtype)
    inside = np.ones(len(out), bool)
    inside[offsets[1:] + np.arange(len(lengths))] = False
    out[inside] = ids
    return out, offsets + np.arange(len(offsets))
