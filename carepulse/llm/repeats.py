"""Repeated byte strings across a corpus, removed after their first occurrence, by prefix-free parsing.

Every window of ``size`` bytes has a trigger, the smallest rolling hash inside
it. Windows next to each other with one trigger form a phrase. Triggers depend on
content alone, so equal windows have equal triggers, wherever they stand. The
dictionary holds each distinct phrase once, the parse says where phrases occur.

Sorting the parse by (trigger, phrase, document, place) puts the occurrences of
a phrase in corpus order: all windows of all but the first are repeats. What
remains are the phrases whose trigger also occurs in other phrases, the
edges of repeated passages, or in the same one again. Their windows, the dictionary's suffixes cut at ``size``
bytes, are sorted the same way, and again all but the first of equals are
repeats. Only equality matters, so suffixes are ordered by hash.

Each task sends one row of a phrase at most, its first in the task: a passage
that a third of all documents share meets the shuffle once per task. Edges are dealt by
trigger with their bytes, those of a frequent trigger window by window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scans import numbered
from .batches import bounded_batches, keep, raw_bytes, record, slices

_U = np.uint64
_LOWEST = -(1 << 63)
#: Phrases or windows that a task holds before it sends what it has, and bytes of text hashed at a time.
HELD, HASHED = 600_000, 1 << 18
#: Text that a bucket stands for.
BUCKET_BYTES = 16 << 20
#: A trigger with more distinct phrases is dealt window by window.
HOT = 20_000
_ROW = np.dtype([("a", "<u8"), ("b", "<u8"), ("doc", "<i8"), ("place", "<i8"), ("n", "<i4"), ("own", "u1")])


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two strings that follow each other from theirs."""
    x = a * _U(0x9E3779B97F4A7C15)
    x ^= x >> _U(32)
    x += b
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(29)
    return x


def trigger_size(size: int) -> int:
    return 1 << max(0, (size // 3).bit_length() - 1)


class Hashes:
    """Hashes of the strings of one length that start at each byte, for lengths as they are asked for."""

    def __init__(self, raw: np.ndarray):
        padded = np.concatenate([raw, np.zeros(8, np.uint8)])
        self.count = len(raw)
        eight = np.ndarray((len(raw),), "<u8", padded, strides=(1,)).copy()
        self.known = {8: eight}

    def _power(self, k: int) -> np.ndarray:
        if k not in self.known:
            if k < 8:
                self.known[k] = _join(self.known[8] & _U((1 << 8 * k) - 1), np.zeros(self.count, np.uint64))
            else:
                half = self._power(k // 2)
                self.known[k] = _join(half[:max(0, len(half) - k // 2)], half[k // 2:])
        return self.known[k]

    def of(self, size: int) -> np.ndarray:
        """For every string of ``size`` bytes."""
        n = max(0, self.count - size + 1)
        top = 1 << (size.bit_length() - 1)
        h = self._power(top)
        return h[:n] if top == size else _join(h[:n], h[size - top:size - top + n])

    def check(self, size: int) -> np.ndarray:
        """Another hash of every string of ``size`` bytes, from other parts."""
        k = trigger_size(size)
        h, n = self._power(k), max(0, self.count - size + 1)
        return _join(_join(h[:n], h[(size - k) // 2:(size - k) // 2 + n]), h[size - k:size - k + n])


def extreme(h: np.ndarray, width: int, of=np.minimum) -> np.ndarray:
    """The smallest (or largest) of every run of ``width`` values."""
    k = 1
    while k < width:
        step = min(k, width - k)
        h = of(h[:max(0, len(h) - step)], h[step:])
        k += step
    return h


def _windows(offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows inside their text, and the texts."""
    count = np.maximum(0, np.diff(offsets) - size + 1)
    owner = np.repeat(np.arange(len(count)), count)
    return np.arange(count.sum()) + np.repeat(offsets[:-1] - np.cumsum(count) + count, count), owner


def phrases(raw: np.ndarray, offsets: np.ndarray, size: int):
    """(trigger, digest, text, first window in the text, windows, own) of the texts' phrases in order.

    ``own``: the trigger is found in the phrase more than once, so that it may repeat windows of its own.
    """
    at, owner = _windows(offsets, size)
    hashes = Hashes(raw)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), owner, at, at, at
    k = trigger_size(size)
    width = size - k + 1  # places of the trigger in a window, so windows that one of its places can be in
    inner, window = hashes.of(k), hashes.of(size)
    low = extreme(inner, width)
    trigger = low[at]
    begin = np.flatnonzero(np.append(True, (trigger[1:] != trigger[:-1]) | (owner[1:] != owner[:-1])))
    n = np.diff(np.append(begin, len(at)))
    if n.max() > width:  # the same trigger again and again: short periods
        parts = -(-n // width)
        first = np.cumsum(parts) - parts
        begin = np.repeat(begin, parts) + (np.arange(parts.sum()) - np.repeat(first, parts)) * width
        n = np.diff(np.append(begin, len(at)))
    edge = np.zeros(width - 1, np.uint64)
    found = np.flatnonzero(inner == extreme(np.concatenate([edge, low, edge]), width, np.maximum))  # places of triggers
    again = np.concatenate([[0], np.cumsum((inner[found[1:]] == inner[found[:-1]]) & (np.diff(found) < 2 * width))])
    low, owner, trigger = at[begin], owner[begin], trigger[begin]
    x, y = np.searchsorted(found, low), np.searchsorted(found, low + n + width - 2, side="right") - 1
    digest = _join(_join(window[low], window[low + n - 1]), n.astype(_U))
    return trigger, digest, owner, low - offsets[owner], n, again[y] > again[x]


def _rows(a, b, doc, place, n, own=0) -> np.ndarray:
    out = np.empty(len(a), _ROW)
    for name, values in zip(_ROW.names, (a, b, doc, place, n, own)):
        out[name] = values
    return out


def _alone(keys: np.ndarray) -> np.ndarray:
    """Which of sorted keys differ from both neighbours."""
    new = np.ones(len(keys) + 1, bool)
    new[1:-1] = keys[1:] != keys[:-1]
    return new[1:] & new[:-1]


def _sorted(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in corpus order of equals, each place once, and which are the first of theirs."""
    rows = rows[np.argsort(rows["a"])]
    alone = _alone(rows["a"])
    some = rows[~alone]  # the full order matters among those only
    rows[~alone] = some[np.lexsort((some["place"], some["doc"], some["b"], some["a"]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows["a"][1:] != rows["a"][:-1]) | (rows["b"][1:] != rows["b"][:-1])
    fresh = first.copy()
    fresh[1:] |= (rows["doc"][1:] != rows["doc"][:-1]) | (rows["place"][1:] != rows["place"][:-1])
    return (rows, first) if fresh.all() else (rows[fresh], first[fresh])


def _merged(rows: np.ndarray) -> np.ndarray:
    """Marks of a text that follow each other without a gap, or overlap, as one."""
    if not len(rows):
        return rows
    rows = rows[np.lexsort((rows["place"], rows["doc"]))]
    end = rows["place"] + rows["n"]
    new = np.append(True, (rows["doc"][1:] != rows["doc"][:-1]) | (rows["place"][1:] > end[:-1]))
    begin = np.flatnonzero(new)
    out = rows[begin]
    out["n"] = np.maximum.reduceat(end, begin) - out["place"]
    return out


def _packed(rows: np.ndarray) -> bytes:
    """Rows column by column: places in order compress, hashes don't."""
    return b"".join(np.ascontiguousarray(rows[c]).tobytes() for c in _ROW.names)


def _unpacked(data: bytes) -> np.ndarray:
    n, out, at = len(data) // _ROW.itemsize, None, 0
    out = np.empty(n, _ROW)
    for name in _ROW.names:
        kind = _ROW[name]
        out[name] = np.frombuffer(data, kind, n, at)
        at += n * kind.itemsize
    return out


_SENT = "bucket int, kind tinyint, rows binary, text binary"
_PLAIN, _MARK, _CELL = range(3)


def _dealt(kind: int, rows: np.ndarray, by: np.ndarray, buckets: int, text: list | None = None) -> Iterator[pa.RecordBatch]:
    """Rows, and their bytes, as one record for each bucket."""
    if not len(rows):
        return
    bucket = (_join(by.astype(_U), np.zeros(len(by), _U)) % _U(buckets)).astype(np.int32)
    order = np.lexsort((rows["place"], rows["doc"], bucket))
    rows, bucket = rows[order], bucket[order]
    begin = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    end = np.append(begin[1:], len(rows))
    texts = [None] * len(begin) if text is None else [b"".join(text[k] for k in order[x:y].tolist()) for x, y in zip(begin, end)]
    yield pa.RecordBatch.from_pydict({
        "bucket": pa.array(bucket[begin], pa.int32()), "kind": pa.array([kind] * len(begin), pa.int8()),
        "rows": pa.array([_packed(rows[x:y]) for x, y in zip(begin, end)], pa.binary()), "text": pa.array(texts, pa.binary())})


def _send(rows: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """The first of equal rows dealt by their hash; the others, known repeats, as marks dealt by document."""
    rows, first = _sorted(rows)
    yield from _dealt(_PLAIN, rows[first], rows["a"][first], buckets)
    marks = _merged(rows[~first])
    yield from _dealt(_MARK, marks, marks["doc"], buckets)


_FOUND = "doc long, sub int, low int, n int, key long"


def _found(rows: np.ndarray, key: np.ndarray | None = None) -> pa.RecordBatch:
    keys = pa.nulls(len(rows), pa.int64()) if key is None else pa.array(key.view(np.int64))
    return pa.RecordBatch.from_pydict({
        "doc": rows["doc"], "sub": (rows["place"] >> 32).astype(np.int32), "low": (rows["place"] & 0xFFFFFFFF).astype(np.int32),
        "n": rows["n"], "key": keys})


def _received(batches: Iterator[pa.RecordBatch]) -> tuple[list[np.ndarray], list[np.ndarray], list[tuple[np.ndarray, bytes]]]:
    plain, marks, cells = [np.zeros(0, _ROW)], [np.zeros(0, _ROW)], []
    for batch in batches:
        for kind, data, text in zip(*(batch[c].to_pylist() for c in ("kind", "rows", "text"))):
            rows = _unpacked(data)
            cells.append((rows, text)) if kind == _CELL else (marks if kind == _MARK else plain).append(rows)
    return plain, marks, cells


def _settle_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Marks for all but the first of equal phrases, and, with their key, the first ones that may repeat windows
    of others (their trigger has other phrases) or of their own."""
    plain, marks, _ = _received(batches)
    rows, first = _sorted(np.concatenate(plain))
    yield _found(_merged(np.concatenate([*marks, rows[~first]])))
    rows = rows[first]
    more = np.zeros(len(rows), bool)
    more[1:] = rows["a"][1:] == rows["a"][:-1]
    more[:-1] |= more[1:]
    more |= rows["own"] > 0
    yield _found(rows[more], np.ascontiguousarray(rows["a"][more]))


def _settle_windows(size: int):
    """Marks for all but the first of equal windows, which come by themselves or in phrases."""

    def met(rows: np.ndarray, raw: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """The windows of phrases that meet others of their hash."""
        length = rows["n"] + size - 1
        ends = np.concatenate([[0], np.cumsum(length)])
        text = raw[np.arange(ends[-1]) + np.repeat(begin - ends[:-1], length)]
        at, owner = _windows(ends, size)
        window = Hashes(text).of(size)[at]
        order = np.argsort(window)
        some = order[~_alone(window[order])]
        window, owner, at = window[some], owner[some], at[some]
        return _rows(window, rows["a"][owner], rows["doc"][owner], rows["place"][owner] + at - ends[owner], np.ones(len(at)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, marks, cells = _received(batches)
        rows, first = _sorted(np.concatenate(plain))
        marks.append(rows[~first])
        if cells:
            rows, raw = np.concatenate([c[0] for c in cells]), np.frombuffer(b"".join(c[1] for c in cells), np.uint8)
            length = rows["n"].astype(np.int64) + size - 1
            begin = np.cumsum(length) - length
            order = np.argsort(rows["a"], kind="stable")  # equal windows have one trigger: a run of triggers at a time
            rows, begin = rows[order], begin[order]
            run_no = np.cumsum(rows["n"], dtype=np.int64) // HELD
            new = np.append(True, (rows["a"][1:] != rows["a"][:-1]))
            cuts = [*np.flatnonzero(new & (np.append(-1, run_no[np.flatnonzero(new)[np.cumsum(new)[:-1] - 1]]) != run_no)).tolist(), len(rows)]
            for x, y in zip(cuts, cuts[1:]):
                part, first = _sorted(met(rows[x:y], raw, begin[x:y]))
                marks.append(_merged(part[~first]))
        yield _found(_merged(np.concatenate(marks)))

    return run


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, sub, id, text): doc orders the texts (null ids first), sub numbers different texts of one id.

    Ids that occur once, as a rule all, have sub 0. The texts of others are numbered by their SHA-256, by
    range, so that an id which very many rows share (or lack) is not gathered; then the rows are stored with their numbers.
    """
    text = F.coalesce(text_col, F.lit(""))
    plain = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("doc"), F.col(id_col).cast("long").alias("id"), text.alias("text"))
    again = keep(plain.groupBy("doc").count().where("count > 1").select("doc", F.lit(True).alias("again")), "repeated-ids")
    if again.isEmpty():
        return plain.select("doc", F.lit(0).alias("sub"), "id", "text")
    marked = plain.join(again, "doc", "left").withColumn("digest", F.when(F.col("again"), F.sha2("text", 256)))
    subs = numbered(marked.where("again").select("doc", "digest").distinct(), ["doc"], ["digest"], "sub")
    return keep(marked.join(subs, ["doc", "digest"], "left").select(
        "doc", F.coalesce("sub", F.lit(0)).cast("int").alias("sub"), "id", "text"), "identified")


def _inside(low: np.ndarray, n: np.ndarray, size: int, length: np.ndarray) -> None:
    """A text is never cut or read by another one's places."""
    if (low + n + size - 1 > length).any():
        raise RuntimeError("places that a text doesn't have")


def _places(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch["doc"].to_numpy(), batch["sub"].to_numpy().astype(np.int64) << 32


def repeats(rows: DataFrame, size: int = 100, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc, sub, low, n): windows ``low`` to ``low + n - 1`` of a text of :func:`identified` also start earlier in the corpus.

    Stored in the shared folder; a window may be told of twice. See ``remove`` for the order of texts. A task settles one bucket
    of about ``bucket_bytes`` of text, so there are as many as the corpus needs; raise it with the memory of executors.
    """
    if size < 3:
        raise ValueError("size must be 3 at least")
    spark = rows.sparkSession
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_bytes))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in slices(batches, limit=HASHED):
            doc, sub = _places(batch)
            a, b, owner, low, count, own = phrases(*raw_bytes(batch["text"]), size)
            held.append(_rows(a, b, doc[owner], sub[owner] + low, count, own))
            n += len(a)
            if n > HELD:
                yield from _send(np.concatenate(held), buckets)
                held, n = [], 0
        if n:
            yield from _send(np.concatenate(held), buckets)

    parsed = rows.select("doc", "sub", "text").mapInArrow(parse, _SENT).repartitionById(buckets, "bucket")
    found = keep(parsed.mapInArrow(_settle_phrases, _FOUND), "phrases")

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, cells, texts, n_cells = [], 0, [], [], 0
        for batch in slices(batches, limit=HASHED):
            doc, sub = _places(batch)
            raw, offsets = raw_bytes(batch["text"])
            lists = batch["cells"]
            owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            inner = lists.flatten()
            low, count = (inner.field(c).to_numpy().astype(np.int64) for c in ("low", "n"))
            _inside(low, count, size, np.diff(offsets)[owner])
            key, hot = inner.field("key").to_numpy().view(_U), inner.field("hot").to_numpy(zero_copy_only=False)
            cold = np.flatnonzero(~hot)
            cells.append(_rows(key[cold], np.zeros(len(cold)), doc[owner[cold]], sub[owner[cold]] + low[cold], count[cold]))
            data, begin = memoryview(raw.tobytes()), offsets[owner[cold]] + low[cold]
            texts += [bytes(data[x:y]) for x, y in zip(begin.tolist(), (begin + count[cold] + size - 1).tolist())]
            n_cells += len(cold)
            if hot.any():
                low, count, owner = low[hot], count[hot], owner[hot]
                low, owner = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count), np.repeat(owner, count)
                hashes, at = Hashes(raw), offsets[owner] + low
                held.append(_rows(hashes.of(size)[at], hashes.check(size)[at], doc[owner], sub[owner] + low, np.ones(len(at))))
                n += len(at)
            if n > HELD:
                yield from _send(np.concatenate(held), buckets)
                held, n = [], 0
            if n_cells > HELD // 8:
                sent = np.concatenate(cells)
                yield from _dealt(_CELL, sent, sent["a"], buckets, texts)
                cells, texts, n_cells = [], [], 0
        if n:
            yield from _send(np.concatenate(held), buckets)
        if n_cells:
            sent = np.concatenate(cells)
            yield from _dealt(_CELL, sent, sent["a"], buckets, texts)

    edges = found.where("key IS NOT NULL")
    hot = keep(edges.groupBy("key").count().where(F.col("count") > HOT).select("key", F.lit(True).alias("hot")), "hot-triggers")
    cells = edges.join(hot, "key", "left").groupBy("doc", "sub").agg(F.collect_list(
        F.struct("low", "n", "key", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("cells"))
    opened = rows.select("doc", "sub", "text").join(cells, ["doc", "sub"]).mapInArrow(suffixes, _SENT).repartitionById(buckets, "bucket")
    more = keep(opened.mapInArrow(_settle_windows(size), _FOUND), "suffixes")
    return found.where("key IS NULL").unionByName(more).drop("key")


def remove(docs: DataFrame, size: int = 100, id_col: str = "doc_id", text_col: str = "text",
           bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): every text's UTF-8 bytes without those covered by a string of
    ``size`` bytes that also starts earlier.

    Earlier is a smaller id (null ids come first), or the same text at a smaller place. Of different
    texts with one id the order is that of a digest; rows with equal id and text are one text, and
    each gets its result. Matches never cross texts; null and empty texts, and those shorter
    than ``size``, lose nothing by themselves. Other columns are not looked at. ``kept`` is binary, as a cut may fall inside a character.
    """
    bounded_batches(docs.sparkSession)
    rows = identified(docs, id_col, text_col)
    marks = repeats(rows, size, bucket_bytes).groupBy("doc", "sub").agg(F.collect_list(F.struct("low", "n")).alias("marks"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept", pa.binary())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=HASHED):
            raw, offsets = raw_bytes(batch["text"])
            marks = batch["marks"]
            lists = np.diff(marks.offsets.to_numpy()) * marks.is_valid().to_numpy(zero_copy_only=False)
            inner = marks.flatten()
            owner = np.repeat(np.arange(batch.num_rows), lists)
            _inside(inner.field("low").to_numpy().astype(np.int64), inner.field("n").to_numpy(), size, np.diff(offsets)[owner])
            begin = offsets[owner] + inner.field("low").to_numpy()
            end = begin + inner.field("n").to_numpy() + size - 1
            depth = np.zeros(len(raw) + 1, np.int64)
            np.add.at(depth, begin, 1)
            np.add.at(depth, end, -1)
            gone = np.cumsum(depth[:-1]) > 0
            total = np.concatenate([[0], np.cumsum(gone)])
            fresh = gone.copy()
            fresh[1:] &= ~gone[:-1]
            texts = offsets[:-1][np.diff(offsets) > 0]
            fresh[texts] = gone[texts]
            spans = np.concatenate([[0], np.cumsum(fresh)])
            removed = total[offsets[1:]] - total[offsets[:-1]]
            ends = np.cumsum(np.diff(offsets) - removed)
            data = raw[~gone].tobytes()
            kept = [data[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]
            yield record(schema, batch["id"], np.diff(offsets), removed, spans[offsets[1:]] - spans[offsets[:-1]], kept)

    return rows.join(marks, ["doc", "sub"], "left").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
