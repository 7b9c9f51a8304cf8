"""Benchmark passages in training texts, found by spaced seeds and checked word by word.

A seed is the hash of the words under the ones of a fixed mask; words under
zeros may differ. Seeds of the benchmark and of the texts are rows that meet in a join, and
every hit is verified on its diagonal: a stretch of the item's words must agree
with the text's in most places, wherever the substitutions lie.

Texts are read once. Only the words around places whose seed may be one of the benchmark's (a Bloom
filter of bounded size says so; it saves shuffling and decides nothing) are stored. Seeds that the benchmark has in very
many places don't meet each other: there the whole stretch is looked up, by hashes of so many of its
words that any allowed substitutions leave one of them alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import bounded_batches, keep, record, slices
from .tokens import forget
from .words import Words, split_words

#: Words looked at have a one. Between them they find any stretch of seven words or more with one word in five replaced.
MASKS = ("11111", "111011", "1101101", "11010011")
#: For items of five and six words, one of which may be replaced; still shorter ones are looked up as they stand.
SHORT_MASKS = ("1111", "10111", "11011", "11101")
#: An item's stretch that must agree (all of a shorter item), and in which share of its words.
STRETCH, SHARE = 13, 0.8
#: Places of the benchmark from which on a seed is looked up by whole stretches.
HOT = 64
#: The filter has 64 bits a seed, and 2 to the power of this at most (64 MB): beyond that it lets more through.
FILTER_BITS = 29
_SHIFTS = (0, 17, 35)
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
#: Words whose hash a Python worker remembers.
REMEMBERED = 150_000
_MEMORY: dict[str, int] = {}


def word_hashes(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first): hashes of lower-cased words without marks around them, the places of
    those that have anything left, and the texts' n + 1 offsets in them."""
    if len(_MEMORY) > REMEMBERED:
        _MEMORY.clear()
    known = _MEMORY
    for w in words.distinct:
        if w not in known:
            core = _EDGE.sub("", w.lower())
            known[w] = (xxhash.xxh64_intdigest(core.encode()) | 1) if core else 0
    by_word = np.fromiter((known[w] for w in words.distinct), np.uint64, len(words.distinct))
    hashes = by_word[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    place = np.flatnonzero(hashes)
    return hashes[place], place, np.searchsorted(place, words.first)


def _mix(value: np.ndarray, word: np.ndarray) -> np.ndarray:
    value = (value ^ word) * np.uint64(0x9E3779B97F4A7C15)
    return value ^ value >> np.uint64(29)


def seeds(hashes: np.ndarray, first: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a whole mask fits into one text, and the seed there."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    value = np.full(n, int(mask, 2), np.uint64)
    for k, used in enumerate(mask):
        if used == "1":
            value = _mix(value, hashes[k:k + n])
    inside = np.ones(n, bool)
    for k in range(1, len(mask)):  # a mask may not reach over the end of a text
        ends = first[1:] - k
        inside[ends[(ends >= 0) & (ends < n)]] = False
    at = np.flatnonzero(inside)
    return at, value[at]


def masks_for(n: int) -> tuple[str, ...]:
    """The masks that find every stretch of an item of ``n`` words that agrees."""
    return MASKS if n >= 7 else SHORT_MASKS if n >= 5 else ("1" * n,)


def _replaced(size: int) -> int:
    """Words of a stretch that may differ."""
    return size - ceil(SHARE * size - 1e-9)


def window_keys(hashes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Keys of the stretches of ``size`` words that begin at ``at``, one row each: two stretches that agree share one.

    A stretch is cut into blocks, so many that replaced words leave enough of them alone; a key is a choice of whole blocks.
    """
    k = _replaced(size)
    blocks = np.array_split(np.arange(size), 2 * k + 1)
    keys = []
    for number, left in enumerate(combinations(blocks, k + 1)):
        value = np.full(len(at), size << 16 | number, np.uint64)
        for j in np.concatenate(left):
            value = _mix(value, hashes[at + j])
        keys.append(value)
    return np.column_stack(keys)


def _rows(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers of all ranges low to high, one after the other."""
    size = high - low
    return np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and its n + 1 offsets in them."""
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(), offsets - offsets[0]


def _numbers(start: int, count: int) -> pa.Array:
    """Numbers of a task's rows that no other task gives (once stored they stay)."""
    return pa.array((TaskContext.get().partitionId() << 33) + np.arange(start, start + count))


def _items(benchmark: DataFrame, id_col: str, text_col: str, least_words: int) -> DataFrame:
    """(item, item_id, n, words): one row an item of ``least_words`` words or more, by a number of its own."""
    kind = benchmark.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in slices(batches):
            hashes, _, first = word_hashes(split_words(batch))
            sizes = np.diff(first)
            schema = pa.schema([("item", pa.int64()), ("item_id", batch["id"].type), ("n", pa.int32()), ("words", pa.list_(pa.int64()))])
            out = record(schema, _numbers(done, batch.num_rows), batch["id"], pa.array(sizes, pa.int32()), _lists(hashes.view(np.int64), sizes, pa.int64()))
            done += batch.num_rows
            yield out.filter(pa.array(sizes >= max(1, least_words)))

    rows = benchmark.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return keep(rows.mapInArrow(run, f"item long, item_id {kind}, n int, words array<bigint>"), "benchmark-items")


def _item_seeds(items: DataFrame) -> DataFrame:
    """(seed, item, place) of all items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("seed", pa.int64()), ("item", pa.int64()), ("place", pa.int32())])
        for batch in batches:
            words, first = _flat(batch["words"])
            words, item, n = words.view(np.uint64), batch["item"].to_numpy(), np.diff(first)
            classes = [masks_for(int(k)) for k in np.unique(np.minimum(n, 7))]
            for mask in sorted({m for c in classes for m in c}):
                at, value = seeds(words, first, mask)
                owner = np.searchsorted(first, at, side="right") - 1
                wanted = np.array([mask in masks_for(k) for k in range(8)])[np.minimum(n, 7)][owner]
                at, value, owner = at[wanted], value[wanted], owner[wanted]
                yield record(schema, pa.array(value.view(np.int64)), pa.array(item[owner]), pa.array((at - first[owner]).astype(np.int32)))

    return keep(items.mapInArrow(run, "seed long, item long, place int"), "benchmark-seeds")


def _filter(seed_rows: DataFrame) -> tuple[int, bytes]:
    """(bits, bitmap): a Bloom filter of the seeds, put together by Spark from bitmaps of 4 KB."""
    bits = min(FILTER_BITS, max(18, (64 * seed_rows.count()).bit_length()))
    places = [F.shiftrightunsigned("seed", s).bitwiseAND(F.lit((1 << bits) - 1)) + 1 for s in _SHIFTS]
    parts = seed_rows.select(F.explode(F.array(*places)).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).collect()
    whole = bytearray((1 << bits) >> 3)
    for r in parts:
        whole[(r["b"] - 1) * 4096:r["b"] * 4096] = r["m"]
    return bits, bytes(whole)


def _segments(rows: DataFrame, masks: list[str], bits: int, bitmap: bytes) -> DataFrame:
    """(row, id, segment, words, starts, ends, seeds, at): the words around places of (id, text) with a seed that passes the filter.

    A stretch that holds such a place lies wholly in one segment; segments of a text don't overlap.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)  # 64 MB at most (FILTER_BITS)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        known = np.frombuffer(shared.value, np.uint8)
        below = np.uint64((1 << bits) - 1)
        row = done = 0
        for batch in slices(batches):
            words = split_words(batch)
            hashes, place, first = word_hashes(words)
            found = []
            for mask in masks:
                at, value = seeds(hashes, first, mask)
                for s in _SHIFTS:
                    p = value >> np.uint64(s) & below
                    may = known[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8) & 1 == 1
                    at, value = at[may], value[may]
                found.append((at, value))
            at, value = (np.concatenate(x) for x in zip(*found))
            number = _numbers(row, batch.num_rows)
            row += batch.num_rows
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            at, value = at[order], value[order]
            text = np.searchsorted(first, at, side="right") - 1
            low, high = np.maximum(first[text], at - STRETCH + 1), np.minimum(first[text + 1], at + STRETCH)
            new = np.concatenate([[True], (text[1:] != text[:-1]) | (low[1:] > high[:-1])])
            begin, begins = np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), len(at)))
            owner, low = text[begin], low[begin]
            high = high[begin + begins - 1]
            inside = _rows(low, high)
            whose = np.repeat(owner, high - low)
            schema = pa.schema([("row", pa.int64()), ("id", batch["id"].type), ("segment", pa.int64()), ("words", pa.list_(pa.int64())),
                                ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("seeds", pa.list_(pa.int64())), ("at", pa.list_(pa.int32()))])
            yield record(schema, number.take(pa.array(owner)), batch["id"].take(pa.array(owner)), _numbers(done, len(owner)),
                         _lists(hashes[inside].view(np.int64), high - low, pa.int64()),
                         _lists(words.points(words.start[place[inside]], whose), high - low, pa.int64()),
                         _lists(words.points(words.end[place[inside]], whose), high - low, pa.int64()),
                         _lists(value.view(np.int64), begins, pa.int64()),
                         _lists((at - np.repeat(low, begins)).astype(np.int32), begins, pa.int32()))
            done += len(owner)

    return keep(rows.mapInArrow(run, f"row long, id {kind}, segment long, words array<bigint>, starts array<bigint>, "
                                     "ends array<bigint>, seeds array<bigint>, at array<int>"), "benchmark-segments")


def _stretches(places: DataFrame, name: str, sizes: list[int] | None) -> DataFrame:
    """(key, name, start) of all stretches over the places ``at`` of ``words``: of the given sizes, or as long as the item allows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), (name, pa.int64()), ("start", pa.int32())])
        for batch in batches:
            words, first = _flat(batch["words"])
            at, hits = _flat(batch["at"])
            owner = np.repeat(np.arange(batch.num_rows), np.diff(hits))
            words, owners = words.view(np.uint64), batch[name].to_numpy()
            n = np.diff(first)
            for size in sizes or np.unique(np.minimum(n, STRETCH)).tolist():
                mine = np.ones(len(at), bool) if sizes else np.minimum(n, STRETCH)[owner] == size
                starts = (first[owner[mine]] + at[mine])[:, None] - np.arange(size)
                fits = (starts >= first[owner[mine]][:, None]) & (starts + size <= first[owner[mine] + 1][:, None])
                starts = np.unique(starts[fits])
                whose = np.searchsorted(first, starts, side="right") - 1
                for keys in window_keys(words, starts, size).T:
                    yield record(schema, pa.array(np.ascontiguousarray(keys).view(np.int64)), pa.array(owners[whose]), pa.array((starts - first[whose]).astype(np.int32)))

    return places.select(name, "words", "at").mapInArrow(run, f"key long, {name} long, start int")


def _candidates(items: DataFrame, seed_rows: DataFrame, segments: DataFrame) -> DataFrame:
    """(segment, item, shift): diagonals on which a segment and an item have a seed in common (in one of few places), or a key of a stretch."""
    hits = segments.select("segment", F.explode(F.arrays_zip("seeds", "at")).alias("h")).select("segment", F.col("h.seeds").alias("seed"), "h.at")
    hot = keep(seed_rows.groupBy("seed").count().where(F.col("count") > HOT).select("seed"), "benchmark-hot")
    if hot.isEmpty():
        return hits.join(seed_rows, "seed").select("segment", "item", (F.col("at") - F.col("place")).alias("shift")).distinct()
    few = hits.join(seed_rows.join(hot, "seed", "left_anti"), "seed").select("segment", "item", (F.col("at") - F.col("place")).alias("shift"))
    theirs = seed_rows.join(hot, "seed", "left_semi").groupBy("item").agg(F.collect_set("place").alias("at")).join(items, "item")
    sizes = [r[0] for r in theirs.select(F.least("n", F.lit(STRETCH))).distinct().collect()]  # STRETCH at most
    ours = hits.join(hot, "seed", "left_semi").groupBy("segment").agg(F.collect_set("at").alias("at")).join(segments.select("segment", "words"), "segment")
    whole = _stretches(ours, "segment", sizes).withColumnRenamed("start", "there").join(_stretches(theirs, "item", None), "key")
    return few.union(whole.select("segment", "item", (F.col("there") - F.col("start")).alias("shift"))).distinct()


def _verified(pairs: DataFrame, id_type: str, item_type: str) -> DataFrame:
    """(row, id, item, item_id, start, end, n_words, n_agreeing) of the candidates that have a stretch that agrees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            text, first = _flat(batch["words"])
            item, of = _flat(batch["item_words"])
            starts, ends = batch["starts"].flatten().to_numpy(), batch["ends"].flatten().to_numpy()
            shift, n = batch["shift"].to_numpy().astype(np.int64), np.diff(of)
            a, b = np.maximum(0, -shift), np.minimum(n, np.diff(first) - shift)
            b = np.maximum(a, b)
            size = np.minimum(n, STRETCH)
            theirs = _rows(of[:-1] + a, of[:-1] + b)
            same = item[theirs] == text[theirs + np.repeat(first[:-1] + shift - of[:-1], b - a)]
            total = np.concatenate([[0], np.cumsum(same)])
            base = np.concatenate([[0], np.cumsum(b - a)])[:-1]
            count = np.maximum(0, b - a - size + 1)  # stretches of each diagonal
            at, owner = _rows(base, base + count), np.repeat(np.arange(batch.num_rows), count)
            good = total[at + size[owner]] - total[at] >= SHARE * size[owner] - 1e-9
            at, owner = at[good], owner[good]
            one, where = np.unique(owner, return_index=True)
            if not len(one):
                continue
            last = at[np.append(where[1:], len(at)) - 1] + size[one]
            begin = at[where]
            low, high = (first[:-1] + shift + a - base)[one] + begin, (first[:-1] + shift + a - base)[one] + last
            taken = pa.array(one)
            schema = pa.schema([("row", pa.int64()), ("id", batch["id"].type), ("item", pa.int64()), ("item_id", batch["item_id"].type),
                                ("start", pa.int64()), ("end", pa.int64()), ("n_words", pa.int64()), ("n_agreeing", pa.int64())])
            yield record(schema, *[batch[c].take(taken) for c in ("row", "id", "item", "item_id")], pa.array(starts[low]), pa.array(ends[high - 1]),
                         pa.array(high - low), pa.array(total[last] - total[begin]))

    return pairs.mapInArrow(run, f"row long, id {id_type}, item long, item_id {item_type}, start long, end long, n_words long, n_agreeing long")


def _matches(rows: DataFrame, benchmark: DataFrame, item_col: str, item_text: str, least_words: int) -> DataFrame:
    """What ``_verified`` says of the rows (id, text)."""
    bounded_batches(rows.sparkSession)
    items = _items(benchmark, item_col, item_text, least_words)
    seed_rows = _item_seeds(items)
    lengths = [r[0] for r in items.select(F.least("n", F.lit(7))).distinct().collect()]  # seven at most
    masks = sorted({m for n in lengths for m in masks_for(n)}) or list(MASKS)
    segments = _segments(rows, masks, *_filter(seed_rows))
    found = _candidates(items, seed_rows, segments)
    pairs = found.join(segments.select("row", "id", "segment", "words", "starts", "ends"), "segment") \
        .join(items.select("item", "item_id", F.col("words").alias("item_words")), "item")
    return _verified(pairs, rows.schema["id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString())


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text: str = "text", least_words: int = 5) -> DataFrame:
    """(doc_id, item_id, start, end, n_words, n_agreeing): the passages of ``benchmark`` in ``docs``.

    One row for each text and item with a stretch of STRETCH words (all of a
    shorter item) that agree in SHARE of their places; start and end are code points of the
    whole range of such stretches, of the passage with most agreeing words (the first of equals)
    where they lie apart. Case and marks around words don't count. Null
    and empty texts and items, and items of fewer than ``least_words`` words, match nothing. Repeated
    rows and items give repeated results; other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    best = F.max(F.struct("n_agreeing", (-F.col("start")).alias("before"), "end", "n_words", "id", "item_id")).alias("m")
    return _matches(rows, benchmark, item_col, item_text, least_words).groupBy("row", "item").agg(best).select(
        F.col("m.id").alias("doc_id"), F.col("m.item_id").alias("item_id"), (-F.col("m.before")).alias("start"), "m.end", "m.n_words", "m.n_agreeing")


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
           item_text: str = "text", least_words: int = 5) -> DataFrame:
    """The rows of ``docs`` without any passage of ``benchmark``, as ``find`` defines it.

    Texts with a passage are known by their MD5; that table is stored, so its size is known when the rows meet it.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = F.coalesce(f"c{names.index(text_col)}", F.lit(""))
    rows = plain.select(F.md5(text).alias("id"), text.alias("text"))
    gone = keep(_matches(rows, benchmark, item_col, item_text, least_words).select(F.col("id").alias("digest")).distinct(), "benchmark-texts")
    return plain.join(gone, F.md5(text) == F.col("digest"), "left_anti").toDF(*names)
