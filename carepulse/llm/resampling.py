"""Importance resampling towards a target: hashed word features, head-tail vocabulary."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batches import bounded_batches, keep, slices, texts
from .words import Words, split_words

#: Words and pairs of the head, and bytes of a head word: together under a megabyte to broadcast.
HEAD_WORDS, HEAD_PAIRS, HEAD_BYTES = 10_000, 20_000, 32
#: Times as many counters as a task keeps while it looks for the head.
COUNTERS = 8

_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[65:91] += 32
_BETWEEN = np.ones(256, bool)
_BETWEEN[48:58] = _BETWEEN[97:123] = _BETWEEN[128:] = False


@dataclass
class Head:
    """Frequent words with the CRC-32 after them, and frequent pairs with their CRC-32."""

    words: dict[bytes, int] = field(default_factory=dict)  #: word to its number
    states: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))  #: by number
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  #: sorted; first number * words + second
    pair_states: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))


def _split(batch: pa.RecordBatch) -> tuple[Words, list[bytes]]:
    """Lower-cased words of letters, digits and all that isn't ASCII."""
    found = split_words(batch, between=_BETWEEN, letters=_LETTERS)
    return found, [w.encode() for w in found.distinct]


def _kept(counts: dict, most: int) -> dict:
    """Misra-Gries: what the key in place ``most`` / 2 has is taken from all, and who has nothing left goes."""
    if len(counts) <= most:
        return counts
    less = int(np.partition(np.fromiter(counts.values(), np.int64, len(counts)), -(most // 2))[-(most // 2)])
    return {k: n - less for k, n in counts.items() if n > less}


def _numbers(found: Words, distinct: list[bytes], head: Head) -> np.ndarray:
    """Each word's number in the head, or -1."""
    return np.array([head.words.get(w, -1) for w in distinct], np.int64)[found.codes] if distinct else np.zeros(0, np.int64)


def _follows(found: Words, n: int) -> np.ndarray:
    """Places of words that have n - 1 more behind them in the same text."""
    starts = np.arange(max(0, len(found.codes) - n + 1))
    owner = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
    return starts[owner[starts] == owner[starts + n - 1]] if len(starts) else starts


def _frequent(docs: DataFrame, count, kind: str, most: int) -> list:
    """The ``most`` keys of the largest counts over all rows; each task keeps a bounded number of counters,
    so that no key with more than a share of 1 / (``most`` * COUNTERS / 2) in its task is lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict = {}
        for batch in slices(batches):
            for key, n in count(batch):
                counts[key] = counts.get(key, 0) + n
            counts = _kept(counts, most * COUNTERS)
        if counts:
            yield pa.RecordBatch.from_pydict({"key": pa.array(counts, pa.binary() if kind == "binary" else pa.int64()),
                                              "n": pa.array(counts.values(), pa.int64())})

    sums = docs.mapInArrow(run, f"key {kind}, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return [r["key"] for r in sums.orderBy(F.desc("n"), "key").limit(most).collect()]


def head(docs: DataFrame, longest: int, words: int = HEAD_WORDS, pairs: int = HEAD_PAIRS) -> Head:
    """The head of the texts in column ``text``: at most so many words (of HEAD_BYTES at most) and pairs of them.

    It only saves work: a feature has the same bucket in the head and in the tail. The
    driver gets ``words`` + ``pairs`` rows at most, whatever the corpus.
    """

    def of_words(batch: pa.RecordBatch):
        found, distinct = _split(batch)
        return [(w, int(n)) for w, n in zip(distinct, np.bincount(found.codes, minlength=len(distinct))) if len(w) <= HEAD_BYTES]

    chosen = [bytes(w) for w in _frequent(docs, of_words, "binary", words)] if words else []
    out = Head({w: k for k, w in enumerate(chosen)}, np.array([zlib.crc32(w) for w in chosen], np.uint32))
    if longest < 2 or not chosen or not pairs:
        return out

    def of_pairs(batch: pa.RecordBatch):
        found, distinct = _split(batch)
        at, number = _follows(found, 2), _numbers(found, distinct, out)
        at = at[(number[at] >= 0) & (number[at + 1] >= 0)]
        keys, n = np.unique(number[at] * len(chosen) + number[at + 1], return_counts=True)
        return zip(keys.tolist(), n.tolist())

    out.pairs = np.sort(np.array(_frequent(docs, of_pairs, "long", pairs), np.int64))
    out.pair_states = np.array([zlib.crc32(b" " + chosen[k % len(chosen)], int(out.states[k // len(chosen)])) for k in out.pairs.tolist()], np.uint32)
    return out


def hashes(found: Words, distinct: list[bytes], longest: int, head: Head) -> tuple[np.ndarray, np.ndarray]:
    """(text, CRC-32) of all runs of 1 to ``longest`` words, words joined by one space, repeats included.

    Head words and pairs take the stored value; a longer or rarer run goes on from the state of
    its first words, once for each distinct run of the batch.
    """
    owner = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
    states = np.array([head.states[k] if (k := head.words.get(w, -1)) >= 0 else zlib.crc32(w) for w in distinct], np.uint32)
    owners, out = [owner], [states[found.codes] if distinct else np.zeros(0, np.uint32)]
    runs, count = found.codes.astype(np.int64), len(distinct)  # the run that begins at each word, by number
    for n in range(2, longest + 1):
        at = _follows(found, n)
        if not len(at):
            break
        pair, place = np.unique(runs[at] * len(distinct) + found.codes[at + n - 1], return_inverse=True)
        before, last = pair // len(distinct), pair % len(distinct)
        new, open_ = np.zeros(len(pair), np.uint32), np.ones(len(pair), bool)
        if n == 2 and len(head.pairs):
            number = np.array([head.words.get(w, -1) for w in distinct], np.int64)
            key = np.where((number[before] >= 0) & (number[last] >= 0), number[before] * len(head.words) + number[last], -1)
            near = np.minimum(np.searchsorted(head.pairs, key), len(head.pairs) - 1)
            open_ = head.pairs[near] != key
            new[~open_] = head.pair_states[near[~open_]]
        for k in np.flatnonzero(open_).tolist():
            new[k] = zlib.crc32(b" " + distinct[last[k]], int(states[before[k]]))
        owners.append(owner[at])
        out.append(new[place])
        runs = np.zeros(len(found.codes), np.int64)
        runs[at] = place
        states, count = new, len(pair)
    return np.concatenate(owners), np.concatenate(out)


def features(docs: DataFrame, longest: int, buckets: int, known: Head) -> DataFrame:
    """(id, row, n_words, n_features, buckets) of every row of (id, text); ``buckets`` packs the bucket
    of every feature into two or four bytes."""
    cell = np.uint16 if buckets <= 1 << 16 else np.uint32
    held = docs.sparkSession.sparkContext.broadcast(known)  # under a megabyte, see HEAD_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            found, distinct = _split(batch)
            owner, crc = hashes(found, distinct, longest, held.value)
            cells = (crc % np.uint32(buckets)).astype(cell)[np.argsort(owner, kind="stable")]
            count = np.bincount(owner, minlength=batch.num_rows)
            ends = np.concatenate([[0], np.cumsum(count)]) * cells.itemsize
            packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(cells)])
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array(np.arange(k, k + batch.num_rows) + (part << 40)), pa.array(np.diff(found.first).astype(np.int64)),
                 pa.array(count.astype(np.int64)), packed.cast(pa.binary())], ["id", "row", "n_words", "n_features", "buckets"])
            k += batch.num_rows

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, row long, n_words long, n_features long, buckets binary")


def _cells(batch: pa.RecordBatch, buckets: int) -> np.ndarray:
    column = batch["buckets"].cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    if offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint16)
    return np.frombuffer(column.buffers()[2].slice(offsets[0], offsets[-1] - offsets[0]), np.uint16 if buckets <= 1 << 16 else np.uint32)


def totals(found: DataFrame, buckets: int) -> np.ndarray:
    """Exact number of features in each bucket: each task sends one row a bucket, and so does the driver get them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            sums += np.bincount(_cells(batch, buckets), minlength=buckets)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    table = found.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out[table["bucket"].to_numpy()] = table["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed share of each bucket in the target over that in the source."""
    s, t, n = source.astype(float), target.astype(float), len(source)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weights(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """(id, row, n_words, n_features, weight): the floored mean gain of a row's features, 0 without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch["n_features"].to_numpy()
            sums = np.concatenate([[0], np.cumsum(gain[_cells(batch, len(gain))])])
            ends = np.concatenate([[0], np.cumsum(n)])
            weight = (sums[ends[1:]] - sums[ends[:-1]]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["row"], batch["n_words"], batch["n_features"], pa.array(weight)],
                                             ["id", "row", "n_words", "n_features", "weight"])

    kind = found.schema["id"].dataType.simpleString()
    return found.mapInArrow(run, f"id {kind}, row long, n_words long, n_features long, weight long")


def noise(id_col: str, seed: int) -> Column:
    """floor(1000 x) of a Gumbel number x that hangs on seed and id alone; a null id counts as an empty one."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def ranked(rows: DataFrame, wanted: int) -> DataFrame:
    """``rows`` (id, row, score, may) with a column rank: 1 to ``wanted`` for the highest scores among those that
    ``may``, ties to the smaller id (null first), then the earlier row; null for all others.

    Scores are integers in a bounded range, so the number of rows of each is a small table that
    tells which score the last drawn row has. Only rows from that score on are sorted, by range, and numbered.
    """
    counts = sorted(((r["score"], r["n"]) for r in rows.where("may").groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    before, cut = 0, None
    for score, n in counts:
        if before >= wanted:
            break
        before, cut = before + n, score
    none = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return rows.select("*", none)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(k, k + n))],
                                             [*batch.schema.names, "_part", "_k"])
            k += n

    high = F.col("may") & (F.col("score") >= cut)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    order = (F.desc("score"), F.col("id").asc_nulls_first(), F.col("row"))
    top = keep(rows.where(high).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, f"{schema}, _part int, _k long"), "ranked")
    parts = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = top.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each partition
    starts = keep(sizes.select("_part", F.coalesce(F.sum("_n").over(parts), F.lit(0)).alias("_start")), "starts")
    rank = F.col("_start") + F.col("_k") + 1
    numbered = top.join(starts, "_part").select(*rows.columns, F.when(rank <= wanted, rank).alias("rank"))
    return numbered.unionByName(rows.where(~high).select("*", none))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             longest: int = 1, buckets: int = 10_000, seed: int = 2024, percent: int = 10, least_words: int = 20,
             head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """(``id_col``, n_features, weight, score, rank) of every row.

    Features are runs of 1 to ``longest`` lower-cased words, hashed by CRC-32 into ``buckets``. The gain of a bucket compares its
    share among all features of ``target`` with that among all of ``docs``; ``weight`` is the mean gain of a row's features. The score adds
    Gumbel noise drawn from seed and id, so the highest scores are a sample without replacement. Of the N rows with ``least_words`` words
    the floor(``percent`` N / 100) highest have a rank.

    A null text has no words: no features, weight 0, no rank. Empty texts likewise. A null id counts as an empty one for the noise and
    comes first among ties. Repeated rows are rows of their own; of wholly tied ones the earlier row goes first.
    Empty tables give no rows, or gains from the smoothing alone. Other columns are not looked at.

    All texts are read twice, once for the head of the vocabulary and once for the features, whose buckets are stored in two bytes each.
    """
    bounded_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    wanted = target.select(F.lit(0).alias("id"), F.coalesce(F.col(target_col), F.lit("")).alias("text"))
    known = head(source.select("text"), longest, head_words, head_pairs)
    found = keep(features(source, longest, buckets, known), "features")
    gain = gains(totals(found, buckets), totals(features(wanted, longest, buckets, known), buckets))
    may = F.col("n_words") >= least_words
    scored = keep(weights(found, gain).withColumns({"score": F.col("weight") + noise("id", seed), "may": may}), "scores")
    n = scored.where("may").count()
    out = ranked(scored.drop("n_words"), n * percent // 100)
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
