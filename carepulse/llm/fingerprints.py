"""Fingerprints of text versions: invertible Bloom lookup sketches of their paragraphs.

A paragraph is a line, cut after every WORDS words if it is longer. Its digest
(with the number of its earlier repeats in the text) goes into three cells, one in each
third of the sketch; a cell holds the count, the sum of the digests and the sum of
check values. Cells of two versions subtract; what both have cancels. A cell
left with one digest gives it away; taking that one out of its other cells bares
more, until nothing is left and all differing paragraphs are known. If the
sketch is too small for that, both versions are sketched again four times larger.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import bounded_batches, record, slices

#: Words of a paragraph, cells of the fingerprint itself, growth on failure and tries before a plain comparison.
WORDS, CELLS, GROWTH, TRIES = 8, 24, 4, 16
_U = np.uint64


def _mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser: all bits of the input reach all bits of the output."""
    x = x + _U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2 ** 64 - 1))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def paragraphs(text: str, words: int = WORDS) -> list[int]:
    """Digests of a text's paragraphs; white space within a paragraph counts as one blank."""
    digest, out = xxhash.xxh64_intdigest, []
    for line in text.split("\n"):
        parts = line.split()
        if len(parts) <= words:
            if parts:
                out.append(digest(" ".join(parts)))
        else:
            out += [digest(" ".join(parts[k:k + words])) for k in range(0, len(parts), words)]
    return out


def _check(keys: np.ndarray) -> np.ndarray:
    return _mix(keys, 99) >> _U(32)


class Versions:
    """Paragraph keys of many texts; a repeated paragraph has another key each time."""

    def __init__(self, lists: list[list[int]]):
        self.count = np.fromiter(map(len, lists), np.int64, len(lists))
        digests = np.fromiter((d for x in lists for d in x), _U, int(self.count.sum()))
        owner = np.repeat(np.arange(len(lists)), self.count)
        order = np.lexsort((digests, owner))
        same = np.zeros(len(order), bool)
        same[1:] = (digests[order][1:] == digests[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        begin = np.flatnonzero(~same)
        rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
        repeat = np.empty(len(order), np.int64)
        repeat[order] = rank
        self.keys, self.owner = np.where(repeat == 0, digests, _mix(digests, 7) + repeat.astype(_U)), owner

    def of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, owner) of the texts with these numbers, owners counted anew from 0; a text may be asked for twice."""
        first = np.concatenate([[0], np.cumsum(self.count)])
        n = self.count[which]
        at = np.repeat(first[which] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return self.keys[at], np.repeat(np.arange(len(which)), n)


class Sketches:
    """``n`` sketches of ``cells`` cells each."""

    def __init__(self, n: int, cells: int):
        self.n, self.cells = n, cells
        self.count, self.keys, self.checks = np.zeros(n * cells, np.int64), np.zeros(n * cells, _U), np.zeros(n * cells, _U)

    def add(self, keys: np.ndarray, owner: np.ndarray, sign) -> None:
        """``sign``: 1 or -1, for all keys or for each."""
        third = self.cells // 3
        unsigned = np.where(np.asarray(sign) > 0, _U(1), _U(2 ** 64 - 1))
        key_part, check_part = keys * unsigned, _check(keys) * unsigned
        for j in range(3):
            at = owner * self.cells + j * third + (_mix(keys, 3 * self.cells + j) % _U(third)).astype(np.int64)
            np.add.at(self.count, at, sign)
            np.add.at(self.keys, at, key_part)
            np.add.at(self.checks, at, check_part)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(keys, owner, sign, whole): what could be recovered, and the sketches of which all was."""
        found = []
        look = np.flatnonzero(np.abs(self.count) == 1)
        while len(look):
            sign = self.count[look]
            unsigned = np.where(sign > 0, _U(1), _U(2 ** 64 - 1))
            keys = self.keys[look] * unsigned
            pure = _check(keys) == self.checks[look] * unsigned
            keys, owner, sign = keys[pure], look[pure] // self.cells, sign[pure]
            if not len(keys):
                break
            order = np.lexsort((keys, owner))
            keys, owner, sign = keys[order], owner[order], sign[order]
            new = np.append(True, (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1]))
            keys, owner, sign = keys[new], owner[new], sign[new]
            found.append((keys, owner, sign))
            self.add(keys, owner, -sign)
            look = np.flatnonzero(np.abs(self.count) == 1)
        whole = ~((self.count != 0) | (self.keys != 0) | (self.checks != 0)).reshape(self.n, -1).any(1)
        keys, owner, sign = (np.concatenate(x) for x in zip(*found)) if found else \
            (np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64))
        return keys, owner, sign, whole

    def texts(self) -> list[str]:
        """Each sketch as text: all counts (int32), digest sums (uint64) and check sums (uint64), in base64."""
        raw = np.zeros(len(self.count), np.dtype([("n", "<i4"), ("k", "<u8"), ("c", "<u8")]))
        raw["n"], raw["k"], raw["c"] = self.count, self.keys, self.checks
        data, size = raw.tobytes(), self.cells * raw.itemsize
        return [base64.b64encode(data[i * size:(i + 1) * size]).decode() for i in range(self.n)]


def sketch(versions: Versions, which: np.ndarray, cells: int = CELLS) -> Sketches:
    out = Sketches(len(which), cells)
    out.add(*versions.of(which), 1)
    return out


def differences(a: Versions, ia: np.ndarray, b: Versions, ib: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, pair, sign) of the paragraphs that only one text of a pair has: sign 1 those of ``a``."""
    out, cells, left = [], CELLS, np.arange(len(ia))
    for _ in range(TRIES):
        if not len(left):
            break
        part = Sketches(len(left), cells)
        part.add(*a.of(ia[left]), 1)
        part.add(*b.of(ib[left]), -1)
        keys, owner, sign, whole = part.peel()
        good = whole[owner]
        out.append((keys[good], left[owner[good]], sign[good]))
        left, cells = left[~whole], cells * GROWTH
    for p in left.tolist():
        x, y = (set(v.of(np.array([i[p]]))[0].tolist()) for v, i in ((a, ia), (b, ib)))
        for rest, sign in ((x - y, 1), (y - x, -1)):
            out.append((np.array(sorted(rest), _U), np.full(len(rest), p), np.full(len(rest), sign)))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, _U), left, left)


def likeness(a: Versions, ia: np.ndarray, b: Versions, ib: np.ndarray) -> np.ndarray:
    """Common paragraphs over all paragraphs of each pair; 1 for two texts without any."""
    _, pair, _ = differences(a, ia, b, ib)
    apart = np.bincount(pair, minlength=len(ia))
    total = a.count[ia] + b.count[ib]
    return np.where(total + apart > 0, (total - apart) / np.maximum(1, total + apart), 1.0)


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of the following one."""
    k = len(text) // 2
    return text[:len(text) - k] + following[:k]


_LOWEST = -(1 << 63)


def successors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, tail, block) with the rows in blocks, each sorted by descending id and followed by a
    ``tail`` row: the first of the next block, or of all after the last. One shuffle of the texts.

    Blocks are cut at quantiles of the ids (null ids come last), three for every
    shuffle partition; equal ids are ordered by a digest of their text.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LOWEST)).alias("key"),
                       F.coalesce(text_col, F.lit("")).alias("text"))
    n = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = rows.agg(F.percentile_approx("key", [k / n for k in range(1, n)], 10 * n)).first()[0] or []
    cuts = np.unique(np.array(cuts, np.int64))

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch["key"].to_numpy()
            if len(key):
                block = np.searchsorted(cuts, key)
                order = np.lexsort((key, block))
                last = np.append(np.flatnonzero(np.diff(block[order])), len(order) - 1)
                yield pa.RecordBatch.from_pydict({"block": pa.array(block[order][last], pa.int32()), "key": key[order][last]})

    top = {r[0]: r[1] for r in rows.select("key").mapInArrow(tops, "block int, key long").groupBy("block").agg(F.max("key")).collect()}
    order = sorted(top)
    follows = {top[order[i - 1]]: b for i, b in enumerate(order)}  # the lowest block is followed by the highest
    marks = np.array(sorted(follows), np.int64)
    targets = np.array([follows[k] for k in marks.tolist()], np.int32)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch["key"].to_numpy()
            at = np.minimum(np.searchsorted(marks, key), len(marks) - 1)
            again = np.flatnonzero(marks[at] == key)
            take = pa.array(np.concatenate([np.arange(len(key)), again]))
            block = np.concatenate([np.searchsorted(cuts, key), targets[at[again]]]).astype(np.int32)
            tail = np.arange(len(block)) >= len(key)
            yield pa.RecordBatch.from_arrays([*[batch[c].take(take) for c in ("id", "key", "text", "digest")],
                                              pa.array(block), pa.array(tail)], ["id", "key", "text", "digest", "block", "tail"])

    dealt = rows.withColumn("digest", F.xxhash64("text")).mapInArrow(
        deal, "id long, key long, text string, digest long, block int, tail boolean")
    return dealt.repartition("block").sortWithinPartitions("block", "tail", F.desc("key"), "digest") \
        .select("id", "text", "tail", "block")


def version_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited version, and how alike they are.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, and the number of paragraphs that the sketches
    recovered as differing from the edited text (n_differing). Texts follow each
    other by descending id, nulls last; the first follows the last, so a single
    row follows itself. Null texts are empty; their sketch is all zeros and alike
    (1) to any other without paragraphs. Repeated rows follow each other.
    """
    bounded_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                        ("near_edited", pa.float64()), ("near_next", pa.float64()), ("n_differing", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in slices(batches, limit=2 << 20):
            rows = list(zip(batch["id"].to_pylist(), batch["text"].to_pylist(), batch["tail"].to_pylist(), batch["block"].to_pylist()))
            rows = [last, *rows] if last else rows
            last = rows[-1]
            pairs = [i for i in range(len(rows) - 1) if not rows[i][2] and rows[i][3] == rows[i + 1][3]]
            if not pairs:
                continue
            at = np.array(pairs)
            changed = [edited(rows[i][1], rows[i + 1][1]) for i in pairs]
            own = Versions([paragraphs(r[1]) for r in rows])
            other = Versions([paragraphs(t) for t in changed])
            every = np.arange(len(pairs))
            _, pair, _ = differences(own, at, other, every)
            apart = np.bincount(pair, minlength=len(pairs))
            total = own.count[at] + other.count
            near = np.where(total + apart > 0, (total - apart) / np.maximum(1, total + apart), 1.0)
            yield record(schema, [rows[i][0] for i in pairs], [len(rows[i][1]) for i in pairs],
                         [hashlib.sha256(t.encode()).hexdigest() for t in changed], sketch(own, at).texts(),
                         sketch(other, every).texts(), near, likeness(own, at, own, at + 1), apart)

    return successors(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
             " near_edited double, near_next double, n_differing long")
