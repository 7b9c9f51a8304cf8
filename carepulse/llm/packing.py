"""Best-fit packing of token sequences by the sum-of-squares rule."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import bounded_batches, keep, record, slices
from .tokens import encoded

#: Pieces that one task packs: enough for gaps of every size to meet what fills them.
GROUP = 20_000


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each item, given the lengths (1 to ``capacity``), longest first.

    N[g] is the number of open bins with residual gap g. An item goes into the
    open bin by which the sum of all N[g]^2 becomes smallest (the smaller gap on
    a tie), and into a new one only where it fits in none. A bin filled to the
    brim no longer counts. With the longest items first this leaves fewer bins
    than the rule that may also open a bin for its own sake.
    """
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    used = np.zeros(len(lengths), np.int64)
    bins, offsets, n = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    never = np.iinfo(np.int64).max
    for i, size in enumerate(lengths.tolist()):
        before = count[size:capacity]
        # change of the sum of squares: N[g]-1 and N[g-size]+1 (a gap of 0 isn't counted)
        change = 2 * (count[:capacity - size] - before) + 2
        change[:1] -= 1
        change[before == 0] = never
        gap = int(change.argmin()) + size if len(change) else capacity
        if gap < capacity and count[gap]:
            b = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, b = capacity, n
            n += 1
        bins[i], offsets[i] = b, used[b]
        used[b] += size
        if gap > size:
            open_bins[gap - size].append(b)
            count[gap - size] += 1
    return bins, offsets


def encode_pieces(docs: DataFrame, tokenizer: str, capacity: int, end: int, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """(row, doc_id, piece, start, length, ids, ids_crc32), stored in the shared folder.

    ``ids`` are the piece's ids as little-endian unsigned integers of 16 bits,
    or 32 if the vocabulary needs them; ``ids_crc32`` is taken over 32-bit ones.
    ``row`` tells rows apart that are equal otherwise.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch, ids, offsets in encoded(tokenizer, slices(batches, limit=2 << 20), end):
            pieces = -(-np.diff(offsets) // capacity)
            owner = np.repeat(np.arange(batch.num_rows), pieces)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = number * capacity
            begin = offsets[:-1][owner] + start
            length = np.minimum(capacity, offsets[1:][owner] - begin)
            wide, narrow = memoryview(ids.astype("<u4").tobytes()), memoryview(ids.tobytes())
            size = ids.itemsize
            spans = list(zip(begin.tolist(), (begin + length).tolist()))
            schema = pa.schema([("row", pa.int64()), ("doc_id", batch["id"].type), ("piece", pa.int32()),
                                ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                                ("ids_crc32", pa.int64())])
            yield record(schema, row + np.arange(len(owner)), batch["id"].take(pa.array(owner)), number.astype(np.int32),
                         start, length, pa.array([bytes(narrow[a * size:b * size]) for a, b in spans], pa.binary()),
                         np.fromiter((zlib.crc32(wide[4 * a:4 * b]) for a, b in spans), np.int64, len(spans)))
            row += len(owner)

    return keep(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"row long, doc_id {kind}, piece int, start long, length long, ids binary, ids_crc32 long"), "pieces")


def place(pieces: DataFrame, capacity: int, group: int = GROUP) -> DataFrame:
    """``pieces`` (with row and length) with sequence_id and offset.

    A full piece is a sequence. The others are dealt by a hash of their row to as
    many groups as they need, each packed by one task: the number of groups grows
    with the data and their size does not, whatever key or length is frequent.
    """
    full = pieces.where(F.col("length") >= capacity).withColumns(
        {"sequence_id": F.col("row") * 2, "offset": F.lit(0).cast("long")})
    rest = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group))
    schema = rest.schema.simpleString()[len("struct<"):-1]

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("row", "ascending")])
        bins, offsets = sum_of_squares(table["length"].to_numpy(), capacity)
        base = table["_llm_group"][0].as_py() << 32
        return table.drop_columns(["_llm_group"]).append_column("sequence_id", pa.array((base + bins) * 2 + 1)) \
            .append_column("offset", pa.array(offsets))

    dealt = rest.withColumn("_llm_group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    packed = dealt.groupBy("_llm_group").applyInArrow(pack, f"{schema}, sequence_id long, offset long")
    return full.unionByName(packed)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end: int = 0, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Every row of ``docs`` as pieces of at most ``capacity`` ids, packed into sequences.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the
    ids themselves (binary, see encode_pieces) unless ``with_ids`` is off. A null
    or empty text is the single id ``end``. Repeated rows, repeated and null ids are packed
    like any others; other columns are not looked at. An empty table gives no rows.
    """
    pieces = encode_pieces(docs, tokenizer, capacity, end, id_col, text_col)
    placed = place(pieces.drop("ids"), capacity)
    if with_ids:
        placed = placed.join(pieces.select("row", "ids"), "row")
    return placed.drop("row")
