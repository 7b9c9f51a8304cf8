"""Token ids in files of fixed-width bit fields.

A file is: payload, table, trailer (all integers little-endian).

* payload: blocks of BLOCK ids, each id in the least number of bits that the
  vocabulary needs, id k of a block at bits k*w to k*w+w of it, lowest first;
  the last block is filled up with zeros. A block is BLOCK*w/8 bytes, a whole
  number of 64-bit words.
* table: for each document the id's null flag (1 byte) and value (8 bytes), its
  end in ids (8 bytes); then each block's byte offset (8 bytes).
* trailer: documents, ids, blocks, table's byte offset (8 bytes each), bits (4),
  MAGIC (4).

Any id is found by its block's offset, and a block is unpacked by numpy alone.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from .batches import bounded_batches, keep, record, slices
from .tokens import encode_with_end, encoder

BLOCK, MAGIC = 4096, b"TIDB"
_TRAILER = struct.Struct("<qqqqi4s")


def width(vocabulary: int) -> int:
    """Bits of the largest id."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Whole blocks of ids as bit fields: 64 ids at a time fill ``bits`` 64-bit words."""
    lanes = ids.reshape(-1, 64).astype(np.uint64)
    words = np.zeros((len(lanes), bits), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        words[:, word] |= lanes[:, j] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, j] >> np.uint64(64 - shift)
    return words.astype("<u8").tobytes()


def unpack_bits(data: bytes, bits: int) -> np.ndarray:
    words = np.frombuffer(data, "<u8").reshape(-1, bits)
    lanes, mask = np.empty((len(words), 64), np.uint32), np.uint64((1 << bits) - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        field = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            field = field | words[:, word + 1] << np.uint64(64 - shift)
        lanes[:, j] = field & mask
    return lanes.ravel()


def _open(path: str):
    return pa.fs.FileSystem.from_uri(path)


class Writer:
    """One file, written front to back; holds a block and the document table."""

    def __init__(self, path: str, bits: int):
        fs, place = _open(path)
        fs.create_dir(place.rpartition("/")[0], recursive=True)
        self.out, self.bits, self.rest = fs.open_output_stream(place), bits, np.zeros(0, np.uint32)
        self.ids, self.blocks, self.docs = 0, 0, []

    def add(self, doc_ids: pa.Array, ids: np.ndarray, ends: np.ndarray) -> None:
        null = doc_ids.is_null().to_numpy(zero_copy_only=False).astype("u1")
        self.docs.append((null, doc_ids.fill_null(0).to_numpy().astype("<i8"), (self.ids + ends).astype("<i8")))
        self.ids += len(ids)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) // BLOCK * BLOCK
        self._write(ids[:whole])
        self.rest = ids[whole:]

    def _write(self, ids: np.ndarray) -> None:
        self.out.write(pack_bits(ids, self.bits))
        self.blocks += len(ids) // BLOCK

    def close(self) -> int:
        """Ends the file; the number of its documents."""
        if len(self.rest):
            self._write(np.pad(self.rest, (0, BLOCK - len(self.rest))))
        block = BLOCK * self.bits // 8
        docs = sum(len(x[0]) for x in self.docs)
        for k in range(3):
            for part in self.docs:
                self.out.write(part[k].tobytes())
        self.out.write((np.arange(self.blocks, dtype="<i8") * block).tobytes())
        self.out.write(_TRAILER.pack(docs, self.ids, self.blocks, self.blocks * block, self.bits, MAGIC))
        self.out.close()
        return docs


class Reader:
    """Random access to one file by document or by range of ids."""

    def __init__(self, path: str):
        fs, place = _open(path)
        self.file = fs.open_input_file(place)
        size = self.file.size()
        raw = self.file.read_at(_TRAILER.size, size - _TRAILER.size)
        self.docs, self.ids, blocks, table, self.bits, magic = _TRAILER.unpack(raw)
        if magic != MAGIC:
            raise ValueError(f"{path} holds no token ids")
        raw = self.file.read_at(size - _TRAILER.size - table, table)
        n = self.docs
        self.null = np.frombuffer(raw, "u1", n).astype(bool)
        self.doc_ids = np.frombuffer(raw, "<i8", n, n)
        self.ends = np.frombuffer(raw, "<i8", n, 9 * n)
        self.offsets = np.frombuffer(raw, "<i8", blocks, 17 * n)

    def range(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop``: only their blocks are read."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        first, last = start // BLOCK, (stop - 1) // BLOCK
        length = int(self.offsets[last]) + BLOCK * self.bits // 8 - int(self.offsets[first])
        ids = unpack_bits(self.file.read_at(length, int(self.offsets[first])), self.bits)
        return ids[start - first * BLOCK:stop - first * BLOCK]

    def document(self, k: int) -> np.ndarray:
        return self.range(int(self.ends[k - 1]) if k else 0, int(self.ends[k]))


def write_ids(docs: DataFrame, tokenizer: str, end: int = 1, id_col: str = "doc_id", text_col: str = "text",
              folder: str | None = None) -> DataFrame:
    """Encode every text, id ``end`` after each, and write the files in ascending id order.

    Returns the list of files (path, part, n_docs, n_ids, base: ids in all files before
    it). Rows are range-partitioned by id, then by a digest of the text, so that
    rows that share an id are spread too unless they are equal. A task names its
    file for itself alone and reports it in its result: a repeated task leaves
    an unlisted file and never a broken one. Null ids come first; a null or empty text is
    the single id ``end``. Other columns are not looked at.
    """
    bounded_batches(docs.sparkSession)
    folder = folder or shared_dir(docs.sparkSession, "token-ids")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), None
        path = f"{folder}/{part:06d}-{uuid.uuid4().hex}.ids"
        for batch in slices(batches, limit=2 << 20):
            out = out or Writer(path, width(encoder(tokenizer).vocabulary))
            ids, offsets = encode_with_end(tokenizer, batch, end)
            out.add(batch["id"], ids.astype(np.uint32), offsets[1:])
        if out:
            n = out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "part": pa.array([part], pa.int32()), "n_docs": [n], "n_ids": [out.ids]})

    files = rows.repartitionByRange("id", "digest").sortWithinPartitions("id", "digest").drop("digest") \
        .mapInArrow(write, "path string, part int, n_docs long, n_ids long")
    files = keep(files, "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return keep(files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long"))), "token-files")


def read_ids(files: DataFrame, digests_only: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document in the listed files.

    Each file is read by one task, some blocks at a time; ``ids`` (array<int>) is
    left out with ``digests_only``.
    """
    schema = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
    arrow = pa.schema(schema if digests_only else [*schema, ("ids", pa.list_(pa.int32()))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["base"].to_pylist()):
                file = Reader(path)
                starts = np.concatenate([[0], file.ends[:-1]]).astype(np.int64)
                run = starts // (1 << 20)
                cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), file.docs]
                for a, b in zip(cuts, cuts[1:]):
                    ids = file.range(int(starts[a]), int(file.ends[b - 1])).astype("<u4")
                    local = np.append(starts[a:b], file.ends[b - 1]) - starts[a]
                    raw = memoryview(ids.tobytes())
                    crcs = [zlib.crc32(raw[4 * x:4 * y]) for x, y in zip(local[:-1].tolist(), local[1:].tolist())]
                    columns = [pa.array(file.doc_ids[a:b], mask=file.null[a:b]), base + starts[a:b], np.diff(local), crcs]
                    if not digests_only:
                        columns.append(pa.ListArray.from_arrays(local.astype(np.int32), ids.astype(np.int32)))
                    yield record(arrow, *columns)

    spread = files.select("path", "base").repartition(max(1, files.count()), "path")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"
                             + ("" if digests_only else ", ids array<int>"))
