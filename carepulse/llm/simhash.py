"""SimHash near-duplicates: a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most two bits agree in at least six
of their eight bytes. Index entries are therefore the sets of six positions with
the bytes found there: a pair shares an entry exactly if it reaches that
guaranteed minimum, and a list of one entry can hold no more than the 2^16
distinct values of the two bytes left open, however large a group of copies is.
A list is not expanded into pairs either. Members within two bits of each other
meet at a value one flip away from both, so each is filed under its 17 such
values and linked to the smallest member it meets there; all that meet at one
value are within two bits, so no link joins unlike fingerprints and none that
matters for reaching a document is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import bounded_batches, keep, record, slices, texts
from .components import components
from .tokens import forget

SEED = 42
#: bit values of every byte, most significant first
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 of every run of ``words`` words; of all words if there are fewer; none if there is no word."""
    parts = text.lower().split()
    if len(parts) <= words:
        return [xxhash.xxh64_intdigest(b" ".join(parts), SEED)] if parts else []
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = (ends[: len(parts) - words + 1] - np.fromiter(map(len, parts), np.int64, len(parts))[: len(parts) - words + 1] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(line[a:b], SEED) for a, b in zip(starts, (ends[words - 1:] - 1).tolist())]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One fingerprint for each run of ``counts`` hashes: the bits set in over half of them."""
    n = len(counts)
    cell = np.repeat(np.arange(n, dtype=np.int64) * 8, counts)
    octets = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    tally = np.zeros(n * 2048, np.int64)
    for k in range(8):
        tally += np.bincount(((cell + k) << 8) + octets[:, k], minlength=n * 2048)
    ones = tally.reshape(n, 8, 256) @ _BITS
    return np.packbits((2 * ones > counts[:, None, None]).reshape(n, 64), axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) for every row; ``fp`` holds the 64 bits as a signed long, 0 for a text without words."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, limit=1 << 20):
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                lists = [shingle_hashes(t, words) for t in texts(part).cast(pa.binary()).to_pylist()]
                counts = np.fromiter(map(len, lists), np.int64, len(lists))
                flat = np.fromiter((h for x in lists for h in x), np.uint64, counts.sum())
                schema = pa.schema([("id", part["id"].type), ("fp", pa.int64())])
                yield record(schema, part["id"], majority(flat, counts).view(np.int64))

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, fp long")


def _masked(fp, mask: int) -> F.Column:
    return fp.bitwiseAND(F.lit(_signed(mask)))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _byte_mask(positions) -> int:
    return sum(0xFF << (56 - 8 * p) for p in positions)


def links(fps: DataFrame, bits: int = 2) -> DataFrame:
    """(a, b, shared, differing): links between the distinct values of column ``fp`` that connect exactly
    what all pairs within ``bits`` (1 or 2) would; ``shared`` tallies the positional bytes they have in common."""
    if bits not in (1, 2):
        raise ValueError("bits must be 1 or 2")
    fp, kept = F.col("fp"), list(combinations(range(8), 8 - bits))
    keyed = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(k).cast("byte").alias("k"), _masked(fp, _byte_mask(rows)).alias("entry"))
        for k, rows in enumerate(kept)])).alias("e")).select("fp", "e.*")
    lists = keyed.groupBy("k", "entry").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi")
    shared = keyed.join(keep(lists.select("k", "entry"), "postings"), ["k", "entry"], "left_semi")
    # values inside the open bytes at which members within ``bits`` of each other, and no others, meet:
    # one flip away for two bits, the bit cleared for one
    free = [[1 << (56 - 8 * p + b) for p in range(8) if p not in rows for b in range(8)] for rows in kept]
    free = [[0, *row] if bits == 2 else row for row in free]
    masks = F.element_at(F.array(*[F.array(*[F.lit(_signed(m)).cast("long") for m in row]) for row in free]),
                         F.col("k").cast("int") + 1)
    met = shared.select("fp", "k", F.explode(masks).alias("m"))
    met = met.select("fp", "k", fp.bitwiseXOR(F.col("m")).alias("value"), F.lit(0).cast("long").alias("m")) if bits == 2 else \
        met.select("fp", "k", fp.bitwiseAND(F.bitwise_not("m")).alias("value"), "m")
    lists = met.groupBy("k", "value", "m").agg(F.min("fp").alias("b"), F.collect_set("fp").alias("members"))
    pairs = lists.where(F.size("members") > 1).select(F.explode("members").alias("a"), "b").where("a <> b").distinct()
    differ = F.col("a").bitwiseXOR(F.col("b"))
    tally = sum((_masked(differ, _byte_mask([p])) == 0).cast("int") for p in range(8))
    return pairs.select("a", "b", tally.alias("shared"), F.bit_count(differ).alias("differing")) \
        .where((F.col("shared") >= 8 - bits) & (F.col("differing") <= bits))


def near_duplicates(docs: DataFrame, words: int = 3, bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``; other columns are not looked at.

    component_id is the smallest id reachable over fingerprints within ``bits``,
    the row's own included. Null and empty texts and texts of white space have
    fingerprint 0 and are linked like any other; rows with a null id take part,
    and a component of such rows only has a null component_id. Repeated rows
    give repeated rows. An empty table gives an empty result.
    """
    prints = keep(fingerprints(docs, words, id_col, text_col), "prints")
    distinct = keep(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct-prints")
    roots = components(links(distinct, bits), "a", "b")
    grouped = distinct.join(roots, distinct["fp"] == roots["node"], "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    lowest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = keep(grouped.join(lowest, "root").select("fp", "component_id"), "labels")
    return prints.join(labels, "fp").select(F.col("id").alias("doc_id"), "fp", "component_id")


def hex_fingerprint(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicate(docs: DataFrame, words: int = 3, bits: int = 2, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, one of every component: the first by id (null ids last), then by a digest
    of the text (128 bits).

    Ids need not be unique: rows of one id with unlike texts are in different components and all stay;
    of equal rows of one component one stays. A component is one whose fingerprints are linked, as in ``near_duplicates``. The rows are
    shuffled once, by id and digest; what tells which stay are numbers.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = {"_llm_none": F.col(id_col).isNull(), "_llm_id": F.coalesce(F.col(id_col).cast("long"), F.lit(0)),
           "_llm_text": F.xxhash64(text), "_llm_check": F.xxhash64(F.lit(1), text)}
    keyed = docs.withColumns(key)
    found = near_duplicates(keyed.withColumn("_llm_key", F.struct(*key)), words, bits, "_llm_key", text_col)
    kept = keep(found.select("component_id.*").distinct(), "kept")
    # by plain columns: Spark would cast a struct that may be null, and then shuffle again
    return keyed.join(kept, list(key), "left_semi").dropDuplicates(list(key)).select(*docs.columns)
