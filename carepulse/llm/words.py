"""Words of many texts at once, with their places; bounded samples of labelled rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import keep, raw_bytes, texts

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class Words:
    """Runs of bytes other than ASCII white space, text after text."""

    raw: np.ndarray  #: bytes of all texts
    texts: np.ndarray  #: n + 1 byte offsets of the texts
    start: np.ndarray  #: first byte of each word
    end: np.ndarray  #: byte after each word
    first: np.ndarray  #: n + 1 offsets of the texts in words
    codes: np.ndarray  #: each word's place in distinct
    distinct: list[str]

    def points(self, at: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Byte positions as code points from the start of their texts."""
        before = np.concatenate([[0], np.cumsum((self.raw & 0xC0) != 0x80)])
        return before[at] - before[self.texts[owner]]


def split_words(batch: pa.RecordBatch, column: str = "text", between: np.ndarray = _SPACE,
                letters: np.ndarray | None = None) -> Words:
    """Words of the column, parted by the bytes that ``between`` marks; ``letters`` gives each byte another first."""
    raw, offsets = raw_bytes(texts(batch, column))
    if letters is not None:
        raw = letters[raw]
    inside = ~between[raw]
    edge = np.empty(len(raw) + 1, bool)
    edge[:-1], edge[-1:] = inside, False
    edge[1:] ^= inside
    begins = offsets[:-1][np.diff(offsets) > 0]
    at = np.flatnonzero(edge)
    if len(begins):  # a word ends with its text even if the next text begins with one
        begins = begins[begins > 0]
        joined = begins[inside[begins] & inside[begins - 1]]
        at = np.sort(np.concatenate([at, joined, joined]))
    start, end = at[::2], at[1::2]
    ends = np.concatenate([[0], np.cumsum(end - start)])
    packed = pa.LargeBinaryArray.from_buffers(
        pa.large_utf8(), len(start), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw[inside])])
    coded = packed.dictionary_encode()
    return Words(raw, offsets, start, end, np.searchsorted(start, offsets), coded.indices.to_numpy(),
                 coded.dictionary.to_pylist())


#: Labels that a classifier may tell apart.
MOST_LABELS = 1000


def sample(labelled: DataFrame, docs: DataFrame, most: dict | int, id_col: str, text_col: str) -> DataFrame:
    """(label, text) of at most ``most`` rows a label (one number, or by label), chosen by a hash of the id.

    ``labelled`` has columns id and label, with MOST_LABELS labels at most (more are an error). One text stands for an id, that of the
    least digest, so that repeated rows can't enlarge the sample. A label's rows are thinned where they lie, by a
    share that is a little too large; only what is left is sorted by hash, so no label is ever gathered.
    """
    rows = keep(labelled.where("id IS NOT NULL AND label IS NOT NULL").distinct(), "labelled")
    counts = rows.groupBy("label").count().limit(MOST_LABELS + 1).collect()
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    limits = {r["label"]: most[r["label"]] if isinstance(most, dict) else most for r in counts}
    if not limits:
        return docs.limit(0).select(F.lit(None).cast(rows.schema["label"].dataType).alias("label"), F.col(text_col).alias("text"))

    def of_label(values: dict) -> F.Column:
        return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("label"))

    # six standard deviations above the limit: as good as never too few
    shares = {r["label"]: min(1 << 20, 1 + int((n + 6 * n ** 0.5 + 20) * (1 << 20) / r["count"])) for r in counts for n in [limits[r["label"]]]}
    few = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < of_label(shares))
    order = Window.partitionBy("label").orderBy(F.xxhash64(F.lit(1), "id"), "id")
    chosen = few.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= of_label(limits))
    chosen = keep(chosen.select("id", "label"), "sample")
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = docs.select(F.col(id_col).alias("id"), text.alias("text")).join(chosen, "id")
    return found.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("label", "text")


def fold(id_col: str, folds: int) -> F.Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
