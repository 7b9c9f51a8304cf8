"""Rows of a stream packed by key, so that a join keeps and looks up one state row for many of them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes that a task gathers before it packs them, and the most rows of one packed row.
GATHERED_BYTES, MOST_ROWS = 32 << 20, 1000


def packed(df: DataFrame, keys: list[str], gathered: int = GATHERED_BYTES, most: int = MOST_ROWS) -> DataFrame:
    """(keys, rows): rows of ``df`` that have the same keys, as arrays of at most ``most``.

    The rows are dealt by key, and each task packs what it has of a batch in runs of ``gathered`` bytes, so a key can
    have several packed rows. Rows with a NULL key, which match nothing, are left out. No state is kept.
    """
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    keyed = df.where(known).select(*keys, F.struct(*df.columns).alias("row")).repartition(*keys)
    schema = T.StructType([*[keyed.schema[k] for k in keys], T.StructField("rows", T.ArrayType(keyed.schema["row"].dataType))])

    def pack(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches).combine_chunks()
        code = np.zeros(len(table), np.int64)
        for k in keys:  # below rows * rows after each key
            found = table[k].combine_chunks().dictionary_encode()
            code = np.unique(code * len(found.dictionary) + found.indices.to_numpy(), return_inverse=True)[1]
        order = np.argsort(code, kind="stable")
        code = code[order]
        first = np.flatnonzero(np.diff(code, prepend=-1))  # where each key's rows begin
        place = np.arange(len(code)) - np.repeat(first, np.diff(first, append=len(code)))
        begins = np.flatnonzero(place % most == 0)
        table = table.take(pa.array(order)).combine_chunks()
        offsets = pa.array(np.append(begins, len(code)), pa.int32())
        rows = pa.ListArray.from_arrays(offsets, table["row"].combine_chunks())
        heads = table.select(keys).take(pa.array(begins)).combine_chunks()
        return pa.RecordBatch.from_arrays([*[heads[k].combine_chunks() for k in keys], rows], [*keys, "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.nbytes
            if size >= gathered:
                yield pack(held)
                held, size = [], 0
        if held:
            yield pack(held)

    return keyed.mapInArrow(run, schema)
