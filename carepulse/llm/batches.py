"""Arrow batches of bounded size, and intermediate tables in the shared folder."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import shared_dir
from ..sources.files import stored

#: Bytes of text that a task holds at a time (one longer text is taken alone).
BATCH_BYTES = 4 << 20


#: Settings of Python workers: Arrow buffers go back to the system when they are freed, not to a pool of each idle worker.
WORKER_ENV = {"ARROW_DEFAULT_MEMORY_POOL": "system"}

#: Where this package was imported from.
_ROOT = str(Path(__file__).resolve().parents[2])


def bounded_batches(spark: SparkSession) -> None:
    """Limit what Spark sends to a Python worker at once by rows and by bytes, and let
    workers import this package from where the driver has it (--py-files elsewhere).
    Workers give memory back by WORKER_ENV.

    Shuffle files of a finished query are removed with it: each step below
    leaves its rows in the shared folder, so later steps never go back to them.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, _ROOT]))
    for name, value in WORKER_ENV.items():
        spark.sparkContext.environment.setdefault(name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 * BATCH_BYTES))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def give_back() -> None:
    """Return what this worker has freed to the system, where its C library can (glibc)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """Write to a new shared folder and read back, so that lost executors cost no earlier work."""
    return stored(df, shared_dir(df.sparkSession, purpose))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text",
           limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in runs of about ``limit`` bytes of ``column`` at most; no copies."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        run = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = np.flatnonzero(np.diff(run)) + 1
        for a, b in zip([0, *cuts], [*cuts, n]):
            yield batch.slice(a, b - a)


def texts(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The column without nulls: a null text is an empty one."""
    return pc.fill_null(batch[column], "")


def raw_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array as one uint8 array, and the n + 1 offsets into it."""
    array = array.cast(pa.large_binary())
    offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8)
    data = array.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0]:offsets[-1]], offsets - offsets[0]


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
