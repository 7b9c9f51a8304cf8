"""Session settings and the shared scratch folder."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

#: Settings the plans rely on. AQE coalesces small shuffles, turns a join whose
#: side proved small into a broadcast, and splits a shuffle partition that holds
#: far more than its share (a hot key) over several tasks, also where that costs
#: one more shuffle further up.
#: An unbounded stream join keeps both inputs as state: it lives in RocksDB on
#: local disk, not in executor memory, and is restored from the checkpoint.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime-changeable settings on a running session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "carepulse", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A one-machine session for tests and benchmarks (no web page)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="carepulse-wh-", dir="/tmp"))
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_FOLDERS: ContextVar[list[str] | None] = ContextVar("folders", default=None)


@contextmanager
def passing_folders(spark: SparkSession) -> Iterator[list[str]]:
    """Delete, at the end, the folders of intermediate rows that operators make inside the block, also after an error.

    Results are read from such folders, so write them elsewhere within the block. Blocks may be nested.
    """
    made: list[str] = []
    token = _FOLDERS.set(made)
    try:
        yield made
    finally:
        _FOLDERS.reset(token)
        for folder in made:
            remove_folder(spark, folder)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    The folder is the one named by ``spark.checkpoint.dir``. Only a local
    session, whose executors share the machine, may fall back to a temporary
    folder; on a cluster a missing setting is an error, because files on one
    machine are lost with it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="carepulse-", dir="/tmp"))
        base = spark.sparkContext.getCheckpointDir()
    path = f"{base}/{purpose}-{uuid.uuid4().hex}"
    if (made := _FOLDERS.get()) is not None:
        made.append(path)
    return path


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reads, if it is there (classic sessions only)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def folder_state(spark: SparkSession, path: str) -> str:
    """A digest of names, sizes and times of the files below ``path``: another one when any of them has changed (classic sessions only)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files, found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(folder, True), []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()
