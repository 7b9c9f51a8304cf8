"""Streaming tables: append-only Parquet output plus checkpoint, updated on demand."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import remove_folder
from ..sources.versions import Version, Versions


def read_stream(spark: SparkSession, path: str, schema: T.StructType | str, glob: str = "*.parquet",
                max_files: int | None = None) -> DataFrame:
    """New files of a Parquet directory as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def start_available(stream: DataFrame, data: str, checkpoint: str) -> StreamingQuery:
    """Start processing what is new; the query stops by itself when that is done."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", data)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def in_generation(versions: Versions, run: Callable[[str], None], full_refresh: bool, keep: int = 2, *others: str) -> Version:
    """Run in the current generation of an output, or for a full refresh in a new one that counts when the run is through.

    A generation is an output together with its progress, so they can't be mixed up. A refresh that fails
    changes nothing: readers keep the old output, and the next ordinary run goes on with it. The first
    generation counts from the start, so that a first run that fails is continued. ``others`` as in :meth:`Versions.expire`.
    """
    at = versions.current()
    if at is None:
        at = versions.commit(versions.fresh())
        run(at.name)
    elif not full_refresh:
        run(at.name)
    else:
        name = versions.fresh()
        try:
            run(name)
        except Exception:
            for folder in (versions.root, *others):
                remove_folder(versions.spark, f"{folder}/{name}")
            raise
        at = versions.commit(name)
        versions.expire(keep, *others)
    return at


def run_available(stream: DataFrame, dst: str, ckpt: str, full_refresh: bool = False, keep: int = 2) -> str:
    """Process what is new, then stop; a later call adds only newer rows. Returns the folder with the rows.

    ``dst`` and ``ckpt`` must be shared folders. ``full_refresh`` recomputes from the start into a new
    generation, which takes the old one's place when it is complete; the last ``keep`` generations stay.
    """

    def run(name: str) -> None:
        start_available(stream, f"{dst}/{name}", f"{ckpt}/{name}").awaitTermination()

    return in_generation(Versions(stream.sparkSession, dst), run, full_refresh, keep, ckpt).path


def stream_copy(spark: SparkSession, src: str, schema: T.StructType | str, dst: str, ckpt: str,
                glob: str = "*.parquet", full_refresh: bool = False, max_files: int | None = 1000) -> str:
    """Append-only copy of a landing directory, ``max_files`` new files a batch."""
    return run_available(read_stream(spark, src, schema, glob, max_files), dst, ckpt, full_refresh)


def temp_view(df: DataFrame, name: str) -> DataFrame:
    """Name an intermediate result (batch or stream) without storing it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
