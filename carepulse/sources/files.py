"""Parquet directories and timestamp encoding at the file edge."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir
from ..functions.temporal import decode_time, encode_iso_ms, floor_ms as _floor_ms


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
                 glob: str = "*.parquet") -> DataFrame:
    """A directory (or one file) of Parquet parts whose names match ``glob``."""
    reader = spark.read.option("pathGlobFilter", glob)
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def write_parquet_files(df: DataFrame, path: str, num_files: int) -> None:
    """Write files of ceil(rows / ``num_files``) rows each, the last one shorter, in the order of the input.

    A file holds a run of rows that follow each other; fewer rows than files make one file. The input is computed once and
    stored, a file for each partition, its rows with their place. An output file is then the stored files of its run one after
    another, cut by place at the ends: its task streams them, so nothing is sorted or held and rows aren't shuffled. The driver gets name,
    first place and count of each stored file; the plan has a scan for each. What ``path`` held is replaced only by that last write.
    """
    spark = df.sparkSession
    place = F.monotonically_increasing_id()  # partition above bit 33, row below
    rows = shared_dir(spark, "rows")
    marked = stored(df.select("*", place.alias("_place")), rows)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    found = marked.select(name.alias("_name"), "_place").groupBy("_name").agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n")).orderBy("_first").collect()
    total = sum(r["_n"] for r in found)
    size = max(1, -(-total // num_files) if total >= num_files else total)
    runs: list[list[DataFrame]] = [[] for _ in range(-(-total // size))]
    before = 0
    for r in found:
        whole = spark.read.schema(marked.schema).parquet(f"{rows}/{r['_name']}")
        for k in range(before // size, (before + r["_n"] - 1) // size + 1):
            a, b = max(0, k * size - before), min(r["_n"], (k + 1) * size - before)
            cut = whole if b - a == r["_n"] else whole.where(F.col("_place").between(r["_first"] + a, r["_first"] + b - 1))
            runs[k].append(cut.select(*df.columns))
        before += r["_n"]
    out = _union([_union(run).coalesce(1) for run in runs] or [marked.select(*df.columns).coalesce(1)])
    with _setting(spark, "spark.sql.unionOutputPartitioning", "false"):  # or tables of one partition each become one partition
        out.write.mode("overwrite").parquet(path)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _union(tables: list[DataFrame]) -> DataFrame:
    """All rows of the tables in their order; by halves, so that no part of a long plan is analysed often."""
    if len(tables) == 1:
        return tables[0]
    half = len(tables) // 2
    return _union(tables[:half]).union(_union(tables[half:]))


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write to a new shared folder and read back: a short lineage, and a size the planner knows."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def encode_iso(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: encode_iso_ms(c) for c in cols})


def decode_iso(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: decode_time(c) for c in cols})


def floor_ms(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: _floor_ms(c) for c in cols})


def footer_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """(table_name, row_count) of Parquet folders or files, from their footers.

    A distributed scan of the files in which each task adds up the row counts that footers
    state; no column is read. It runs in a session of its own, since counting by footers is a setting.
    """
    side = spark.newSession()
    side.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    side.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counts = [side.read.parquet(path).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
              for name, path in paths.items()]
    zeros = side.createDataFrame([(name, 0) for name in paths], "table_name string, row_count long")  # files without rows state nothing
    return reduce(lambda a, b: a.unionByName(b), counts, zeros).groupBy("table_name").agg(F.sum("row_count").alias("row_count"))
