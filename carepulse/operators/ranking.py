"""Order, top-k, latest-n and exact-size sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources.files import stored


def sort_by(df: DataFrame, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    """Order by ``(column, ascending)`` pairs."""
    return df.orderBy(*[F.col(c).asc() if asc else F.col(c).desc() for c, asc in keys])


def top_k(df: DataFrame, c: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The ``k`` largest rows by ``c``; ``tie`` columns make the choice repeatable."""
    return df.orderBy(F.col(c).desc_nulls_last(), *tie).limit(k)


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """One row by key; the filter reaches the scan."""
    return df.where(F.col(key) == F.lit(value)).limit(1)


def latest_n(df: DataFrame, parts: Sequence[str], order: Sequence[Column], n: int, rank: str = "_rank") -> DataFrame:
    """First ``n`` rows per partition by ``order``, with their rank.

    Spark turns the rank filter into a group limit before the shuffle: each task
    sends at most ``n`` rows per key, so a hot key does not pile up.
    """
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*parts).orderBy(*order))).where(
        F.col(rank) <= n
    )


#: Hex digits of a digest that one histogram looks at: 4096 buckets.
_DIGITS = 3
#: Rows of the last bucket that are ranked instead of being looked at more closely.
_RANKED = 10_000


def sample_fixed_n(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Repeatable sample of exactly ``n`` rows without replacement; all rows if there are fewer.

    Rows are ordered by a digest of seed and key, which must identify the row.
    The input is computed once and stored with its digest in the shared folder. A histogram
    over the first digits finds the bucket in which the n-th row falls, another one over the
    next digits the part of that bucket, until few rows are left to be ranked: those are
    the only ones that meet in one task, however large the input.
    """
    parts = [F.lit(str(seed)), *[F.col(k).cast("string") for k in key]]
    spark = df.sparkSession
    marked = stored(df.withColumn("_h", F.md5(F.concat_ws(":", *parts))), shared_dir(spark, "sample"))
    low, left = "", n
    for at in range(0, 32, _DIGITS):
        inside = marked.where(F.col("_h").startswith(low)).groupBy(F.substring("_h", at + 1, _DIGITS).alias("b"))
        counts = sorted((r["b"], r["count"]) for r in inside.count().collect())  # 4096 rows at most
        if sum(c for _, c in counts) <= left:
            return marked.where((F.col("_h") < low) | F.col("_h").startswith(low)).drop("_h")
        for bucket, count in counts:
            if count > left:
                break
            left -= count
        low += bucket
        if count <= _RANKED:
            break
    whole = marked.where(F.col("_h") < low)
    part = marked.where(F.col("_h").startswith(low)).orderBy("_h", *key).limit(left)
    return whole.unionByName(part).drop("_h")


def trim_to_target(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Cut a relation down to ``n`` rows by sampling; smaller relations pass unchanged."""
    return sample_fixed_n(df, n, key, seed)
