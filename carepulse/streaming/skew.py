"""Which keys of a stream are so frequent that they must be split."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Counters of the sketch for each key that could be frequent enough.
COUNTERS = 16


def hot_keys(df: DataFrame, key: str, share: float | None = None) -> dict[object, int]:
    """{key: sub-keys} for keys with at least ``share`` of the rows (by default one shuffle partition's share).

    A frequent-items sketch of bounded size is filled by each task and merged; no key is counted exactly. It misses no
    key with that share, at most 1 / ``share`` keys come back, and each is split until a sub-key is
    about as large as a share. NULL keys match nothing and are left out.
    """
    share = share or 1 / int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(1, int(1 / share))
    found = df.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {most}, {max(64, 2 ** (most * COUNTERS - 1).bit_length())})").alias("top")).first()
    least = share * found["n"]
    return {r["item"]: -(-int(r["count"]) // max(1, int(least))) for r in found["top"] or [] if r["count"] >= least and r["count"] > 1}


def kept_hot_keys(path: str, find: Callable[[], Mapping[object, int]], like: DataFrame, key: str) -> dict[object, int]:
    """The hot keys stored at ``path``; the first time they are found and stored.

    State that a stream keeps is split by these keys, so they must stay what they are as long as the
    checkpoint beside them is used. A key that becomes frequent later is split after the next full refresh.
    """
    spark = like.sparkSession
    schema = f"`{key}` {like.schema[key].dataType.simpleString()}, salts int"
    try:
        rows = spark.read.schema(schema).parquet(path).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = list(find().items())
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("errorifexists").parquet(path)
    return {k: n for k, n in rows}


def salts_of(key: Column, salts: int | Mapping[object, int]) -> Column | None:
    """Number of sub-keys of each row's key; None if no key is split."""
    if isinstance(salts, int):
        return F.lit(salts) if salts > 1 else None
    if not salts:
        return None
    pairs = [F.lit(x) for k, n in salts.items() for x in (k, n)]
    return F.coalesce(F.element_at(F.create_map(*pairs), key), F.lit(1))
