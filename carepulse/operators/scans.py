"""Running values over partitions of any length: block totals first, offsets second.

A window sorts a whole partition in one task. Here rows are dealt by range of partition
and order, so a long partition lies in many blocks. Each block runs its own window; one
row a block and partition says what the blocks before hold, and is joined back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import ColumnLike, col
from ..session import shared_dir
from ..sources.files import stored

_BLOCK, _PLACE = "_block", "_place"


def in_blocks(df: DataFrame, parts: Sequence[str], order: Sequence[ColumnLike]) -> DataFrame:
    """``df`` sorted by range and stored, with ``_block`` (its numbers follow the order) and ``_place`` in the block.

    Rows that agree in ``parts`` and ``order`` follow each other in the order they were read, and
    may lie in two blocks, so no value of ``order`` is too frequent.
    """
    keys = [F.col(p).asc_nulls_first() for p in parts] + [col(o) for o in order] + [F.col("_read")]
    dealt = df.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_read")
    place = F.monotonically_increasing_id()  # partition above bit 33, row below
    numbered = dealt.withColumn(_PLACE, place).withColumn(_BLOCK, F.shiftright(_PLACE, 33).cast("int"))
    return stored(numbered, shared_dir(df.sparkSession, "blocks"))


def _same(left: DataFrame, right: DataFrame, parts: Sequence[str]) -> Column:
    same = [left[p].eqNullSafe(right[f"_p{i}"]) for i, p in enumerate(parts)]
    return reduce(lambda a, b: a & b, same, left[_BLOCK] == right["_b"])


def _block_rows(blocks: DataFrame, parts: Sequence[str], aggs: Mapping[str, Column]) -> DataFrame:
    """One row a block and partition, under names that don't clash."""
    found = blocks.groupBy(*parts, _BLOCK).agg(*[a.alias(n) for n, a in aggs.items()])
    return found.withColumnsRenamed({p: f"_p{i}" for i, p in enumerate(parts)} | {_BLOCK: "_b"})


def _before(parts: Sequence[str]):
    return Window.partitionBy(*[f"_p{i}" for i in range(len(parts))]).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)


def _inside(parts: Sequence[str]):
    return Window.partitionBy(_BLOCK, *parts).orderBy(_PLACE)


def running(blocks: DataFrame, parts: Sequence[str], sums: Mapping[str, ColumnLike] | None = None,
            maxima: Mapping[str, ColumnLike] | None = None) -> DataFrame:
    """``blocks`` (of :func:`in_blocks`) with running sums and running maxima, the row itself included.

    As in a window a sum is NULL until the first value. Sums of doubles are added block by block, so their last digits may differ.
    """
    spark = blocks.sparkSession
    kinds = {**{n: (F.sum, c) for n, c in (sums or {}).items()}, **{n: (F.max, c) for n, c in (maxima or {}).items()}}
    totals = _block_rows(blocks, parts, {n: f(col(c)) for n, (f, c) in kinds.items()})
    offsets = stored(totals.select("_b", *[f"_p{i}" for i in range(len(parts))], *[
        f(n).over(_before(parts)).alias(f"_o_{n}") for n, (f, _) in kinds.items()]), shared_dir(spark, "offsets"))
    frame = _inside(parts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = blocks.withColumns({f"_w_{n}": f(col(c)).over(frame) for n, (f, c) in kinds.items()})
    joined = own.join(offsets, _same(own, offsets, parts))

    def both(n: str, f) -> Column:
        a, b = F.col(f"_o_{n}"), F.col(f"_w_{n}")
        return F.greatest(a, b) if f is F.max else F.coalesce(a + b, a, b)

    return joined.select(*[own[c] for c in blocks.columns], *[both(n, f).alias(n) for n, (f, _) in kinds.items()])


def prefix_sum(df: DataFrame, c: ColumnLike, parts: Sequence[str], order: Sequence[ColumnLike], out: str) -> DataFrame:
    """Running sum of ``c`` per partition, for partitions of any length; equal to the window over rows."""
    found = running(in_blocks(df, parts, order), parts, {out: c})
    return found.drop(_BLOCK, _PLACE)


def numbered(df: DataFrame, parts: Sequence[str], order: Sequence[ColumnLike], out: str) -> DataFrame:
    """Row numbers from 1 per partition, for partitions of any length."""
    return prefix_sum(df, F.lit(1).cast("long"), parts, order, out)


def lag_rows(df: DataFrame, c: str, k: int, parts: Sequence[str], order: Sequence[ColumnLike], out: str) -> DataFrame:
    """Value ``k`` rows back per partition, for partitions of any length.

    Within a block it is a window. The first ``k`` rows of a block get theirs from the rows that
    blocks before hand over: the last ``k`` of each block and partition, found by their number.
    """
    spark = df.sparkSession
    blocks = in_blocks(df, parts, order)
    one = _inside(parts)
    known = blocks.withColumns({"_n": F.row_number().over(one), "_v": F.lag(c, k).over(one)})
    sizes = _block_rows(blocks, parts, {"_size": F.count(F.lit(1))})
    starts = stored(sizes.select("_b", *[f"_p{i}" for i in range(len(parts))], "_size",
                                 F.coalesce(F.sum("_size").over(_before(parts)), F.lit(0)).alias("_start")), shared_dir(spark, "starts"))
    known = known.join(starts, _same(known, starts, parts))
    near = known.where(F.col("_n") <= k).select(*blocks.columns, (F.col("_start") + F.col("_n") - k).alias("_wanted"))
    handed = known.where(F.col("_n") > F.col("_size") - k).select(
        *[F.col(p).alias(f"_q{i}") for i, p in enumerate(parts)], (F.col("_start") + F.col("_n")).alias("_at"), F.col(c).alias(out))
    same = reduce(lambda a, b: a & b, [near[p].eqNullSafe(handed[f"_q{i}"]) for i, p in enumerate(parts)], near["_wanted"] == handed["_at"])
    first = near.join(handed, same, "left").select(*df.columns, out)
    return known.where(F.col("_n") > k).select(*df.columns, F.col("_v").alias(out)).unionByName(first)


def lag_days(df: DataFrame, c: str, days: int, parts: Sequence[str], day: str, out: str) -> DataFrame:
    """Value of the same partition ``days`` days before; NULL where that day has no row.

    An equi-join on partition and day: a partition is never gathered. ``parts`` and ``day`` must name one row.
    """
    back = df.select(*[F.col(p).alias(f"_q{i}") for i, p in enumerate(parts)], F.date_add(F.col(day).cast("date"), days).alias("_day"), F.col(c).alias(out))
    same = reduce(lambda a, b: a & b, [df[p].eqNullSafe(back[f"_q{i}"]) for i, p in enumerate(parts)], df[day].cast("date") == back["_day"])
    return df.join(back, same, "left").select(*[df[x] for x in df.columns], out)


def density(df: DataFrame, parts: Sequence[str], day: str) -> DataFrame:
    """(parts, rows, days, missing_days, repeated_days, dense) of each partition, in one aggregate.

    ``k`` rows back is ``k`` days back only where a partition is dense: one row for each day from its first to its last.
    """
    daily = df.where(F.col(day).isNotNull()).groupBy(*parts, F.col(day).cast("date").alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    found = daily.groupBy(*parts).agg(
        F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("days"), F.count_if(F.col("_n") > 1).alias("repeated_days"),
        (F.date_diff(F.max("_day"), F.min("_day")) + 1).cast("long").alias("_span"))
    return found.select(*parts, "rows", "days", (F.col("_span") - F.col("days")).alias("missing_days"), "repeated_days",
                        ((F.col("_span") == F.col("days")) & (F.col("rows") == F.col("days"))).alias("dense"))
