"""Grouping operators. Partial aggregation runs before every shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import ColumnLike, classify, col
from ..functions.temporal import is_weekend
from .selection import exact_quantiles


def count_by(df: DataFrame, keys: Mapping[str, ColumnLike], out: str = "n") -> DataFrame:
    """Rows per group; keys may be expressions: ``{name: column}``."""
    return df.groupBy(*[col(c).alias(name) for name, c in keys.items()]).agg(F.count(F.lit(1)).alias(out))


def bounds(df: DataFrame, c: str, lo: str = "lo", hi: str = "hi") -> DataFrame:
    """One row with the smallest and largest value."""
    return df.agg(F.min(c).alias(lo), F.max(c).alias(hi))


def distinct_count(df: DataFrame, cols: Sequence[str], out: str = "n") -> DataFrame:
    """Number of distinct rows over ``cols`` (a NULL is a value of its own)."""
    return df.select(*cols).distinct().agg(F.count(F.lit(1)).alias(out))


def roll_up(df: DataFrame, time_col: str, grain: str, keys: Sequence[str], aggs: Mapping[str, Column],
            out: str) -> DataFrame:
    """Re-aggregate a finer table to a coarser time grain."""
    return df.groupBy(F.date_trunc(grain, F.col(time_col)).alias(out), *keys).agg(
        *[a.alias(name) for name, a in aggs.items()]
    )


def phase_compare(df: DataFrame, time_col: ColumnLike, phases: Sequence[tuple[str, str | None, str | None]],
                  measures: Mapping[str, Column]) -> DataFrame:
    """Measures per phase; a phase is ``(label, from or None, before or None)``, half open."""

    def inside(start, end) -> Column:
        c = col(time_col)
        after = F.lit(True) if start is None else c >= F.lit(start).cast("timestamp")
        return after if end is None else after & (c < F.lit(end).cast("timestamp"))

    rules = [(inside(start, end), label) for label, start, end in phases]
    labelled = df.withColumn("phase", classify(rules, "outside")).where(F.col("phase") != "outside")
    return labelled.groupBy("phase").agg(*[m.alias(name) for name, m in measures.items()])


def with_group_columns(df: DataFrame, groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of a one-row-per-group relation; NULL keys match."""
    names = [f"_k{i}" for i in range(len(keys))]
    right = groups.withColumnsRenamed(dict(zip(keys, names)))
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(right[n]) for k, n in zip(keys, names)])
    return df.join(right, same, "left").drop(*names)


def weekend_compare(df: DataFrame, time_col: ColumnLike, measures: Mapping[str, Column],
                    medians: Mapping[str, ColumnLike] | None = None) -> DataFrame:
    """Measures, and exact medians, for weekend rows against weekday rows."""
    marked = df.withColumn("is_weekend", is_weekend(time_col))
    out = marked.groupBy("is_weekend").agg(*[m.alias(name) for name, m in measures.items()]) if measures else \
        marked.select("is_weekend").distinct()
    return with_group_columns(out, exact_quantiles(marked, ["is_weekend"], medians), ["is_weekend"]) if medians else out
