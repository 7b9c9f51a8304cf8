"""Data-quality checks as aggregates over whole tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranking import latest_n
from .scans import in_blocks, running


def _row_count() -> Column:
    return F.count(F.lit(1))


def dq_required_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, null_count) for each required column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column", "null_count")


def dq_value_range(df: DataFrame, c: str, lo, hi) -> DataFrame:
    """(column, invalid_count): values outside ``[lo, hi]``; NULL is not counted."""
    outside = (F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi))
    return df.agg(F.count_if(outside).alias("invalid_count")).select(F.lit(c).alias("column"), "invalid_count")


def dq_interval_order(df: DataFrame, start: str, end: str, as_of: str | None = None,
                      period: DataFrame | None = None, on: Sequence[str] = (),
                      period_cols: tuple[str, str] = ("period_start", "period_end")) -> DataFrame:
    """(rule, violations): start after end, dates after ``as_of``, interval in no period of its owner."""
    s, e = F.col(start), F.col(end)
    checks = {"start_after_end": F.count_if(s > e)}
    if as_of is not None:
        limit = F.lit(as_of).cast("timestamp")
        checks["in_future"] = F.count_if((s > limit) | (e > limit))
    out = df.agg(*[c.alias(n) for n, c in checks.items()]).unpivot([], list(checks), "rule", "violations")
    if period is not None:
        stray = outside_periods(df, start, end, period, on, period_cols)
        total = F.coalesce(F.sum("rows"), F.lit(0).cast("long")).alias("violations")
        out = out.unionByName(stray.agg(total).select(F.lit("outside_period").alias("rule"), "violations"))
    return out


def outside_periods(df: DataFrame, start: str, end: str, period: DataFrame, on: Sequence[str],
                    period_cols: tuple[str, str] = ("period_start", "period_end")) -> DataFrame:
    """(on, start, end, rows): intervals that lie in no period of their owner.

    One sweep in order of time: the latest end of all periods that have begun by an interval's start, a running
    maximum, is not before the interval's end just where one period holds it. So the work is linear in intervals and
    periods, however many an owner has, and blocks of the sweep are spread over tasks (:mod:`.scans`). An
    open end counts as the start; an interval without an owner or a start lies in none.
    """
    lo, hi = period_cols
    s, e = F.col(start), F.col(end)
    keys = [f"_k{i}" for i in range(len(on))]
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in [*on, lo, hi]])
    # equal periods, and equal intervals, of an owner are one row before they are shuffled
    periods = period.where(known).select(*[F.col(k).alias(n) for k, n in zip(on, keys)], F.col(lo).alias("_at"), F.col(hi).alias("_until")).distinct()
    spans = df.groupBy(*on, start, end).agg(_row_count().alias("_n")).select(
        *[F.col(k).alias(n) for k, n in zip(on, keys)], s.alias("_at"), e.alias("_end"), "_n")
    events = periods.withColumn("_what", F.lit(0)).unionByName(spans.withColumn("_what", F.lit(1)), allowMissingColumns=True)
    swept = running(in_blocks(events, keys, ["_at", "_what"]), keys, maxima={"_held": "_until"})
    covered = F.coalesce(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]) & (F.coalesce("_end", "_at") <= F.col("_held")), F.lit(False))
    return swept.where((F.col("_what") == 1) & ~covered).select(
        *[F.col(n).alias(k) for k, n in zip(on, keys)], F.col("_at").alias(start), F.col("_end").alias(end), F.col("_n").alias("rows"))


def dq_referential(child: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """(orphan_keys, orphan_rows) for child keys without a parent; NULL keys are not checked.

    Child rows are counted per key before the shuffle, so a hot key is one row.
    """
    keys = list(on)
    counted = child.dropna(subset=keys).groupBy(*keys).agg(_row_count().alias("_n"))
    parents = parent.select(*[F.col(p).alias(c) for c, p in on.items()]).distinct()
    return counted.join(parents, keys, "left_anti").agg(
        _row_count().alias("orphan_keys"), F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows")
    )


def dq_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return df.groupBy(*keys).agg(_row_count().alias("copies")).where(F.col("copies") > 1)


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key by ``order``."""
    return latest_n(df, keys, order, 1, "_dup").drop("_dup")


def dq_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """(column, problem): missing, unexpected, wrong type, or NULLs where none are allowed."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wanted = {f.name: f for f in expected.fields}
    found = [(n, "missing") for n in wanted if n not in actual]
    found += [(n, "unexpected") for n in actual if n not in wanted]
    found += [
        (n, f"type {actual[n].simpleString()}, expected {f.dataType.simpleString()}")
        for n, f in wanted.items()
        if n in actual and actual[n] != f.dataType
    ]
    static = df.sparkSession.createDataFrame(found, "column string, problem string")
    strict = [n for n, f in wanted.items() if not f.nullable and n in actual]
    if not strict:
        return static
    nulls = dq_required_not_null(df, strict).where("null_count > 0")
    return static.unionByName(nulls.select("column", F.lit("has nulls").alias("problem")))


def dq_metrics(df: DataFrame, required: Sequence[str], keys: Sequence[str],
               standard: Mapping[str, Column] | None = None,
               valid: Mapping[str, Column] | None = None) -> DataFrame:
    """One row: rows, completeness % per column, standardised %, invalid and duplicate rows.

    A standardisation or validity predicate that is NULL counts as not met.
    """
    def met(p: Column) -> Column:
        return F.coalesce(p, F.lit(False))

    def percent(p: Column) -> Column:
        return F.avg(F.when(met(p), F.lit(100.0)).otherwise(F.lit(0.0)))

    measures = [_row_count().alias("rows_total")]
    measures += [percent(F.col(c).isNotNull()).alias(f"complete_pct_{c}") for c in required]
    measures += [percent(p).alias(f"standard_pct_{n}") for n, p in (standard or {}).items()]
    measures += [F.count_if(~met(p)).alias(f"invalid_{n}") for n, p in (valid or {}).items()]
    surplus = dq_unique(df, keys).agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("n"))
    return df.agg(*measures).withColumn("duplicate_rows", surplus.scalar())
