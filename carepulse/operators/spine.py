"""Row generators: calendars, dense scaffolds, list and count expansion.

No cross join anywhere: a dimension is a list or a range between two scalars that
is exploded next to the keys, so the plan is a projection over the key side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.temporal import is_weekend, month_start, week_start

def _calendar_columns(days: DataFrame) -> DataFrame:
    return days.select(
        "date",
        F.dayofweek("date").alias("dow"),
        is_weekend("date").alias("is_weekend"),
        week_start("date").alias("week_start"),
        month_start("date").alias("month"),
    )


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Daily calendar from ``start`` to ``end`` inclusive."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))
    return _calendar_columns(spark.range(1).select(F.explode(days).alias("date")))


def date_spine_of(df: DataFrame, date_col: str) -> DataFrame:
    """Daily calendar from the smallest to the largest date found in ``df``."""
    bounds = df.agg(F.min(date_col).cast("date").alias("lo"), F.max(date_col).cast("date").alias("hi"))
    return _calendar_columns(
        bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("date"))
    )


def hour_spine(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour_of_day"))


def values(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small literal relation, made of literals so that the planner knows its size."""
    fields = T.StructType.fromDDL(schema).fields
    literals = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*literals)))


@dataclass(frozen=True)
class Span:
    """A range as a scaffold dimension: bounds and step are scalars, the members are never gathered."""

    low: Column
    high: Column
    step: Column

    def members(self) -> Column:
        return F.sequence(self.low, self.high, self.step)


def days_of(df: DataFrame, date_col: str = "date") -> Span:
    """Every day between the first and the last date found in ``df``: for a calendar, its days."""
    days = F.col(date_col).cast("date")
    low, high = (df.agg(f(days).alias("d")).scalar() for f in (F.min, F.max))
    return Span(low, high, F.expr("INTERVAL 1 DAY"))


def hours_of_day() -> Span:
    return Span(F.lit(0), F.lit(23), F.lit(1))


def scaffold(keys: DataFrame, dims: Mapping[str, Span | Sequence]) -> DataFrame:
    """Every key row with every combination of the dimensions.

    ``keys`` may be of any size and keeps its partitioning. A dimension is a list of
    literals or a :class:`Span`; a relation is refused, whatever its size: make it the keys.
    """
    out = keys
    for name, dim in dims.items():
        if isinstance(dim, DataFrame):
            raise TypeError(f"dimension {name} is a relation; give its Span, or make it the keys")
        members = dim.members() if isinstance(dim, Span) else F.array(*[F.lit(m) for m in dim])
        out = out.select("*", F.explode(members).alias(name))
    return out


def explode_csv(df: DataFrame, c: str, out: str, sep: str = ",") -> DataFrame:
    """One row per trimmed item of a separated list.

    A NULL list gives no row; an empty string gives one empty item.
    """
    rows = df.withColumn(out, F.explode(F.split(c, sep)))
    return rows.withColumn(out, F.trim(out))


def repeat_rows(df: DataFrame, n_col: str, out: str = "copy_no", chunk: int = 4096,
                spread: bool = False) -> DataFrame:
    """Repeat each row ``n_col`` times, numbered 1..n; no row where n is NULL or below 1.

    Expansion is in two steps, so no array is longer than ``max(n/chunk, chunk)``
    and a row with a huge count streams through. ``spread`` shuffles the chunks
    of rows in between, to the session's shuffle partitions, for when one row makes up
    much of the output.
    """
    chunks = df.where(F.col(n_col) >= 1).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(n_col) - 1) / chunk)))
    )
    if spread:
        chunks = chunks.repartition(*df.columns, "_chunk")
    low = F.col("_chunk") * chunk
    high = F.least(low + chunk, F.col(n_col).cast("long"))
    return chunks.withColumn(out, F.explode(F.sequence(low + 1, high))).drop("_chunk")
