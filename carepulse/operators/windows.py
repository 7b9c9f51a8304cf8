"""Window operators.

Running sums and lags run on daily aggregates: one window partition holds one
row per day (and unit), so its size is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .aggregates import with_group_columns
from .selection import exact_quantiles


def partition_medians(df: DataFrame, c: str, parts: Sequence[str], out: str) -> DataFrame:
    """Lower median of ``c`` per partition, one row each; exact."""
    return exact_quantiles(df, parts, {out: c})


def with_partition_median(df: DataFrame, c: str, parts: Sequence[str], out: str,
                          medians: DataFrame | None = None) -> DataFrame:
    """Attach the lower median of ``c`` within each partition; every row is kept.

    Written as aggregate and join instead of a window: a window would sort all
    rows of a hot partition in one task, while the aggregate combines map-side
    and the join back can be broadcast or split. NULL keys form a group.

    Give ``medians`` (:func:`partition_medians`, stored as a table) on large
    data: the planner then knows their size beforehand and, if they are small
    enough to broadcast, does not shuffle ``df`` at all.
    """
    small = partition_medians(df, c, parts, out) if medians is None else medians
    return with_group_columns(df, small.select(*parts, out), parts)


def running_sum(df: DataFrame, c: str, parts: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    frame = (
        Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(out, F.sum(c).over(frame))


def lag_k(df: DataFrame, c: str, k: int, parts: Sequence[str], order: Sequence[str], out: str) -> DataFrame:
    """Value ``k`` rows back. Equals ``k`` days back only where the input is dense by day."""
    return df.withColumn(out, F.lag(c, k).over(Window.partitionBy(*parts).orderBy(*order)))


def delta_vs_lag(df: DataFrame, c: str, k: int, parts: Sequence[str], order: Sequence[str],
                 lag_out: str, delta_out: str) -> DataFrame:
    """Lagged value and the change against it; NULL when either is NULL."""
    lagged = F.lag(c, k).over(Window.partitionBy(*parts).orderBy(*order))
    return df.withColumns({lag_out: lagged, delta_out: F.col(c) - lagged})
