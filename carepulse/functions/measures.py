"""Aggregate expressions. All combine map-side, so a hot group sends one partial
row per task. Rates are DOUBLE."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import ColumnLike, col


def count_if(predicate: Column) -> Column:
    """Rows where the predicate holds; NULL does not count."""
    return F.count_if(predicate)


def sum_if(predicate: Column, c: ColumnLike) -> Column:
    return F.sum(F.when(predicate, col(c)).otherwise(F.lit(0)))


def rate(predicate: Column) -> Column:
    """Share of rows where the predicate holds; NULL counts as not holding."""
    return F.avg(F.when(predicate, F.lit(1.0)).otherwise(F.lit(0.0)))


def any_flag(predicate: Column) -> Column:
    """1 if the predicate holds for any row, else 0."""
    return F.max(F.when(predicate, 1).otherwise(0))


def approx_median(c: ColumnLike, p: float = 0.5, accuracy: int = 10000) -> Column:
    """Some element near rank ``p``: a bounded sketch for each group, within ``1/accuracy`` of the rank.

    For exact medians see :func:`carepulse.operators.selection.exact_quantiles`.
    """
    return F.percentile_approx(col(c), p, accuracy)


def ratio(num: Column, den: Column, on_zero: float | None = None) -> Column:
    """``num / den`` as DOUBLE; ``on_zero`` (default NULL) when ``den`` is zero."""
    quotient = F.try_divide(num.cast("double"), den.cast("double"))
    return quotient if on_zero is None else F.when(den == 0, F.lit(on_zero)).otherwise(quotient)
