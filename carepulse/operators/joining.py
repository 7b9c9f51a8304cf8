"""Join operators.

No join carries a broadcast hint: Spark broadcasts a side whose size it has
checked against ``spark.sql.autoBroadcastJoinThreshold`` and else shuffles,
with AQE splitting the partition of a hot key (see ``session.py``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_enrich(left: DataFrame, right: DataFrame, on: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Left join that adds only ``cols`` of the right side.

    Every left row is kept; a key found more than once on the right multiplies.
    """
    return left.join(right.select(*on, *cols), on=list(on), how="left")


def densify(spine: DataFrame, facts: Sequence[DataFrame], on: Sequence[str],
            fills: Mapping[str, object] | None = None) -> DataFrame:
    """Left-join aggregates onto a dense spine; ``fills`` replaces NULL per column."""
    out = spine
    for fact in facts:
        out = out.join(fact, on=list(on), how="left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (fills or {}).items()})


def with_bounds(df: DataFrame, bounds: DataFrame) -> DataFrame:
    """Attach the columns of a one-row relation to every row (as scalar subqueries)."""
    return df.withColumns({c: bounds.select(c).scalar() for c in bounds.columns})


def exists_in(left: DataFrame, right: DataFrame, on: Sequence[str], predicate: Column | None = None) -> DataFrame:
    """Left rows with a partner on the right.

    The right side is filtered and reduced to distinct keys before it is
    shuffled, so a key that repeats millions of times travels once per task.
    """
    partners = right if predicate is None else right.where(predicate)
    return left.join(partners.select(*on).distinct(), on=list(on), how="left_semi")


def join_daily(left: DataFrame, right: DataFrame, on: Sequence[str] = ("site", "unit", "date")) -> DataFrame:
    """Inner join of two daily tables; shared non-key columns come from the left."""
    extra = [c for c in right.columns if c in on or c not in left.columns]
    return left.join(right.select(*extra), on=list(on))
