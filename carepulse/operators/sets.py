"""Set operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_distinct(*frames: DataFrame) -> DataFrame:
    """UNION: one distinct over all branches, combined map-side."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()


def distinct_on(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def filter_bridge(sources: Sequence[tuple[DataFrame, Mapping[str, tuple[Column, Column | None, Column]]]]) -> DataFrame:
    """Long table (date, region, field_name, field_value); duplicates are kept.

    Each source names its fields as ``{field: (date, region or None, value)}``.
    All fields of a source come from one pass over it; dates become timestamps.
    """

    def long_form(df: DataFrame, fields) -> DataFrame:
        entries = [
            F.struct(
                date.cast("timestamp").alias("date"),
                (F.lit(None) if region is None else region).cast("string").alias("region"),
                F.lit(name).alias("field_name"),
                value.cast("string").alias("field_value"),
            )
            for name, (date, region, value) in fields.items()
        ]
        return df.select(F.inline(F.array(*entries)))

    return reduce(lambda a, b: a.unionByName(b), [long_form(df, fields) for df, fields in sources])
