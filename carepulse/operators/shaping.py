"""Row-local operators: trim, cast, default, rename, filter."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import ColumnLike, col


def trim_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.trim(c) for c in cols})


def defaults(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULL by a default, per column."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


def cast_cols(df: DataFrame, types: Mapping[str, str], lenient: bool = False) -> DataFrame:
    """Cast columns; ``lenient`` turns a value that does not fit into NULL instead of an error."""
    return df.withColumns(
        {c: F.col(c).try_cast(t) if lenient else F.col(c).cast(t) for c, t in types.items()}
    )


def project(df: DataFrame, columns: Mapping[str, ColumnLike]) -> DataFrame:
    """Select with names: ``{new_name: column}``; everything else is dropped."""
    return df.select(*[col(c).alias(name) for name, c in columns.items()])


def with_const(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def where(df: DataFrame, predicate: Column) -> DataFrame:
    return df.where(predicate)
