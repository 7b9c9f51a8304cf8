"""Registration of queries and their check SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .inputs import Inputs
from .oracle import with_tables

#: Digits after the first one.
DIGITS = 11


def present(df: DataFrame) -> DataFrame:
    """Result columns as the check expects them: doubles to DIGITS + 1 significant digits, timestamps without a zone."""

    def shown(f: T.StructField):
        if isinstance(f.dataType, T.DoubleType):
            shown_as = F.format_string(f"%.{DIGITS}e", F.col(f.name)).try_cast("double")
            return F.when(F.col(f.name).isNotNull(), shown_as).alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        return F.col(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


@dataclass(frozen=True)
class Query:
    build: Callable[[Inputs], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(self.build(Inputs(spark, sf_dir)))


QUERIES: dict[str, Query] = {}


def query(key: str, sql: str | None = None, doubles: str = ""):
    """Register a builder under a key, with the SQL that gives the same rows.

    ``doubles`` names the result columns that the SQL side rounds.
    """

    def add(build: Callable[[Inputs], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = Query(build, None if sql is None else with_tables(sql.strip(), doubles, DIGITS))
        return build

    return add
