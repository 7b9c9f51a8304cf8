"""Read a table of a remote database in place."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession


@dataclass(frozen=True)
class Partitioning:
    """Split a remote scan into parallel range queries on a numeric or date column."""

    column: str
    lower: str
    upper: str
    tasks: int


def jdbc_options(url: str, table: str, partition: Partitioning | None = None, fetch_size: int = 10_000,
                 extra: Mapping[str, str] | None = None) -> dict[str, str]:
    options = {
        "url": url,
        "dbtable": table,
        "fetchsize": str(fetch_size),
        "pushDownPredicate": "true",
        "pushDownAggregate": "true",
    }
    if partition is not None:
        options |= {
            "partitionColumn": partition.column,
            "lowerBound": partition.lower,
            "upperBound": partition.upper,
            "numPartitions": str(partition.tasks),
        }
    return options | dict(extra or {})


def scan_jdbc(spark: SparkSession, url: str, table: str, predicate: Column | None = None,
              partition: Partitioning | None = None, extra: Mapping[str, str] | None = None) -> DataFrame:
    """Remote table as a DataFrame; filters, columns and aggregates are pushed to the database.

    Without ``partition`` one task reads everything, so give one for a large table.
    """
    df = spark.read.format("jdbc").options(**jdbc_options(url, table, partition, extra=extra)).load()
    return df if predicate is None else df.where(predicate)
