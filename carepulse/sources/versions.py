"""Versions of an output side by side in one folder, and a log that says which one counts.

A version is written in full to a folder of its own, and only then named in the log,
as one file that appears at once. Until that file is there readers get the version
before; a job that fails on the way leaves no trace in the log. Old versions stay for readers that
still use them, until they expire.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import remove_folder

_LOG = "number long, name string, schema string"


class ConflictError(RuntimeError):
    """Another writer committed the same number first."""


@dataclass(frozen=True)
class Version:
    number: int
    name: str
    path: str
    schema: T.StructType | None


class Versions:
    """The versions below ``root``, a shared folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def all(self) -> list[Version]:
        """Committed versions, oldest first; one small file each is read."""
        try:
            entries = self.spark.read.schema(_LOG).parquet(f"{self.root}/log/*").collect()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        first: dict[int, tuple] = {}
        for r in entries:  # if two writers got the same number, the smaller name stands
            first[r["number"]] = min(first.get(r["number"], tuple(r)), tuple(r))
        return [Version(n, name, f"{self.root}/{name}", schema and T.StructType.fromJson(json.loads(schema)))
                for n, name, schema in sorted(first.values())]

    def current(self) -> Version | None:
        return next(reversed(self.all()), None)

    def fresh(self) -> str:
        """The name of a version to be; its folder is ``root/name``."""
        return f"v-{uuid.uuid4().hex}"

    def commit(self, name: str, schema: T.StructType | None = None) -> Version:
        """Make the complete folder ``root/name`` the current version."""
        number = (at.number if (at := self.current()) else 0) + 1
        entry = [(number, name, schema.json() if schema else None)]
        rows = self.spark.createDataFrame(entry, _LOG).coalesce(1)
        rows.write.mode("append").parquet(f"{self.root}/log/{number:012d}")
        stands = next(v for v in self.all() if v.number == number)
        if stands.name != name:
            raise ConflictError(f"{self.root}: version {number} was committed by another writer")
        return stands

    def write(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> Version:
        """Write ``df`` as the new current version; it may read the version it replaces."""
        name = self.fresh()
        try:
            df.write.partitionBy(*partition_by).parquet(f"{self.root}/{name}")
        except Exception:
            remove_folder(self.spark, f"{self.root}/{name}")
            raise
        return self.commit(name, df.schema)

    def read(self, number: int | None = None) -> DataFrame:
        """The rows of the current version, or of a given one as long as it has not expired."""
        found = [v for v in self.all() if number is None or v.number == number]
        if not found:
            raise LookupError(f"{self.root} has no version {number or ''}".rstrip())
        at = found[-1]
        return self.spark.read.schema(at.schema).parquet(at.path).select(*at.schema.names)

    def expire(self, keep: int = 1, *others: str) -> list[Version]:
        """Delete all but the last ``keep`` versions, files first, and return them.

        ``others`` are further folders that hold a folder for each version (checkpoints).
        """
        if keep < 1:
            raise ValueError("the current version is always kept")
        gone = self.all()[:-keep]
        for v in gone:
            for folder in (self.root, *others):
                remove_folder(self.spark, f"{folder}/{v.name}")
            remove_folder(self.spark, f"{self.root}/log/{v.number:012d}")
        return gone
