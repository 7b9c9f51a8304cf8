"""Named tables: create, replace, describe, audit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove_folder
from .files import footer_counts
from .versions import Versions


def ensure_db(spark: SparkSession, db: str, use: bool = False, location: str | None = None) -> None:
    """Create the database if it is missing; ``location`` is a shared folder for its files."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db){place}", args={"db": db})
    if use:
        spark.catalog.setCurrentDatabase(db)


def raw_name(name: str) -> str:
    """Raw tables carry the prefix ``raw_`` exactly once."""
    return name if name.startswith("raw_") else f"raw_{name}"


def scan_table(spark: SparkSession, db: str, name: str, raw: bool = False) -> DataFrame:
    return spark.table(f"{db}.{raw_name(name) if raw else name}")


def _shape(schema: T.StructType) -> set[tuple[str, str]]:
    return {(f.name, f.dataType.simpleString()) for f in schema.fields}


def _quoted(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_versions(spark: SparkSession, db: str, name: str, root: str | None = None) -> Versions:
    """The versions of a table: below ``root/db/name``, without ``root`` below the database's own folder."""
    base = f"{root}/{db}" if root else spark.catalog.getDatabase(db).locationUri
    return Versions(spark, f"{base}/{name}")


def replace_table(df: DataFrame, db: str, name: str, root: str | None = None, comment: str | None = None,
                  partition_by: Sequence[str] = (), bucket_by: tuple[int, Sequence[str]] | None = None,
                  allow_schema_change: bool = True, keep: int = 2) -> DataFrame:
    """Create or replace a Parquet table and return it.

    The new rows are a version of their own (:class:`Versions`): written in full, named in the table's
    log, and only then shown under the table's name, a view that is exchanged in one step.
    Whatever fails on the way, the old rows stay readable; the query may read the table it replaces.
    The last ``keep`` versions stay for readers that still use them, older files go. ``root``
    is a shared folder; without it the database's folder keeps the files. A comment stays until another one is given.
    """
    spark = df.sparkSession
    ensure_db(spark, db, location=root and f"{root}/{db}")
    target = _quoted(db, name)
    exists = spark.catalog.tableExists(target)
    if exists and not allow_schema_change and _shape(spark.table(target).schema) != _shape(df.schema):
        raise ValueError(f"{db}.{name}: columns differ from the existing table")
    versions = table_versions(spark, db, name, root)
    fresh = versions.fresh()
    writer = df.write.format("parquet").mode("errorifexists").option("path", f"{versions.root}/{fresh}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        count, keys = bucket_by
        writer = writer.bucketBy(count, *keys).sortBy(*keys)
    ensure_db(spark, _versions_db(db))
    stored_as = _quoted(_versions_db(db), _version_table(name, fresh))
    try:
        writer.saveAsTable(stored_as)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {stored_as}")
        remove_folder(spark, f"{versions.root}/{fresh}")
        raise
    versions.commit(fresh, df.schema)
    show_table(spark, db, name, root, comment)
    expire_versions(spark, db, name, root, keep)
    return spark.table(target)


def _versions_db(db: str) -> str:
    return f"{db}__versions"


def _version_table(name: str, version: str) -> str:
    return f"{name}__{version.replace('-', '_')}"


def show_table(spark: SparkSession, db: str, name: str, root: str | None = None, comment: str | None = None) -> None:
    """Let the table's name show the version that its log says is current (after a run that ended in between, too)."""
    at = table_versions(spark, db, name, root).current()
    target, exists = _quoted(db, name), spark.catalog.tableExists(_quoted(db, name))
    if exists:
        found = spark.catalog.getTable(target)
        comment = comment if comment is not None else found.description
        if found.tableType != "VIEW":  # a plain table from elsewhere makes room once
            spark.sql(f"DROP TABLE {target}")
    columns = ", ".join(_quoted(c) for c in at.schema.names)
    said = f" COMMENT {_text(comment)}" if comment else ""
    spark.sql(f"CREATE OR REPLACE VIEW {target}{said} AS SELECT {columns} FROM {_quoted(_versions_db(db), _version_table(name, at.name))}")


def expire_versions(spark: SparkSession, db: str, name: str, root: str | None = None, keep: int = 1) -> int:
    """Delete all but the last ``keep`` versions of a table, and return how many went."""
    gone = table_versions(spark, db, name, root).expire(keep)
    for v in gone:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(_versions_db(db), _version_table(name, v.name))}")
    return len(gone)


def set_comment(spark: SparkSession, db: str, name: str, text: str) -> None:
    spark.sql(f"ALTER VIEW {_quoted(db, name)} SET TBLPROPERTIES ('comment' = {_text(text)})")


def get_comment(spark: SparkSession, db: str, name: str) -> str | None:
    return spark.catalog.getTable(_quoted(db, name)).description


def set_property(spark: SparkSession, db: str, name: str, key: str, value: str) -> None:
    """A property of the table as it is now: replacing the table takes it away."""
    spark.sql(f"ALTER VIEW {_quoted(db, name)} SET TBLPROPERTIES ({_text(key)} = {_text(value)})")


def get_property(spark: SparkSession, db: str, name: str, key: str) -> str | None:
    if not spark.catalog.databaseExists(db) or not spark.catalog.tableExists(_quoted(db, name)):
        return None
    return next((r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {_quoted(db, name)}").collect() if r["key"] == key), None)


def run_sql(spark: SparkSession, text: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """SQL text with named parameters; names of tables go through ``IDENTIFIER(:name)``."""
    return spark.sql(text, args=dict(args or {}))


def row_counts(frames: Mapping[str, DataFrame | str]) -> DataFrame:
    """(table_name, row_count), one row per table. A path of Parquet files is counted from their footers, no row is read."""
    derived = {n: df for n, df in frames.items() if not isinstance(df, str)}
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in derived.items()]
    paths = {n: path for n, path in frames.items() if isinstance(path, str)}
    if paths:
        spark = next(iter(derived.values())).sparkSession if derived else SparkSession.active()
        found = footer_counts(spark, paths)
        # a row a table, brought over from the session that counts by footers
        counts.append(spark.createDataFrame(found.collect(), found.schema) if derived else found)
    return reduce(lambda a, b: a.unionByName(b), counts)


def missing_tables(spark: SparkSession, db: str, expected: Sequence[str]) -> list[str]:
    """Expected table names that the database does not have; temporary views do not count."""
    listed = spark.catalog.listTables(db) if spark.catalog.databaseExists(db) else []
    present = {t.name for t in listed if not t.isTemporary}
    return [name for name in expected if name not in present]
