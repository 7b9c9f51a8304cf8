"""Enrichment of a stream by a versioned table, so that a batch that is run again gives the same rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..sources.versions import Version, Versions
from .joins import enrich_stream
from .tables import in_generation, start_available

_OPENED, _CLOSED = "run int, version long", "run int, batch long"


def _rows(spark: SparkSession, path: str, schema: str) -> list:
    try:
        return spark.read.schema(schema).parquet(path).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def pins(spark: SparkSession, root: str) -> dict[int, tuple[int, list[int] | None]]:
    """{run: (version, its batches)} of a generation's folder; a run that hasn't ended well has no batches yet."""
    opened = {r["run"]: r["version"] for r in _rows(spark, f"{root}/pins/opened/*", _OPENED)}
    done: dict[int, list[int]] = {}
    for r in _rows(spark, f"{root}/pins/closed/*", _CLOSED):
        done.setdefault(r["run"], []).append(r["batch"])
    return {run: (version, sorted(b for b in done[run] if b >= 0) if run in done else None) for run, version in sorted(opened.items())}


def run_pinned(stream: DataFrame, reference: Versions, on: str | Sequence[str], root: str, full_refresh: bool = False) -> Version:
    """Left join of what is new in the stream with a version of ``reference``; returns the generation, rows in ``path/data``.

    The version is written down before the first batch of a run, and all batches of the run use it. A run that
    fails leaves its version open: the next one begins with the batch that was not finished, and takes that version
    again, so what is written does not hang on when the batch ran. The run after that takes the current version. Versions
    of open runs must not expire (:func:`open_version`).
    """
    spark = stream.sparkSession

    def run(generation: str) -> None:
        base = f"{root}/{generation}"
        known = pins(spark, base)
        number = max(known, default=0)
        if number and known[number][1] is None:
            version = known[number][0]
        else:
            number, version = number + 1, reference.current().number
            opened = spark.createDataFrame([(number, version)], _OPENED).coalesce(1)
            opened.write.mode("errorifexists").parquet(f"{base}/pins/opened/{number:09d}")
        joined = enrich_stream(stream, reference.read(version), on)
        query = start_available(joined, f"{base}/data", f"{base}/checkpoint")
        query.awaitTermination()
        batches = sorted({p["batchId"] for p in query.recentProgress if p["numInputRows"]}) or [-1]
        closed = spark.createDataFrame([(number, b) for b in batches], _CLOSED).coalesce(1)
        closed.write.mode("errorifexists").parquet(f"{base}/pins/closed/{number:09d}")

    return in_generation(Versions(spark, root), run, full_refresh)


def open_version(spark: SparkSession, root: str) -> int | None:
    """The version that an unfinished run of the current generation still needs."""
    at = Versions(spark, root).current()
    runs = pins(spark, at.path) if at else {}
    return next((version for version, batches in runs.values() if batches is None), None)
