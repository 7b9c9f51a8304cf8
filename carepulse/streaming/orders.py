"""The order pipeline: three landing copies and the flat order table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.versions import Versions
from .joins import TimeBound, flat_orders
from .skew import hot_keys, kept_hot_keys
from .tables import in_generation, read_stream, start_available

COPIES = ("customer", "product", "salesorderdetail")
FLAT = "sales_orders_flat"


def update_sales_orders(landing: Mapping[str, DataFrame], target: str, full_refresh: bool = False,
                        salts: int | None = None, bound: TimeBound | None = None, max_files: int | None = 1000,
                        pack: bool = True) -> dict[str, DataFrame]:
    """Bring all four tables up to date, then stop; a later call adds only newer rows.

    All four tables are one generation: a full refresh that fails in any of them leaves all four as they were.
    ``landing`` holds the three input streams and ``target`` is a shared folder.
    The flat table reads the copies, not the landing area, ``max_files`` new files a batch.
    Hot products are found by a sketch of the order lines that have landed when a generation begins, and kept with its checkpoint;
    a number of ``salts`` splits every product instead. ``bound`` goes to :func:`flat_orders` and bounds the state.
    Without it the lines of a product are kept in arrays (``pack``); a generation that began without that goes on with ``pack=False``.
    """
    spark = landing["product"].sparkSession
    flat_schema = None

    def update(generation: str) -> None:
        nonlocal flat_schema
        base = f"{target}/{generation}"

        def start(name: str, stream: DataFrame) -> StreamingQuery:
            return start_available(stream, f"{base}/{name}/data", f"{base}/{name}/checkpoint")

        running: list[StreamingQuery] = []
        try:
            for name in COPIES:  # side by side
                running.append(start(name, landing[name]))
            for query in running:
                query.awaitTermination()
        finally:
            for query in running:
                query.stop()
        copies = {name: read_stream(spark, f"{base}/{name}/data", landing[name].schema, max_files=max_files) for name in COPIES}
        lines = spark.read.schema(landing["salesorderdetail"].schema).parquet(f"{base}/salesorderdetail/data")
        split = salts or kept_hot_keys(f"{base}/{FLAT}/hot-keys", lambda: hot_keys(lines, "ProductID"), lines, "ProductID")
        flat = flat_orders(copies["salesorderdetail"], copies["product"], split, bound, pack=pack and bound is None)
        flat_schema = flat.schema
        start(FLAT, flat).awaitTermination()

    at = in_generation(Versions(spark, target), update, full_refresh)
    schemas = {**{n: landing[n].schema for n in COPIES}, FLAT: flat_schema}
    return {n: spark.read.schema(schema).parquet(f"{at.path}/{n}/data") for n, schema in schemas.items()}
