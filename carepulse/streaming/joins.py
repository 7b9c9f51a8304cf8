"""Joins of streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packed import packed
from .skew import salts_of


@dataclass(frozen=True)
class TimeBound:
    """Event-time limit for a join: right rows within ``before``/``after`` of the left row."""

    left_time: str
    right_time: str
    delay: str
    before: str
    after: str


def stream_join(left: DataFrame, right: DataFrame, on: str, salts: int | Mapping[object, int] = 8,
                bound: TimeBound | None = None, rename: Mapping[str, str] | None = None, pack: bool = False) -> DataFrame:
    """Inner equi-join of two streams in append mode.

    Without ``bound`` both sides stay in state for good, as an unbounded inner
    join must; run it with the RocksDB state store when the state outgrows
    memory. AQE does not act on streams, so a hot key is split by hand: a left row goes to
    one of its key's sub-keys, a right row (of the smaller side) to all of them. ``salts`` gives the sub-keys of
    each hot key, as :func:`carepulse.streaming.skew.hot_keys` finds them, and other keys are stored once; a
    number splits every key so far. The result is the same. It must not change while a checkpoint is in use. On batch tables
    nothing is salted, since AQE splits a hot key there.

    With ``pack`` the left rows of a sub-key that come in one batch are kept and looked up as arrays
    (:func:`carepulse.streaming.packed.packed`), so that the cost of state goes by keys instead of rows; the result is the same.
    Like ``salts`` it must not change while a checkpoint is in use. A ``bound`` is by row and can't be packed.

    Columns other than the key that both sides have are an error, unless
    ``rename`` (``{right column: name in the result}``) tells them apart.
    """
    names = dict(rename or {})
    taken = [names.get(c, c) for c in right.columns if c != on]
    clash = sorted(set(left.columns) & set(taken))
    if clash:
        raise ValueError(f"both sides have the columns {clash}; rename those of the right side")
    if pack and bound is not None:
        raise ValueError("a bound is by row: rows can't be packed")
    if bound is not None and left.isStreaming:
        left = left.withWatermark(bound.left_time, bound.delay)
        right = right.withWatermark(bound.right_time, bound.delay)
    streaming = left.isStreaming or right.isStreaming
    parts = salts_of(F.col(on), salts) if streaming else None
    spread, copies = left.alias("l"), right.alias("r")
    match = F.col(f"l.{on}") == F.col(f"r.{on}")
    if parts is not None:
        spread = left.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), parts).cast("int")).alias("l")
        copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).alias("r")
        match = match & (F.col("l._salt") == F.col("r._salt"))
    if bound is not None:
        lt, rt = F.col(f"l.{bound.left_time}"), F.col(f"r.{bound.right_time}")
        match = match & (rt >= lt - F.expr(f"INTERVAL {bound.before}")) & (rt <= lt + F.expr(f"INTERVAL {bound.after}"))
    if pack and streaming:
        keys = [on] if parts is None else [on, "_salt"]
        both = packed(spread, keys).alias("l").join(copies, match, "inner")
        taken = [F.col(f"r.{c}").alias(names.get(c, c)) for c in right.columns if c != on]
        return both.select(F.inline("l.rows"), *taken).select(*left.columns, *[names.get(c, c) for c in right.columns if c != on])
    return spread.join(copies, match, "inner").select(
        *[F.col(f"l.{c}") for c in left.columns],
        *[F.col(f"r.{c}").alias(names.get(c, c)) for c in right.columns if c != on],
    )


def enrich_stream(stream: DataFrame, static: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join of a stream with a reference table, which is read anew for every batch."""
    return stream.join(static, on=on, how="left")


def live_join(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Inner join of two pipeline tables that is recomputed in full."""
    return left.join(right, on=on, how="inner")


def with_order_amounts(df: DataFrame, qty: str = "OrderQty", price: str = "UnitPrice", line_total: str = "LineTotal") -> DataFrame:
    """Adds ``ExtendedPrice`` (quantity times price) and ``TotalDiscount`` (what the line total lacks of it)."""
    gross = F.col(qty) * F.col(price)
    return df.withColumns({"ExtendedPrice": gross, "TotalDiscount": gross - F.col(line_total)})


#: Column names of the flat order table that differ from its inputs.
FLAT_RENAMES = {
    "ModifiedDate": "OrderModifiedDate",
    "Name": "ProductName",
    "Color": "ProductColor",
    "Size": "ProductSize",
    "Weight": "ProductWeight",
}
#: Columns taken from the order lines and from the products.
ORDER_COLUMNS = ["SalesOrderID", "SalesOrderDetailID", "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal", "ModifiedDate"]
PRODUCT_COLUMNS = [
    "ProductID", "Name", "ProductNumber", "Color", "StandardCost", "ListPrice", "Size", "Weight",
    "ProductCategoryID", "ProductModelID", "SellStartDate", "SellEndDate", "DiscontinuedDate",
]


def flat_orders(order_lines: DataFrame, products: DataFrame, salts: int | Mapping[object, int] = 8,
                bound: TimeBound | None = None, pack: bool = False) -> DataFrame:
    """Order lines with their product, flat; works on streams and on batch tables alike.

    ``pack`` as in :func:`stream_join`. ``bound`` (order ``ModifiedDate`` against a product time such as ``SellStartDate``) limits what the streams keep.
    """
    lines = order_lines.select("ProductID", *ORDER_COLUMNS)
    joined = stream_join(lines, products.select(*PRODUCT_COLUMNS), "ProductID", salts, bound, pack=pack)
    return with_order_amounts(joined.select(*ORDER_COLUMNS, *PRODUCT_COLUMNS)).withColumnsRenamed(FLAT_RENAMES)
