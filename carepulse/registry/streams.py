"""Streaming operators. Each run reads a supplied table as a file stream, in full, to the end."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.shaping import where
from ..session import shared_dir
from ..sources.tables import replace_table
from ..sources.versions import Versions
from ..streaming import joins, tables as st
from ..streaming.orders import FLAT, update_sales_orders
from ..streaming.pinned import run_pinned
from ..streaming.skew import hot_keys
from .bindings import BINDINGS
from .core import query
from .inputs import Inputs


def _source(t: Inputs, name: str) -> str:
    """A supplied table's path as a pattern, so that it may be one file or a directory of parts."""
    return f"{t.sf_dir}/{name}.parque[t]"


def _stream(t: Inputs, name: str):
    return st.read_stream(t.spark, _source(t, name), t.supplied(name).schema)


def _drain(t: Inputs, stream, purpose: str):
    base = shared_dir(t.spark, purpose)
    return t.spark.read.parquet(st.run_available(stream, f"{base}/data", f"{base}/checkpoint"))


def _feed(t: Inputs, binding: str, table: str):
    """A supplied table as a stream, in the shape of a feed."""
    return t.spark.sql(BINDINGS[binding], **{table: _stream(t, table)})


@query("stream_passthrough", "SELECT * FROM customer")
def _copy(t: Inputs):
    base = shared_dir(t.spark, "copy")
    path = st.stream_copy(
        t.spark, _source(t, "customer"), t.supplied("customer").schema, f"{base}/data", f"{base}/checkpoint"
    )
    return t.spark.read.parquet(path)


@query("stream_stream_inner_join", """
SELECT l_orderkey, l_linenumber, l_quantity, p.p_partkey, p.p_name, p.p_retailprice FROM lineitem JOIN part p ON l_partkey = p_partkey""")
def _join(t: Inputs):
    lines = _stream(t, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.col("l_partkey").alias("p_partkey"))
    parts = _stream(t, "part").select("p_partkey", "p_name", "p_retailprice")
    hot = hot_keys(t.supplied("lineitem"), "l_partkey")
    return _drain(t, joins.stream_join(lines, parts, "p_partkey", hot, pack=True), "join")


@query("stream_computed_cols", """
SELECT *, OrderQty * UnitPrice AS ExtendedPrice, OrderQty * UnitPrice - LineTotal AS TotalDiscount FROM order_lines""")
def _computed(t: Inputs):
    return _drain(t, joins.with_order_amounts(_feed(t, "order_lines", "lineitem")), "computed")


@query("st_sales_orders_flat", "SELECT * FROM sales_orders_flat", "StandardCost ListPrice")
def _flat(t: Inputs):
    """Three landing copies, then the flat table from two of the copies."""
    landing = {
        "customer": _stream(t, "customer"),
        "product": _feed(t, "products", "part"),
        "salesorderdetail": _feed(t, "order_lines", "lineitem"),
    }
    return update_sales_orders(landing, shared_dir(t.spark, "orders"))[FLAT]


@query("stream_static_left_join", """
SELECT event_id, user_id, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey""")
def _enrich(t: Inputs):
    people = t.supplied("customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    stream = _stream(t, "events").select("event_id", "user_id")
    return _drain(t, joins.enrich_stream(stream, people, "user_id"), "enrich")


@query("stream_pinned_join", """
SELECT event_id, user_id, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey""")
def _pinned(t: Inputs):
    """The same join with a version of the table that is written down with the run."""
    base = shared_dir(t.spark, "pinned")
    people = Versions(t.spark, f"{base}/customer")
    people.write(t.supplied("customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment"))
    stream = _stream(t, "events").select("event_id", "user_id")
    return t.spark.read.parquet(f"{run_pinned(stream, people, 'user_id', f'{base}/out').path}/data").select("event_id", "user_id", "c_mktsegment")


@query("live_table_join", "SELECT o_orderkey, o_custkey, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def _live(t: Inputs):
    people = t.supplied("customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    joined = joins.live_join(t.supplied("orders").select("o_orderkey", "o_custkey"), people, "o_custkey")
    return replace_table(joined, "carepulse_live", "orders_live", shared_dir(t.spark, "live"))


@query("incremental_trigger", "SELECT * FROM orders")
def _incremental(t: Inputs):
    """Two landings and a run after each; the second run adds only the second landing."""
    base, orders = shared_dir(t.spark, "incremental"), t.supplied("orders")
    done = F.col("o_orderstatus") == "F"
    for landing in (where(orders, done), where(orders, ~done)):
        landing.write.mode("append").parquet(f"{base}/landing")
        out = st.stream_copy(t.spark, f"{base}/landing", orders.schema, f"{base}/data", f"{base}/checkpoint")
    return t.spark.read.parquet(out)


@query("full_refresh", "SELECT * FROM supplier")
def _refresh(t: Inputs):
    base, suppliers = shared_dir(t.spark, "refresh"), t.supplied("supplier")
    for again in (False, True):
        path = st.stream_copy(
            t.spark, _source(t, "supplier"), suppliers.schema, f"{base}/data", f"{base}/checkpoint", full_refresh=again
        )
    return t.spark.read.parquet(path)


@query("pipeline_temp_view", "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY ALL")
def _view(t: Inputs):
    view = st.temp_view(t.supplied("customer"), "customers_by_segment")
    return view.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers"))
