"""Sources, sinks and catalog operators, each over a whole supplied table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.spine import values
from ..session import shared_dir
from ..sources import files, tables
from .core import query
from .inputs import Inputs

DB = "carepulse_checks"
ORDERS = ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
          "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING")


@query("scan_parquet_dir", "SELECT * FROM orders")
def _scan_dir(t: Inputs):
    return files.scan_parquet(t.spark, f"{t.sf_dir}/orders.parquet", ORDERS)


@query("scan_table", "SELECT * FROM part")
def _scan_table(t: Inputs):
    tables.replace_table(t.supplied("part"), DB, tables.raw_name("part"), shared_dir(t.spark, "tables"))
    return tables.scan_table(t.spark, DB, "part", raw=True)


@query("write_replace_table", """
SELECT o_orderstatus, count(*) AS orders_total, sum(floor(o_totalprice)) AS whole_price FROM orders GROUP BY ALL""")
def _replace(t: Inputs):
    """Replace a table by a query over itself."""
    root = shared_dir(t.spark, "tables")
    first = tables.replace_table(t.supplied("orders"), DB, "order_summary", root)
    summary = first.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders_total"), F.sum(F.floor("o_totalprice").cast("double")).alias("whole_price")
    )
    return tables.replace_table(summary, DB, "order_summary", root)


@query("write_overwrite_schema", "SELECT s_suppkey, s_nationkey, s_acctbal < 0 AS in_debt FROM supplier")
def _overwrite(t: Inputs):
    root = shared_dir(t.spark, "tables")
    suppliers = t.supplied("supplier")
    tables.replace_table(suppliers, DB, "supplier_debt", root)
    debts = suppliers.select("s_suppkey", "s_nationkey", (F.col("s_acctbal") < 0).alias("in_debt"))
    return tables.replace_table(debts, DB, "supplier_debt", root, allow_schema_change=True)


@query("write_n_files", """
SELECT CAST(5 AS BIGINT) AS files, count(*) AS rows_total, sum(l_quantity) AS quantity FROM lineitem""")
def _n_files(t: Inputs):
    path = shared_dir(t.spark, "lines")
    files.write_parquet_files(t.supplied("lineitem"), path, 5)
    back = files.scan_parquet(t.spark, path).withColumn("_file", F.input_file_name())
    per_file = back.groupBy("_file").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    return per_file.agg(
        F.count(F.lit(1)).alias("files"), F.sum("n").alias("rows_total"), F.sum("q").alias("quantity")
    )


@query("table_comment", """
SELECT 'Customers, written ''as is'' \\ whole.' AS comment, count(*) AS row_count FROM customer""")
def _comment(t: Inputs):
    text = "Customers, written 'as is' \\ whole."
    saved = tables.replace_table(t.supplied("customer"), DB, "customer_described", shared_dir(t.spark, "tables"), text)
    stored = tables.get_comment(t.spark, DB, "customer_described")
    return saved.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(stored).alias("comment"), "row_count")


@query("create_namespace", "SELECT 'carepulse_checks' AS db, count(*) AS row_count FROM part")
def _namespace(t: Inputs):
    saved = tables.replace_table(t.supplied("part"), DB, "part_copy", shared_dir(t.spark, "tables"))
    tables.ensure_db(t.spark, DB)
    return saved.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(DB).alias("db"), "row_count")


@query("param_sql", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL")
def _param(t: Inputs):
    t.supplied("orders").createOrReplaceTempView("orders_by_status")
    return tables.run_sql(
        t.spark,
        "SELECT o_orderpriority, count(*) AS n FROM IDENTIFIER(:t) WHERE o_orderstatus = :status GROUP BY o_orderpriority",
        {"t": "orders_by_status", "status": "F"},
    )


@query("ts_to_iso_ms", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS ts,
  CASE WHEN value < 5 THEN 'NaT' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') END AS seen_at FROM events""")
def _encode(t: Inputs):
    events = t.supplied("events").select("event_id", "ts", F.when(F.col("value") >= 5, F.col("ts")).alias("seen_at"))
    return files.encode_iso(events, ["ts", "seen_at"])


@query("iso_to_ts", "SELECT visit_id, try_cast(provider_start_time AS TIMESTAMP) AS provider_start_time FROM raw_er_visits")
def _decode(t: Inputs):
    return files.decode_iso(t.raw("raw_er_visits").select("visit_id", "provider_start_time"), ["provider_start_time"])


@query("floor_ts_ms", "SELECT event_id, date_trunc('millisecond', ts) AS ts FROM events")
def _floor(t: Inputs):
    return files.floor_ms(t.supplied("events").select("event_id", "ts"), ["ts"])


@query("row_count_audit", """
SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'silver_er_visits', count(*) FROM silver_er_visits
UNION ALL SELECT 'gold_er_quality_daily', count(*) FROM gold_er_quality_daily""")
def _audit(t: Inputs):
    """A stored table is counted from its footers, the others as they are computed."""
    return tables.row_counts({
        "orders": f"{t.sf_dir}/orders.parquet", "silver_er_visits": t.visits, "gold_er_quality_daily": t.served_path("quality"),
    })


_COUNTED = "region nation customer supplier part orders lineitem events".split()


@query("row_count_footers", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in _COUNTED))
def _footers(t: Inputs):
    """Counts of stored tables without reading a column."""
    return files.footer_counts(t.spark, {n: f"{t.sf_dir}/{n}.parquet" for n in _COUNTED})


@query("expect_tables", """
SELECT 'orders_checked' AS table_name, FALSE AS missing, count(*) AS row_count FROM orders
UNION ALL SELECT 'customer_checked', FALSE, count(*) FROM customer UNION ALL SELECT 'never_written', TRUE, NULL""")
def _expect(t: Inputs):
    """Expected tables with their row counts; a table that is absent is marked."""
    root, db = shared_dir(t.spark, "tables"), "carepulse_expected"
    saved = {f"{n}_checked": tables.replace_table(t.supplied(n), db, f"{n}_checked", root) for n in ("orders", "customer")}
    absent = tables.missing_tables(t.spark, db, [*saved, "never_written"])
    expected = values(t.spark, [(n, n in absent) for n in [*saved, "never_written"]], "table_name string, missing boolean")
    return expected.join(tables.row_counts(saved), "table_name", "left")
