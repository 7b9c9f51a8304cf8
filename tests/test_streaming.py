"""Incremental copies and stream joins."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carepulse.sources.schemas import ORDERS_LANDING
from carepulse.streaming import joins, orders, tables as st
from carepulse.streaming.orders import update_sales_orders
from carepulse.streaming.packed import packed
from carepulse.streaming.skew import hot_keys, kept_hot_keys
from helpers import plan_of, rows


@pytest.fixture
def land(spark, tmp_path):
    def add(name, df):
        df.write.mode("append").parquet(str(tmp_path / name))
        return st.read_stream(spark, str(tmp_path / name), df.schema)

    return add


@pytest.fixture
def update(spark, tmp_path):
    def run(stream, name, **kw):
        return spark.read.parquet(st.run_available(stream, str(tmp_path / name), str(tmp_path / f"{name}-ckpt"), **kw))

    return run


def test_second_run_adds_only_new_rows(spark, land, update):
    first = land("src", spark.range(3))
    assert update(first, "out").count() == 3
    assert update(first, "out").count() == 3
    assert rows(update(land("src", spark.range(3, 5)), "out")) == [(i,) for i in range(5)]


def test_full_refresh_starts_over(spark, land, update):
    stream = land("src", spark.range(3))
    update(stream, "out")
    assert rows(update(stream, "out", full_refresh=True)) == [(0,), (1,), (2,)]


@pytest.mark.parametrize("salts", [1, 8])
def test_stream_join_over_two_runs_equals_the_batch_join(spark, land, update, salts):
    """A third of the lines share one product; products arrive before and after their lines."""
    lines = spark.range(90).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 10).alias("p"))
    products = spark.range(12).select(F.col("id").alias("p"), F.concat(F.lit("n"), "id").alias("name"))
    update(joins.stream_join(land("l", lines.where("id < 40")), land("r", products.where("p >= 5")), "p", salts), "out")
    out = update(joins.stream_join(land("l", lines.where("id >= 40")), land("r", products.where("p < 5")), "p", salts), "out")
    assert rows(out, "id", "p", "name") == rows(lines.join(products, "p"), "id", "p", "name")


def test_time_bound_drops_far_pairs(spark, table, land, update):
    def at(minute):
        return dt.datetime(2025, 1, 1, 0, minute)

    left = land("l", table("k int, lt timestamp", (1, at(0)), (1, at(30))))
    right = land("r", table("k int, rt timestamp, v int", (1, at(1), 10), (1, at(29), 20)))
    bound = joins.TimeBound("lt", "rt", "1 hour", "5 minutes", "5 minutes")
    assert rows(update(joins.stream_join(left, right, "k", 2, bound), "out"), "lt", "v") == [(at(0), 10), (at(30), 20)]


def test_columns_of_both_sides_are_an_error_or_renamed(table, land, update):
    left = land("l", table("k int, note string", (1, "mine")))
    right = land("r", table("k int, note string", (1, "yours")))
    with pytest.raises(ValueError, match="note"):
        joins.stream_join(left, right, "k")
    out = update(joins.stream_join(left, right, "k", rename={"note": "other_note"}), "out")
    assert rows(out, "k", "note", "other_note") == [(1, "mine", "yours")]


def test_batch_join_is_not_salted(table):
    plan = plan_of(joins.stream_join(table("k int, a int", (1, 2)), table("k int, b int", (1, 3)), "k"))
    assert "Generate" not in plan and "xxhash64" not in plan


def test_order_pipeline_with_bound_and_small_batches(spark, tmp_path, land):
    """Two landings per table, one file a batch; pairs further apart than the bound are left out."""
    day = [dt.datetime(2025, 1, 1), dt.datetime(2025, 3, 1)]
    for o in (1, 2):
        land("customer", spark.createDataFrame([(o, "a", "b")], ORDERS_LANDING["customer"]))
        land("product", spark.createDataFrame([(o, *[None] * 9, day[0], None, None)], ORDERS_LANDING["product"]))
        land("salesorderdetail", spark.createDataFrame(
            [(o, 1, 2, o, Decimal("1.50"), Decimal(0), Decimal("2.75"), day[o - 1])], ORDERS_LANDING["salesorderdetail"]))
    streams = {n: st.read_stream(spark, str(tmp_path / n), s, max_files=1) for n, s in ORDERS_LANDING.items()}
    bound = joins.TimeBound("ModifiedDate", "SellStartDate", "100 days", "10 days", "10 days")
    out = update_sales_orders(streams, str(tmp_path / "target"), salts=2, bound=bound, max_files=1)
    assert rows(out["sales_orders_flat"], "SalesOrderID") == [(1,)] and out["salesorderdetail"].count() == 2


def test_flat_orders(table, land, update):
    lines = table(
        "SalesOrderID int, SalesOrderDetailID int, OrderQty int, ProductID int, UnitPrice double, UnitPriceDiscount double, LineTotal double, ModifiedDate timestamp",
        (1, 1, 3, 7, 10.0, 0.1, 27.0, dt.datetime(2025, 1, 1)), (1, 2, 1, 99, 5.0, 0.0, 5.0, None))
    products = table(
        "ProductID int, Name string, ProductNumber string, Color string, Size string, StandardCost double, ListPrice double, Weight double, "
        "ProductCategoryID int, ProductModelID int, SellStartDate timestamp, SellEndDate timestamp, DiscontinuedDate timestamp",
        (7, "bike", "B-7", "red", "M", 1.0, 10.0, 2.0, 3, 4, dt.datetime(2020, 1, 1), None, None))
    out = update(joins.flat_orders(land("l", lines), land("p", products)), "out")
    assert out.columns == [
        "SalesOrderID", "SalesOrderDetailID", "OrderQty", "UnitPrice", "UnitPriceDiscount", "LineTotal", "OrderModifiedDate",
        "ProductID", "ProductName", "ProductNumber", "ProductColor", "StandardCost", "ListPrice", "ProductSize", "ProductWeight",
        "ProductCategoryID", "ProductModelID", "SellStartDate", "SellEndDate", "DiscontinuedDate", "ExtendedPrice", "TotalDiscount",
    ]
    assert rows(out, "SalesOrderID", "ProductName", "ExtendedPrice", "TotalDiscount") == [(1, "bike", 30.0, 3.0)]
    assert rows(joins.flat_orders(lines, products)) == rows(out)


def test_enrich_keeps_unmatched_stream_rows(table, land, update):
    stream = land("s", table("id int, region_id int", (1, 5), (2, 6)))
    out = update(joins.enrich_stream(stream, table("region_id int, region string", (5, "East")), "region_id"), "out")
    assert rows(out, "id", "region") == [(1, "East"), (2, None)]


def test_live_join_and_view(table):
    a, b = table("k int, x int", (1, 1), (2, 2)), table("k int, y int", (1, 9))
    assert rows(joins.live_join(a, b, "k")) == [(1, 1, 9)]
    assert rows(st.temp_view(a, "a_view").where("k = 2")) == [(2, 2)]


def test_order_pipeline_updates_and_refreshes(spark, tmp_path, land):
    def landing(orders):
        return {
            "customer": land("customer", spark.createDataFrame([(orders[0], "a", "b")], ORDERS_LANDING["customer"])),
            "product": land("product", spark.createDataFrame([(orders[0], *[None] * 12)], ORDERS_LANDING["product"])),
            "salesorderdetail": land("salesorderdetail", spark.createDataFrame(
                [(o, 1, 2, o, Decimal("1.50"), Decimal(0), Decimal("2.75"), None) for o in orders], ORDERS_LANDING["salesorderdetail"])),
        }

    target = str(tmp_path / "target")
    first = update_sales_orders(landing([1, 2]), target)
    assert rows(first["sales_orders_flat"], "SalesOrderID", "ExtendedPrice", "TotalDiscount") == [(1, Decimal("3.0000"), Decimal("0.250000"))]
    second = update_sales_orders(landing([2, 3]), target)
    assert rows(second["sales_orders_flat"], "SalesOrderID") == [(1,), (2,), (2,)] and second["salesorderdetail"].count() == 4
    streams = {n: st.read_stream(spark, str(tmp_path / n), s) for n, s in ORDERS_LANDING.items()}
    again = update_sales_orders(streams, target, full_refresh=True)
    assert rows(again["sales_orders_flat"], "SalesOrderID") == [(1,), (2,), (2,)] and again["customer"].count() == 2


def state_rows(stream, tmp_path, name):
    query = st.start_available(stream, str(tmp_path / name), str(tmp_path / f"{name}-ckpt"))
    query.awaitTermination()
    return [p for p in query.recentProgress if p["stateOperators"]][-1]["stateOperators"][0]["numRowsTotal"]


def test_hot_keys_of_a_sketch(spark):
    rows_ = spark.range(30_000).select(F.expr("CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 10 = 1 THEN 'b' WHEN id % 7 = 0 THEN NULL ELSE CAST(id AS STRING) END").alias("k"))
    found = hot_keys(rows_, "k", 0.05)
    n = rows_.where("k IS NOT NULL").count()
    assert set(found) == {"a", "b"} and found["a"] == -(-10_000 // int(0.05 * n)) and found["b"] >= 2
    assert hot_keys(rows_.where("k < 'a'"), "k", 0.05) == {} == hot_keys(rows_.limit(0), "k")


@pytest.mark.parametrize("hot", [0, 600])
def test_only_hot_keys_are_stored_more_than_once(spark, land, tmp_path, hot):
    """900 lines over 100 products, all alike or two thirds of one; a copy in state only for that one."""
    lines = spark.range(900).select("id", F.when(F.col("id") < hot, 7).otherwise(F.col("id") % 100).alias("p"))
    products = spark.range(100).select(F.col("id").alias("p"), F.concat(F.lit("n"), "id").alias("name"))
    found = hot_keys(lines, "p", 0.1)
    assert list(found) == ([7] if hot else [])
    left, right = land("l", lines), land("r", products)
    assert state_rows(joins.stream_join(left, right, "p", found), tmp_path, "hot") == 900 + 100 + sum(n - 1 for n in found.values())
    assert state_rows(joins.stream_join(left, right, "p", 8), tmp_path, "all") == 900 + 8 * 100
    for name in ("hot", "all"):
        assert rows(spark.read.parquet(str(tmp_path / name)), "id", "p", "name") == rows(lines.join(products, "p"), "id", "p", "name")


def test_hot_keys_stay_with_the_checkpoint(spark, table, tmp_path):
    path, like = str(tmp_path / "hot"), table("p int, x int", (1, 1))
    assert kept_hot_keys(path, lambda: {5: 3, 6: 2}, like, "p") == {5: 3, 6: 2}
    assert kept_hot_keys(path, lambda: {9: 9}, like, "p") == {5: 3, 6: 2}
    assert kept_hot_keys(str(tmp_path / "none"), dict, like, "p") == {} == kept_hot_keys(str(tmp_path / "none"), lambda: {1: 1}, like, "p")


@pytest.mark.parametrize("hot", [{}, {7: 3}, 4])
def test_packed_lines_are_one_state_row_for_each_key(spark, land, tmp_path, hot):
    """900 lines over 100 products, some of no product: state goes by products, over two runs the pairs are those of the batch join."""
    product = F.when(F.col("id") % 9 == 0, 7).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 100)
    lines = spark.range(900).select("id", product.alias("p"), F.array("id").alias("many"))
    products = spark.range(90).select(F.col("id").alias("p"), F.concat(F.lit("n"), "id").alias("name"))
    left, right = land("l", lines), land("r", products)
    sub_keys = lines.where("p IS NOT NULL").select("p").distinct().count()
    if hot == {}:
        assert state_rows(joins.stream_join(left, right, "p", hot, pack=True), tmp_path, "out") == sub_keys + 90
        assert state_rows(joins.stream_join(left, right, "p", hot), tmp_path, "plain") > 800
    else:
        state_rows(joins.stream_join(left, right, "p", hot, pack=True), tmp_path, "out")
    left, right = land("l", lines.withColumn("id", F.col("id") + 1000)), land("r", spark.range(95, 98).select(F.col("id").alias("p"), F.lit("late").alias("name")))
    state_rows(joins.stream_join(left, right, "p", hot, pack=True), tmp_path, "out")
    whole = spark.read.parquet(str(tmp_path / "l")).join(spark.read.parquet(str(tmp_path / "r")), "p")
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.columns == ["id", "p", "many", "name"]
    assert rows(out, "id", "p", "many", "name") == rows(whole, "id", "p", "many", "name")


def test_packed_rows_are_bounded_and_whole(spark, table):
    some = [("a" if i % 3 else None if i % 2 else "b", i % 2, i, Decimal(i), dt.datetime(2025, 1, 1)) for i in range(100)]
    df = table("k string, s int, v int, d decimal(9,2), t timestamp", *some)
    for gathered in (1, 1 << 20):
        got = packed(df, ["k", "s"], gathered, 7)
        assert got.columns == ["k", "s", "rows"] and got.selectExpr("max(size(rows))").first()[0] <= 7
        assert rows(got.select(F.inline("rows"))) == rows(df.where("k IS NOT NULL"))
        assert got.where("exists(rows, r -> r.k <> k OR r.s <> s)").count() == 0
    assert packed(df.limit(0), ["k"]).count() == 0


def test_packed_join_with_a_bound_is_an_error(table):
    a, b = table("k int, lt timestamp", (1, None)), table("k int, rt timestamp", (1, None))
    with pytest.raises(ValueError, match="bound"):
        joins.stream_join(a, b, "k", bound=joins.TimeBound("lt", "rt", "1 hour", "1 minute", "1 minute"), pack=True)


def test_order_pipeline_keeps_the_lines_of_a_product_together(spark, tmp_path, monkeypatch):
    """40 lines of two products: two packed state rows and one for each product, the same table as line by line."""
    lines = [(o, 1, 2, 1 + o % 2, Decimal("1.50"), Decimal(0), Decimal("2.75"), dt.datetime(2025, 1, 1)) for o in range(40)]
    given = {"customer": [(1, "a", "b")], "product": [(p, *[None] * 12) for p in (1, 2, 3)], "salesorderdetail": lines}
    for name, some in given.items():
        spark.createDataFrame(some, ORDERS_LANDING[name]).write.parquet(str(tmp_path / name))
    landing = {n: st.read_stream(spark, str(tmp_path / n), s) for n, s in ORDERS_LANDING.items()}
    queries = []
    monkeypatch.setattr(orders, "start_available", lambda *a: queries.append(st.start_available(*a)) or queries[-1])
    state, out = {}, {}
    for pack in (True, False):
        out[pack] = rows(update_sales_orders(landing, str(tmp_path / f"target-{pack}"), pack=pack)["sales_orders_flat"])
        state[pack] = [p for p in queries[-1].recentProgress if p["stateOperators"]][-1]["stateOperators"][0]["numRowsTotal"]
    assert len(out[True]) == 40 and out[True] == out[False]
    assert state[True] < 10 < 40 < state[False]
