"""Versioned outputs: a failure at any step leaves the old rows, and old files go."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from carepulse.sources import tables
from carepulse.sources.schemas import ORDERS_LANDING
from carepulse.sources.versions import ConflictError, Versions
from carepulse.streaming import tables as st
from carepulse.streaming.orders import update_sales_orders
from helpers import column, rows


@pytest.fixture
def db():
    return f"db_{uuid.uuid4().hex[:8]}"


def folders(path):
    return sorted(x for x in os.listdir(path) if x.startswith("v-"))


def test_versions_are_read_by_the_log(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "out"))
    assert v.current() is None and v.all() == []
    with pytest.raises(LookupError):
        v.read()
    first = v.write(spark.range(3).withColumn("day", F.lit("007")), ("day",))
    assert v.write(v.read().where("id > 0").select("id")).number == first.number + 1
    assert rows(v.read()) == [(1,), (2,)] and rows(v.read(first.number)) == [(0, "007"), (1, "007"), (2, "007")]
    spark.range(9).write.parquet(f"{v.root}/{v.fresh()}")  # written but never committed
    assert rows(v.read()) == [(1,), (2,)]
    assert [g.number for g in v.expire(1)] == [first.number] and not os.path.exists(first.path)
    with pytest.raises(LookupError):
        v.read(first.number)
    assert v.expire(1) == [] and v.write(spark.range(1)).number == 3
    with pytest.raises(ValueError):
        v.expire(0)


def test_a_failed_write_leaves_no_files(spark, tmp_path):
    v = Versions(spark, str(tmp_path / "out"))
    v.write(spark.range(3))
    with pytest.raises(Exception):
        v.write(spark.range(3).selectExpr("raise_error('stop') AS id"))
    assert v.read().count() == 3 and len(folders(v.root)) == 1


def test_two_writers_of_one_number(spark, tmp_path, monkeypatch):
    v = Versions(spark, str(tmp_path / "out"))
    v.write(spark.range(1))
    at = v.current()
    monkeypatch.setattr(Versions, "current", lambda self: at)  # both see version 1
    names = sorted(v.fresh() for _ in range(2))
    v.commit(names[0])
    with pytest.raises(ConflictError):
        v.commit(names[1])
    monkeypatch.undo()
    assert v.current().name == names[0]


@pytest.mark.parametrize("step", ["rows", "commit", "show", "expire"])
def test_replace_fails_at_any_step(spark, db, tmp_path, monkeypatch, step):
    """Before the log names the new version all readers get the old rows, and the next replace goes through."""
    root = str(tmp_path)
    tables.replace_table(spark.range(3), db, "t", root, "kept")
    new = spark.range(7)
    if step == "rows":
        new = new.selectExpr("CASE WHEN id < 6 THEN id ELSE raise_error('stop') END AS id")
    elif step == "commit":
        monkeypatch.setattr(Versions, "commit", lambda *a: 1 / 0)
    elif step == "show":
        monkeypatch.setattr(tables, "show_table", lambda *a: 1 / 0)
    else:
        monkeypatch.setattr(tables, "expire_versions", lambda *a: 1 / 0)
    with pytest.raises(Exception):
        tables.replace_table(new, db, "t", root)
    monkeypatch.undo()
    assert len(folders(tmp_path / db / "t")) == (1 if step == "rows" else 2)
    assert tables.scan_table(spark, db, "t").count() == (7 if step == "expire" else 3)
    if step == "show":
        tables.show_table(spark, db, "t", root)
        assert tables.scan_table(spark, db, "t").count() == 7
    again = tables.replace_table(tables.scan_table(spark, db, "t").where("id = 1"), db, "t", root)
    assert rows(again) == [(1,)] and tables.get_comment(spark, db, "t") == "kept"


def test_old_files_go(spark, db, tmp_path):
    for n in range(1, 5):
        tables.replace_table(spark.range(n), db, "t", str(tmp_path), partition_by=(), keep=2)
    at = tmp_path / db / "t"
    assert len(folders(at)) == 2 and tables.expire_versions(spark, db, "t", str(tmp_path)) == 1
    assert len(folders(at)) == 1 and tables.scan_table(spark, db, "t").count() == 4
    assert [t.name for t in spark.catalog.listTables(f"{db}__versions") if not t.isTemporary] == [f"t__{folders(at)[0].replace('-', '_')}"]


def test_names_and_columns_are_quoted(spark, db, tmp_path):
    df = spark.range(2).selectExpr("id AS `a b`", "'1' AS `x``y`")
    saved = tables.replace_table(df, db, "odd_name", str(tmp_path), "it's", ["x`y"])
    assert saved.columns == ["a b", "x`y"] and rows(tables.replace_table(saved, db, "odd_name", str(tmp_path))) == [(0, "1"), (1, "1")]
    tables.set_comment(spark, db, "odd_name", "new 'one'")
    assert tables.get_comment(spark, db, "odd_name") == "new 'one'"


def test_a_refresh_that_fails_serves_the_old_output(spark, tmp_path):
    src, dst, ckpt = (str(tmp_path / x) for x in ("src", "dst", "ckpt"))

    def land(lo, hi):
        spark.range(lo, hi).write.mode("append").parquet(src)
        return st.read_stream(spark, src, "id long")

    first = st.run_available(land(0, 3), dst, ckpt)
    broken = land(3, 5).selectExpr("CASE WHEN id < 4 THEN id ELSE raise_error('stop') END AS id")
    with pytest.raises(Exception):
        st.run_available(broken, dst, ckpt, full_refresh=True)
    assert Versions(spark, dst).current().path == first and sorted(column(spark.read.parquet(first), "id")) == [0, 1, 2]
    assert len(folders(dst)) == len(folders(ckpt)) == 1
    assert st.run_available(land(5, 6), dst, ckpt) == first  # goes on where it was
    assert sorted(column(spark.read.parquet(first), "id")) == [0, 1, 2, 3, 4, 5]
    fresh = st.run_available(land(6, 7), dst, ckpt, full_refresh=True, keep=1)
    assert fresh != first and not os.path.exists(first) and len(folders(ckpt)) == 1
    assert sorted(column(spark.read.parquet(fresh), "id")) == list(range(7))


def test_order_pipeline_refreshes_all_tables_or_none(spark, tmp_path, monkeypatch):
    for name, schema in ORDERS_LANDING.items():
        empty = spark.createDataFrame([], schema)
        spark.createDataFrame([(1, *[None] * (len(empty.columns) - 1))], schema).write.parquet(str(tmp_path / name))
    streams = {n: st.read_stream(spark, str(tmp_path / n), s) for n, s in ORDERS_LANDING.items()}
    target = str(tmp_path / "target")
    update_sales_orders(streams, target)
    at = Versions(spark, target).current()
    from carepulse.streaming import orders
    monkeypatch.setattr(orders, "flat_orders", lambda *a: 1 / 0)  # after the copies are through
    with pytest.raises(ZeroDivisionError):
        update_sales_orders(streams, target, full_refresh=True)
    monkeypatch.undo()
    assert Versions(spark, target).current() == at and len(folders(target)) == 1
    assert update_sales_orders(streams, target)["customer"].count() == 1
