"""Stored metric states, footer counts, and stream joins with a pinned table."""

import pytest
from pyspark.sql import functions as F

from carepulse.operators.metrics import MetricStore, MetricView, distinct_of, largest_of, least_of, mean_of, row_total, total_of
from carepulse.sources.files import footer_counts
from carepulse.sources.versions import Versions
from carepulse.streaming import pinned, tables as st
from helpers import plan_of, rows


@pytest.fixture
def source(spark):
    return spark.range(5000).select("id", F.expr("nullif(id % 4, 3)").alias("a"), (F.col("id") % 10).alias("b"), (F.col("id") % 30).alias("c"),
                                    F.when(F.col("id") % 5 != 0, F.col("id") / 4).alias("v"))


def dims():
    return {c: F.col(c) for c in "abc"}


def test_states_answer_coarser_groupings(spark, source, tmp_path):
    measures = {"n": row_total(), "total": total_of("v"), "mean": mean_of("v"), "share": mean_of(F.col("id") % 2 == 0), "low": least_of("v"),
                "high": largest_of("v"), "ids": distinct_of("id")}
    store = MetricStore(spark, str(tmp_path / "m"), dims(), measures)
    grains = [["a", "b"], ["a", "b", "c"]]
    for g in grains:
        store.store(source, g)
    direct = MetricView(source, dims(), {"n": F.count(F.lit(1)), "total": F.sum("v"), "mean": F.avg("v"), "share": F.avg((F.col("id") % 2 == 0).cast("double")),
                                       "low": F.min("v"), "high": F.max("v")})
    for by in ([], ["a"], ["b"], ["a", "b"], ["c", "a"]):
        got = store.answer(list(direct.measures), by, grains)
        assert rows(got) == rows(direct.evaluate(list(direct.measures), by))
        assert "Range" not in plan_of(got) and all(str(tmp_path / "m") in f for f in got.inputFiles())
    assert all("/a+b/" in f for f in store.answer(["n"], ["a"], grains).inputFiles())
    assert all("/a+b+c/" in f for f in store.answer(["n"], ["c"], grains).inputFiles())
    exact = {r["b"]: r["n"] for r in source.groupBy("b").agg(F.countDistinct("id").alias("n")).collect()}
    for r in store.answer(["ids"], ["b"], grains).collect():
        assert abs(r["ids"] - exact[r["b"]]) <= 0.05 * exact[r["b"]]
    assert rows(store.answer(["n"], ["b"], grains, F.col("a") == 1)) == rows(source.where("a = 1").groupBy("b").count())
    with pytest.raises(LookupError):
        store.answer(["n"], ["c"], [["a", "b"]])
    with pytest.raises(KeyError):
        store.answer(["n"], ["d"], grains)
    with pytest.raises(KeyError):
        store.answer(["no"], ["a"], grains)


def test_states_are_stored_anew_and_of_nothing(spark, source, tmp_path):
    store = MetricStore(spark, str(tmp_path / "m"), dims(), {"n": row_total(), "mean": mean_of("v"), "ids": distinct_of("id")})
    store.store(source, ["a"])
    store.store(source.limit(0), ["a"])
    assert rows(store.answer(["n", "mean", "ids"], [], [["a"]])) == [(0, None, 0)] and rows(store.answer(["n"], ["a"], [["a"]])) == []
    with pytest.raises(Exception):
        store.store(source.withColumn("v", F.expr("raise_error('stop')").cast("double")), ["a"])
    assert rows(store.answer(["n"], [], [["a"]])) == [(0,)]


def test_footers_state_the_row_counts(spark, tmp_path):
    spark.range(1234).selectExpr("id", "id % 3 AS p").write.partitionBy("p").parquet(str(tmp_path / "parts"))
    spark.range(0).write.parquet(str(tmp_path / "none"))
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    found = footer_counts(spark, {"parts": str(tmp_path / "parts"), "none": str(tmp_path / "none")})
    assert rows(found) == [("none", 0), ("parts", 1234)]
    assert plan_of(found).count("PushedAggregation: [COUNT(*)]") >= 2 and spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_a_replayed_batch_gives_the_same_rows(spark, tmp_path):
    """Two files, a batch each; the second fails. The table changes before it runs again."""
    src, root = str(tmp_path / "src"), str(tmp_path / "out")
    table = Versions(spark, str(tmp_path / "ref"))

    def reference(word):
        table.write(spark.createDataFrame([(k, f"{word}{k}") for k in range(6)], "k long, name string"))

    def land(lo, hi):
        spark.range(lo, hi).select(F.col("id").alias("k")).coalesce(1).write.mode("append").parquet(src)

    def stream(bad=-1):
        read = st.read_stream(spark, src, "k long", max_files=1)
        return read.selectExpr(f"CASE WHEN k = {bad} THEN raise_error('stop') ELSE k END AS k")

    reference("old")
    land(0, 2)
    land(2, 4)
    with pytest.raises(Exception):
        pinned.run_pinned(stream(bad=3), table, "k", root)
    base = Versions(spark, root).current().path
    assert pinned.pins(spark, base) == {1: (1, None)} and pinned.open_version(spark, root) == 1
    reference("new")
    land(4, 7)
    pinned.run_pinned(stream(), table, "k", root)
    got = rows(spark.read.parquet(f"{base}/data"), "k", "name")
    assert got == [(k, f"old{k}") if k < 6 else (6, None) for k in range(7)]
    assert pinned.open_version(spark, root) is None and pinned.pins(spark, base)[1][0] == 1
    land(0, 1)
    pinned.run_pinned(stream(), table, "k", root)
    assert (0, "new0") in rows(spark.read.parquet(f"{base}/data"), "k", "name") and pinned.pins(spark, base)[2] == (2, [3])
    pinned.run_pinned(stream(), table, "k", root)  # nothing new
    assert pinned.pins(spark, base)[3] == (2, [])
    fresh = pinned.run_pinned(stream(), table, "k", root, full_refresh=True)
    assert (1, "new1") in rows(spark.read.parquet(f"{fresh.path}/data"), "k", "name") and pinned.pins(spark, fresh.path) == {1: (2, [0, 1, 2, 3])}
