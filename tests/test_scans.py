"""Scans in blocks against windows and brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from carepulse.operators import scans
from carepulse.operators.quality import dq_interval_order, outside_periods
from helpers import plan_of, rows


@pytest.fixture
def many_blocks(spark):
    """As many blocks as shuffle partitions, however small."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def made(spark, n=4000):
    part = F.expr("CASE WHEN id % 10 < 7 THEN 'big' WHEN id % 10 < 9 THEN NULL ELSE concat('p', id % 40) END")
    return spark.range(n).select("id", part.alias("p"), (F.col("id") % 3).alias("q"), (F.xxhash64("id") % 500).alias("t"),
                                 F.when(F.col("id") % 11 != 0, F.col("id") % 17 - 8).alias("v"))


def test_prefix_sums_equal_the_window(spark, many_blocks):
    df = made(spark)
    frame = Window.partitionBy("p").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.withColumn("s", F.sum("v").over(frame))
    got = scans.prefix_sum(df, "v", ["p"], ["t", "id"], "s")
    assert got.columns == want.columns and rows(got) == rows(want)
    assert rows(scans.numbered(df, [], ["id"], "n"), "id", "n") == sorted(((i, i + 1) for i in range(4000)), key=repr)
    assert rows(scans.prefix_sum(df.limit(0), "v", ["p", "q"], ["t"], "s")) == []


def test_a_unit_of_five_million_rows_is_spread_over_tasks(spark):
    big = spark.range(5_000_000, numPartitions=8).select(F.lit("u").alias("unit"), "id", (F.col("id") % 10).alias("v"))
    blocks = scans.in_blocks(big, ["unit"], ["id"])
    sizes = [r["count"] for r in blocks.groupBy("_block").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 2_500_000
    got = scans.running(blocks, ["unit"], {"s": "v"})
    wrong = got.where("s <> 45 * (id DIV 10) + (id % 10) * (id % 10 + 1) DIV 2 OR s IS NULL")
    assert wrong.count() == 0 and got.count() == 5_000_000


@pytest.mark.parametrize("k", [1, 7, 300, 5000])
def test_lags_equal_the_window(spark, many_blocks, k):
    df = made(spark)
    want = df.withColumn("w", F.lag("v", k).over(Window.partitionBy("p", "q").orderBy("t", "id")))
    assert rows(scans.lag_rows(df, "v", k, ["p", "q"], ["t", "id"], "w")) == rows(want)


def test_lags_by_day_and_density(table):
    day = dt.date(2024, 1, 1)
    df = table("u string, day date, v int", *[("a", day + dt.timedelta(i), i) for i in range(10)],
               *[(None, day + dt.timedelta(i), 10 * i) for i in (0, 1, 5, 8)], ("c", day, 1), ("c", day, 2), ("c", None, 3))
    assert rows(scans.density(df, ["u"], "day")) == sorted([("a", 10, 10, 0, 0, True), (None, 4, 4, 5, 0, False), ("c", 2, 1, 0, 1, False)], key=repr)
    got = {(r["u"], r["day"]): r["w"] for r in scans.lag_days(df.where("u IS NULL OR u = 'a'"), "v", 7, ["u"], "day", "w").collect()}
    assert got["a", day + dt.timedelta(9)] == 2 and got["a", day + dt.timedelta(6)] is None
    assert got[None, day + dt.timedelta(8)] == 10 and got[None, day + dt.timedelta(5)] is None  # three rows back would be another day


def at(minute):
    return None if minute is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def test_intervals_in_periods_against_every_pair(table, many_blocks):
    rnd = random.Random(9)
    owners = [None, 1, 2, 3, 4]
    def span(): return rnd.choice([None, *[rnd.randint(0, 300)] * 9])
    periods = [(rnd.choice(owners[:4]), span(), span()) for _ in range(150)]
    spans = [(rnd.choice(owners), a := span(), rnd.choice([None, (a or 0) + rnd.randint(-5, 60)]), "x") for _ in range(600)]
    spans += spans[:40]
    def held(o, s, e): return o is not None and s is not None and any(
        p == o and lo is not None and hi is not None and lo <= s and (s if e is None else e) <= hi for p, lo, hi in periods)
    p = table("owner int, lo timestamp, hi timestamp", *[(o, at(a), at(b)) for o, a, b in periods])
    d = table("owner int, s timestamp, e timestamp, lo string", *[(o, at(a), at(b), x) for o, a, b, x in spans])
    got = outside_periods(d, "s", "e", p, ["owner"], ("lo", "hi"))
    want = {}
    for o, s, e, _ in spans:
        if not held(o, s, e):
            want[o, at(s), at(e)] = want.get((o, at(s), at(e)), 0) + 1
    assert rows(got) == sorted(((*k, n) for k, n in want.items()), key=repr)
    checks = dict(rows(dq_interval_order(d, "s", "e", period=p, on=["owner"], period_cols=("lo", "hi"))))
    assert checks["outside_period"] == sum(want.values())


def test_an_owner_with_ten_thousand_periods_and_intervals(spark):
    base = F.lit("2024-01-01").cast("timestamp")
    def later(c): return F.timestamp_add("MINUTE", c, base)
    n = 10_000
    p = spark.range(n).select(F.lit(1).alias("o"), later((F.col("id") * 10).cast("int")).alias("period_start"), later((F.col("id") * 10 + 5).cast("int")).alias("period_end"))
    d = spark.range(n).select(F.lit(1).alias("o"), later((F.col("id") * 10 + 1).cast("int")).alias("s"), later((F.col("id") * 10 + 4 + F.col("id") % 3).cast("int")).alias("e"))
    got = outside_periods(d, "s", "e", p, ["o"])
    assert got.count() == sum(k % 3 == 2 for k in range(n))
    joins = [line for line in plan_of(got).split("\n") if "Join" in line]
    assert all("_block" in line or "_b#" in line for line in joins)  # no join of periods and intervals
