"""Exact order statistics against sorting."""

import random
import struct
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carepulse.operators import selection
from helpers import plan_of, rows


def bits(v):
    if v != v:
        return (2047 << 52) + 1
    b = struct.unpack("Q", struct.pack("d", abs(v)))[0]
    return -b if v < 0 else b


def test_longs_sort_like_doubles(table):
    rnd = random.Random(3)
    values = [0.0, -0.0, float("inf"), float("-inf"), float("nan"), 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308]
    values += [struct.unpack("d", struct.pack("Q", rnd.getrandbits(64)))[0] for _ in range(3000)]
    values += [2.0 ** k for k in range(-1074, 1024)] + [2.0 ** k * (1 - 2 ** -53) for k in range(-1000, 1024)]
    found = table("v double", *[(v,) for v in values]).select("v", selection._double_order(F.col("v")).alias("k")).collect()
    assert [r["k"] for r in found] == [bits(r["v"]) for r in found]


def test_a_million_distinct_values_in_one_of_two_groups(spark):
    large = spark.range(1_000_001).select(F.lit("a").alias("g"), (F.xxhash64("id") / 3.0).alias("x"), F.xxhash64("id").alias("y"))
    small = spark.range(1000).select(F.lit("b").alias("g"), (F.col("id") % 7).cast("double").alias("x"), F.col("id").alias("y"))
    got = selection.exact_quantiles(large.unionByName(small), ["g"], {"x": "x", "y": "y"})
    middle = sorted(r["y"] for r in large.select("y").toLocalIterator())[500_000]
    assert rows(got, "g", "x", "y") == [("a", middle / 3.0, middle), ("b", 3.0, 499)]
    assert "Window" not in plan_of(got)


@pytest.mark.parametrize("few", [1, 3, 4096])
@pytest.mark.parametrize("p", [0.01, 0.5, 0.9, 1.0])
def test_quantiles_of_odd_values(table, few, p):
    rnd = random.Random(11)
    data = []
    for g in (None, "x", "y", "z"):
        for _ in range({"x": 400, "y": 37}.get(g, 3)):
            d = rnd.choice([0.0, -1.5, 2.0 ** rnd.randint(-1074, 1000), -rnd.random() * 10 ** rnd.randint(-300, 300), None, float("inf"), rnd.random()])
            data.append((g, d, rnd.choice([None, rnd.randint(-2**63, 2**63 - 1), 5, -5]), Decimal(rnd.randint(-10**6, 10**6)) / 100))
    data += [("none", None, None, None)] * 2
    got = selection.exact_quantiles(table("g string, d double, i bigint, c decimal(10,2)", *data), ["g"], {"d": "d", "i": "i", "c": "c"}, p, few)
    want = []
    for g in {r[0] for r in data}:
        line = [g]
        for k in (1, 2, 3):
            values = sorted(r[k] for r in data if r[0] == g and r[k] is not None)
            line.append(next((v for n, v in enumerate(values, 1) if n >= len(values) * p), None))
        want.append(tuple(line))
    assert rows(got) == sorted(want, key=repr)
    assert got.schema["c"].dataType.simpleString() == "decimal(10,2)"


def test_no_rows_and_no_quantile_of_text(table):
    none = table("g string, d double", ("a", 1.0)).limit(0)
    assert rows(selection.exact_quantiles(none, ["g"], {"d": "d"})) == []
    with pytest.raises(TypeError):
        selection.exact_quantiles(none, ["d"], {"g": "g"})
