"""Operators on hand-made edge rows, and their invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carepulse.functions import measures as m
from carepulse.operators import aggregates as ag, joining as jo, quality as dq, ranking as rk, sets, shaping as sh, spine, windows as wn
from carepulse.operators.metrics import MetricView
from carepulse.operators.vocabulary import checked_persons, map_concepts, omop_person_load, surrogate_id
from helpers import column, plan_of, rows


def d(text):
    return dt.date.fromisoformat(text)


# ---- shaping and row generators -------------------------------------------


def test_shaping(table):
    df = table("a string, b string", (" x ", None), ("y", "7"))
    assert rows(sh.trim_cols(df, ["a"]), "a") == [("x",), ("y",)]
    assert rows(sh.defaults(df, {"b": "0"}), "b") == [("0",), ("7",)]
    assert rows(sh.cast_cols(df, {"a": "int", "b": "int"}, lenient=True)) == [(None, 7), (None, None)]
    assert sh.project(df, {"n": "a"}).columns == ["n"]
    assert sh.with_const(df, "k", "ER").where("k = 'ER'").count() == 2


def test_strict_cast_raises(table):
    with pytest.raises(Exception):
        sh.cast_cols(table("a string", ("x",)), {"a": "int"}).collect()


def test_date_spines(spark, table):
    fixed = spine.date_spine(spark, "2025-08-31", "2025-09-02")
    assert column(fixed, "date") == [d("2025-08-31"), d("2025-09-01"), d("2025-09-02")]
    assert column(fixed, "is_weekend") == [True, False, False]
    facts = table("t timestamp", (dt.datetime(2025, 9, 1, 23),), (dt.datetime(2025, 9, 3),), (None,))
    assert spine.date_spine_of(facts, "t").count() == 3
    assert spine.date_spine_of(facts.where("1 = 0"), "t").count() == 0
    assert column(spine.hour_spine(spark), "hour_of_day") == list(range(24))


def test_scaffold_is_dense_without_a_cross_join(spark, table):
    keys = table("site string", ("a",), ("b",))
    days = spine.days_of(spine.date_spine(spark, "2025-09-01", "2025-09-03"))
    grid = spine.scaffold(keys, {"date": days, "hour_of_day": spine.hours_of_day()})
    assert grid.count() == grid.distinct().count() == 2 * 3 * 24
    assert "NestedLoop" not in plan_of(grid) and "Cartesian" not in plan_of(grid)


def test_literal_relations(spark, table):
    df = spine.values(spark, [("a", 1), ("b", None)], "k string, n int")
    assert rows(df) == [("a", 1), ("b", None)] and df.dtypes == [("k", "string"), ("n", "int")]
    assert rows(spine.scaffold(table("site string", ("s",)), {"kind": ["x", "y"]})) == [("s", "x"), ("s", "y")]


def test_scaffold_refuses_a_relation_of_any_size(spark, table):
    with pytest.raises(TypeError, match="make it the keys"):
        spine.scaffold(table("site string", ("a",)), {"id": spark.range(1)})


def test_scaffold_takes_a_long_range(table):
    ends = table("date date", (d("1500-01-01"),), (d("1500-01-01") + dt.timedelta(days=199_999),))
    grid = spine.scaffold(table("site string", ("a",), ("b",)), {"date": spine.days_of(ends)})
    assert grid.count() == 2 * 200_000


def test_exact_quantiles(table):
    df = table("k string, v int, x double", ("a", 1, 0.5), ("a", 2, None), ("a", 2, None), ("a", 9, None), (None, None, 1.0), (None, 3, 2.0), ("b", None, None))
    out = ag.exact_quantiles(df, ["k"], {"mid": "v", "low": "x"})
    assert rows(out) == sorted([("a", 2, 0.5), (None, 3, 1.0), ("b", None, None)], key=repr)
    assert out.dtypes == [("k", "string"), ("mid", "int"), ("low", "double")]
    assert rows(ag.exact_quantiles(df.where("1 = 0"), ["k"], {"mid": "v"})) == []


def test_exact_median_of_many_distinct_values(spark):
    n = 20_001
    df = spark.range(n, numPartitions=5).select(F.lit("g").alias("g"), F.pmod(F.col("id") * 7919, F.lit(n)).alias("v"))
    assert rows(ag.exact_quantiles(df, ["g"], {"mid": "v"})) == [("g", n // 2)]
    assert "Exchange" in plan_of(ag.exact_quantiles(df, ["g"], {"mid": "v"}))


def test_explode_csv_with_spaces_empty_and_null(table):
    df = table("id int, s string", (1, "Central, West"), (2, "East"), (3, ""), (4, None))
    out = spine.explode_csv(df, "s", "region")
    assert rows(out, "id", "region") == [(1, "Central"), (1, "West"), (2, "East"), (3, "")]


@pytest.mark.parametrize("spread", [False, True])
def test_repeat_rows_crosses_chunks(table, spread):
    df = table("id int, n int", (1, 0), (2, 1), (3, 10), (4, None), (5, 4), (6, -2))
    out = spine.repeat_rows(df, "n", chunk=4, spread=spread)
    assert rows(out, "id", "copy_no") == sorted(
        [(2, 1), *[(3, i) for i in range(1, 11)], *[(5, i) for i in range(1, 5)]], key=repr
    )


# ---- joins ----------------------------------------------------------------


def test_left_enrich_keeps_every_left_row(table):
    left = table("id int, v int", (1, 10), (2, 20), (3, 30))
    right = table("id int, r string, other int", (1, "x", 0), (3, "y", 0), (3, "z", 0))
    out = jo.left_enrich(left, right, ["id"], ["r"])
    assert rows(out) == [(1, 10, "x"), (2, 20, None), (3, 30, "y"), (3, 30, "z")]


def test_densify_fills_only_what_is_named(table):
    grid = table("k int", (1,), (2,))
    out = jo.densify(grid, [table("k int, n int, m int", (1, 5, 7))], ["k"], {"n": 0})
    assert rows(out) == [(1, 5, 7), (2, 0, None)]


def test_bounds_and_exists(table):
    df = table("k int, v int", (1, 3), (1, 9), (2, 5))
    assert rows(jo.with_bounds(df, ag.bounds(df, "v")), "lo", "hi") == [(3, 9)] * 3
    left = table("k int", (1,), (2,), (3,))
    assert rows(jo.exists_in(left, df, ["k"], F.col("v") > 4)) == [(1,), (2,)]


def test_join_daily_takes_shared_columns_once(table):
    a = table("site string, unit string, date string, region string, x int", ("s", "ER", "d1", "U", 1))
    b = table("site string, unit string, date string, region string, y int", ("s", "ER", "d1", "V", 2))
    assert rows(jo.join_daily(a, b), "region", "x", "y") == [("U", 1, 2)]


# ---- windows --------------------------------------------------------------


def test_partition_median_keeps_rows_and_groups_nulls(table):
    df = table("k string, v int", ("a", 0), ("a", 1), ("a", 2), ("a", 3), (None, 8), (None, 9), (None, 10), ("b", None))
    out = wn.with_partition_median(df, "v", ["k"], "med")
    assert rows(out) == sorted(
        [("a", 0, 1), ("a", 1, 1), ("a", 2, 1), ("a", 3, 1), (None, 8, 9), (None, 9, 9), (None, 10, 9), ("b", None, None)],
        key=repr,
    )


def test_partition_median_by_shuffled_join_is_the_same(spark, table):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), (F.col("id") % 101).alias("v"))
    broadcast = rows(wn.with_partition_median(df, "v", ["k"], "med"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = wn.with_partition_median(df, "v", ["k"], "med")
        assert "BroadcastHashJoin" not in plan_of(shuffled)
        assert rows(shuffled) == broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_running_sum_ends_at_the_total(table):
    df = table("k string, day int, v int", ("a", 1, 2), ("a", 2, 3), ("b", 1, 7), ("a", 3, 5))
    out = wn.running_sum(df, "v", ["k"], ["day"], "total")
    assert rows(out, "k", "day", "total") == [("a", 1, 2), ("a", 2, 5), ("a", 3, 10), ("b", 1, 7)]


def test_lag_needs_history_and_values(table):
    df = table("k int, day int, v double", *[(1, i, None if i == 2 else float(i)) for i in range(1, 11)])
    out = wn.delta_vs_lag(df, "v", 7, ["k"], ["day"], "lag", "delta")
    got = {r["day"]: (r["lag"], r["delta"]) for r in out.collect()}
    assert got[7] == (None, None) and got[8] == (1.0, 7.0) and got[9] == (None, None) and got[10] == (3.0, 7.0)
    assert rows(wn.lag_k(df, "v", 7, ["k"], ["day"], "lag").where("day = 10"), "lag") == [(3.0,)]


# ---- ranking --------------------------------------------------------------


def test_top_k_breaks_ties_by_key(table):
    df = table("id int, v double", (4, 1.0), (2, 5.0), (3, 5.0), (1, 5.0), (5, None))
    assert column(rk.top_k(df, "v", 3, ["id"]), "id") == [1, 2, 3]
    assert column(rk.sort_by(df.where("v = 5"), [("v", False), ("id", False)]), "id") == [3, 2, 1]
    assert rows(rk.lookup(df, "id", 4)) == [(4, 1.0)]


def test_latest_n_limits_before_the_shuffle(spark):
    df = spark.range(1000).select(F.when(F.col("id") >= 10, "hot").otherwise("cold").alias("k"), "id")
    out = rk.latest_n(df, ["k"], [F.col("id").desc()], 3)
    assert rows(out, "k", "id", "_rank") == [("cold", 7, 3), ("cold", 8, 2), ("cold", 9, 1), ("hot", 997, 3), ("hot", 998, 2), ("hot", 999, 1)]
    plan = plan_of(out)
    assert plan.count("WindowGroupLimit") >= 2 and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("n", [0, 1, 17, 500, 999, 1000, 5000])
def test_sample_has_exactly_n_rows_and_is_repeatable(spark, n):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("x"))
    one, two = (rows(rk.sample_fixed_n(part, n, ["id"], 3)) for part in (df, df.repartition(5)))
    assert one == two and len(set(one)) == len(one) == min(n, 1000)


def test_sample_changes_with_the_seed(spark):
    df = spark.range(1000)
    assert rows(rk.sample_fixed_n(df, 50, ["id"], 1)) != rows(rk.sample_fixed_n(df, 50, ["id"], 2))


# ---- sets and aggregates --------------------------------------------------


def test_sets(table):
    a, b = table("x int", (1,), (1,), (None,)), table("x int", (1,), (2,), (None,))
    assert rows(sets.union_distinct(a, b)) == [(1,), (2,), (None,)]
    assert rows(sets.distinct_on(a, ["x"])) == [(1,), (None,)]


def test_bridge_keeps_duplicates_and_widens_dates(table):
    df = table("day string, r string", ("2025-09-01", "East"), ("2025-09-01", "East")).select(F.col("day").cast("date").alias("day"), "r")
    out = sets.filter_bridge([(df, {"region": (F.col("day"), F.col("r"), F.col("r")), "again": (F.col("day"), None, F.col("r"))})])
    assert out.count() == 4 and dict(out.dtypes)["date"] == "timestamp"
    assert rows(out.where("region IS NULL"), "field_name", "field_value") == [("again", "East")] * 2


def test_roll_up_is_a_mean_of_means(table):
    df = table("day string, v double, n int", ("2025-09-01", 1.0, 1), ("2025-09-07", 3.0, 99), ("2025-09-08", 5.0, 1))
    out = ag.roll_up(df.withColumn("day", F.col("day").cast("date")), "day", "WEEK", [], {"v": F.avg("v"), "n": F.sum("n")}, "week")
    assert rows(out, "v", "n") == [(2.0, 100), (5.0, 1)]


def test_distinct_count_counts_null_rows(table):
    assert rows(ag.distinct_count(table("a int, b int", (1, 1), (1, 1), (1, None), (None, None)), ["a", "b"])) == [(3,)]


def test_phases_are_half_open(table):
    df = table("t timestamp, ok boolean", *[(dt.datetime(2025, 10, day), day % 2 == 0) for day in (1, 2, 11, 12, 20, 21)])
    phases = [("before", None, "2025-10-02"), ("during", "2025-10-02", "2025-10-12"), ("recovery", "2025-10-12", "2025-10-21")]
    out = ag.phase_compare(df, "t", phases, {"rate": m.rate(F.col("ok")), "n": F.count(F.lit(1))})
    assert rows(out) == [("before", 0.0, 1), ("during", 0.5, 2), ("recovery", 1.0, 2)]


def test_weekend_compare(table):
    df = table("t timestamp, v int", (dt.datetime(2025, 9, 6), 4), (dt.datetime(2025, 9, 8), 2), (dt.datetime(2025, 9, 9), 3))
    assert rows(ag.weekend_compare(df, "t", {}, {"med": "v"})) == [(False, 2), (True, 4)]


# ---- quality --------------------------------------------------------------


def test_required_and_range(table):
    df = table("id int, y int", (1, 1850), (None, 1990), (3, None))
    assert rows(dq.dq_required_not_null(df, ["id", "y"])) == [("id", 1), ("y", 1)]
    assert rows(dq.dq_value_range(df, "y", 1900, 2025)) == [("y", 1)]


def test_interval_rules(table):
    def t(day):
        return dt.datetime(2025, 1, day)

    visits = table("p int, s timestamp, e timestamp", (1, t(5), t(6)), (1, t(8), t(7)), (2, t(5), t(6)), (1, t(20), None))
    periods = table("p int, period_start timestamp, period_end timestamp", (1, t(1), t(6)), (1, t(7), t(9)))
    out = dq.dq_interval_order(visits, "s", "e", "2025-01-10 00:00:00", periods, ["p"])
    assert rows(out) == [("in_future", 1), ("outside_period", 2), ("start_after_end", 1)]


def test_referential_counts_keys_and_rows(table):
    child = table("k int", (1,), (9,), (9,), (8,), (None,))
    assert rows(dq.dq_referential(child, table("id int", (1,), (1,)), {"k": "id"})) == [(2, 3)]
    assert rows(dq.dq_referential(child.where("k = 1"), table("id int", (1,)), {"k": "id"})) == [(0, 0)]


def test_unique_and_dedupe(table):
    df = table("k int, v int", (1, 1), (1, 2), (2, 5))
    assert rows(dq.dq_unique(df, ["k"])) == [(1, 2)]
    assert rows(dq.dedupe(df, ["k"], [F.col("v").desc()])) == [(1, 2), (2, 5)]


def test_schema_differences(table):
    df = table("a int, b string, extra int", (1, None, 0))
    wanted = T.StructType().add("a", T.LongType()).add("b", T.StringType(), False).add("c", T.IntegerType())
    assert rows(dq.dq_schema(df, wanted)) == [
        ("a", "type int, expected bigint"), ("b", "has nulls"), ("c", "missing"), ("extra", "unexpected")
    ]
    assert rows(dq.dq_schema(df, df.schema)) == []


def test_quality_metrics(table):
    df = table("id int, concept int", (1, 5), (1, 0), (2, None), (3, 7))
    out = dq.dq_metrics(df, ["id", "concept"], ["id"], {"concept": F.col("concept") != 0}, {"id": F.col("id") < 3})
    assert out.first().asDict() == {
        "rows_total": 4, "complete_pct_id": 100.0, "complete_pct_concept": 75.0, "standard_pct_concept": 50.0,
        "invalid_id": 1, "duplicate_rows": 1,
    }


# ---- vocabulary and metrics -----------------------------------------------


def test_map_concepts(table):
    concept = table(
        "concept_id int, concept_code string, concept_name string, vocabulary_id string, standard_concept string",
        (1, "E11.9", "type 2", "ICD10CM", None), (2, "44054006", "diabetes", "SNOMED", "S"), (3, "x", "old", "SNOMED", None),
        (4, "N1", "drug", "NDC", None), (5, "R1", "rx", "RxNorm", "S"),
    )
    rel = table(
        "concept_id_1 int, concept_id_2 int, relationship_id string",
        (1, 2, "Maps to"), (1, 3, "Maps to"), (2, 1, "Mapped from"), (4, 5, "Maps to"), (4, 2, "Maps to"),
    )
    assert rows(map_concepts(concept, rel, "ICD10CM", code="E11.9")) == [("E11.9", "type 2", 2, "diabetes")]
    assert rows(map_concepts(concept, rel, "NDC", target="RxNorm")) == [("N1", "drug", 5, "rx")]


def test_person_load(table):
    patients = table(
        "source_patient_id string, birth_datetime timestamp, gender_concept_id int, race_concept_id int, ethnicity_concept_id int, zip string",
        ("12345", dt.datetime(1980, 1, 15), 8532, 0, 0, "02115"), ("6", None, None, 0, 0, "none"),
    )
    out = omop_person_load(patients, table("zip string, location_id int", ("02115", 77)))
    got = {r["person_source_value"]: r for r in out.collect()}
    assert (got["12345"]["year_of_birth"], got["12345"]["month_of_birth"], got["12345"]["day_of_birth"]) == (1980, 1, 15)
    assert got["12345"]["location_id"] == 77 and got["6"]["location_id"] is None and got["6"]["year_of_birth"] is None
    ids = table("i int", *[(i,) for i in range(1000)]).select(surrogate_id("i").alias("p"))
    assert ids.distinct().count() == 1000 and ids.where("length(p) = 32").count() == 1000


def test_a_person_id_for_two_people_is_an_error(table):
    rows_ = table("person_id string, person_source_value string", ("a", "1"), ("a", "1"), ("b", "2"))
    assert checked_persons(rows_).count() == 3
    with pytest.raises(ValueError, match="more than one"):
        checked_persons(rows_.union(table("person_id string, person_source_value string", ("a", "3"))))


def test_interval_check_aggregates_before_the_shuffle(table):
    visits = table("p string, s timestamp, e timestamp", *[("a", dt.datetime(2025, 1, 2), dt.datetime(2025, 1, 3))] * 3, ("b", dt.datetime(2025, 1, 2), None))
    periods = table("p string, period_start timestamp, period_end timestamp", ("b", dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 5)))
    out = dq.dq_interval_order(visits, "s", "e", period=periods, on=["p"])
    assert rows(out.where("rule = 'outside_period'"), "violations") == [(3,)]
    plan = plan_of(dq.dq_interval_order(visits, "s", "e", period=periods, on=["p"]))
    assert "partial_count" in plan


def test_sample_computes_its_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    spark.range(5000).write.parquet(str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in"))

    def look(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    out = rk.sample_fixed_n(source.mapInArrow(look, "id long"), 1234, ["id"])
    assert out.count() == out.distinct().count() == 1234 and seen.value == 5000
    assert rows(out) == rows(rk.sample_fixed_n(source.repartition(7), 1234, ["id"]))


def test_metric_view(table):
    df = table("g string, y int", ("f", 1980), ("f", 1990), ("m", 2000))
    view = MetricView(df, {"Gender": F.col("g")}, {"Total Patients": F.count(F.lit(1)), "Average Age": F.avg(2025 - F.col("y"))})
    assert rows(view.evaluate(["Total Patients", "Average Age"], ["Gender"])) == [("f", 2, 40.0), ("m", 1, 25.0)]
    assert rows(view.evaluate(["Total Patients"])) == [(3,)]
    with pytest.raises(KeyError):
        view.evaluate(["Nothing"])
