"""Cleaning, time, measure and text expressions on hand-made edge rows."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from carepulse.functions import cleaning as c, measures as m, temporal as tm, wording as wd
from helpers import column, rows

ALLOWED = ["Low", "Medium", "High"]


def test_enums_on_padded_wrong_case_unknown_and_null(table):
    df = table("v string", (" Low ",), ("HIGH",), ("odd ",), (None,))
    assert column(df, c.enum_exact("v", ALLOWED, "Medium")) == ["Low", "Medium", "Medium", "Medium"]
    assert column(df, c.enum_exact("v", ALLOWED, "Medium", trim=False)) == ["Medium"] * 4
    assert column(df, c.enum_ci("v", ALLOWED, "Medium")) == ["Low", "High", "Medium", "Medium"]
    assert column(df, c.enum_ci_keep_unknown("v", ALLOWED, "Low")) == ["Low", "High", "odd ", "Low"]
    assert column(df, c.enum_ci_self("v", ALLOWED)) == ["Low", "High", "odd", None]


def test_enum_output_is_always_a_member_or_the_default(spark):
    @settings(max_examples=8, deadline=None)
    @given(st.lists(st.one_of(st.none(), st.text(max_size=6), st.sampled_from([" low", "MEDIUM ", "High"])), min_size=1))
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "v string")
        for expr in (c.enum_exact("v", ALLOWED, "none"), c.enum_ci("v", ALLOWED, "none")):
            assert set(column(df, expr)) <= {*ALLOWED, "none"}

    check()


def test_flags_are_never_null(table):
    df = table("x int", (1,), (None,), (5,))
    assert column(df, c.flag(F.col("x") > 2)) == [False, False, True]
    assert column(df, c.value_if(F.col("x") > 2, F.col("x").cast("double"))) == [0.0, 0.0, 5.0]


def test_bands_include_their_lower_bound(table):
    df = table("p double", (0.0999,), (0.10,), (0.20,), (None,))
    assert column(df, c.band_probability("p", [(0.10, "Low"), (0.20, "Medium")], "High")) == ["Low", "Medium", "High", "High"]


def test_bucket_and_classify(table):
    df = table("s string", ("a",), ("z",), (None,))
    assert column(df, c.bucket_in("s", {"first": ["a", "b"]}, "other")) == ["first", "other", "other"]
    assert column(df, c.classify([(F.col("s") == "z", "last")], "rest")) == ["rest", "last", "rest"]


def test_iso_round_trip_floors_to_ms_and_marks_missing(table):
    df = table("t timestamp", (dt.datetime(2025, 9, 6, 1, 2, 3, 987654),), (None,))
    text = df.select(tm.encode_iso_ms("t").alias("t"))
    assert column(text, "t") == ["2025-09-06T01:02:03.987Z", "NaT"]
    assert column(text, tm.decode_time("t").cast("string")) == ["2025-09-06 01:02:03.987", None]


def test_malformed_times_become_null(table):
    assert column(table("t string", ("soon",), ("2025-13-01",)), tm.decode_time("t")) == [None, None]


def test_floor_ms(table):
    df = table("t timestamp", (dt.datetime(2025, 9, 6, 1, 2, 3, 987654),))
    assert column(df, tm.floor_ms("t")) == [dt.datetime(2025, 9, 6, 1, 2, 3, 987000)]


def test_weekend_and_monday_weeks(table):
    df = table("d string", ("2025-09-06",), ("2025-09-07",), ("2025-09-08",), (None,)).select(F.col("d").cast("date").alias("d"))
    assert column(df, tm.is_weekend("d")) == [True, True, False, False]
    assert column(df, tm.week_start("d").cast("string")) == ["2025-09-01 00:00:00"] * 2 + ["2025-09-08 00:00:00", None]


def test_duration_counts_whole_seconds(table):
    df = table(
        "a timestamp, b timestamp",
        (dt.datetime(2025, 1, 1, 0, 0, 0, 900000), dt.datetime(2025, 1, 1, 0, 1, 0, 100000)),
        (dt.datetime(2025, 1, 1), None),
    )
    assert column(df, tm.duration_minutes("a", "b")) == [1.0, None]


def test_time_ago_limits(table):
    now = dt.datetime(2025, 1, 10)
    ages = [dt.timedelta(days=2), dt.timedelta(days=1, seconds=5), dt.timedelta(seconds=7201), dt.timedelta(seconds=3601),
            dt.timedelta(seconds=3600), dt.timedelta(seconds=61), dt.timedelta(seconds=5)]
    df = table("t timestamp", *[(now - a,) for a in ages], (None,))
    assert column(df, tm.time_ago("t", F.lit(now))) == [
        "2 days ago", "1 day ago", "2 hours ago", "1 hour ago", "60 minutes ago", "1 minute ago", "0 minute ago", "Unknown"
    ]


def test_us_date(table):
    assert column(table("t timestamp", (dt.datetime(2025, 11, 7, 5),), (None,)), tm.us_date("t")) == ["11/07/2025", "Unknown"]


def test_trailing_days_include_both_ends(table):
    df = table("d string", ("2025-11-04",), ("2025-11-03",), ("2025-11-10",), ("2025-11-11",)).select(F.col("d").cast("date").alias("d"))
    assert column(df, tm.in_trailing_days("d", F.lit("2025-11-10").cast("date"), 7)) == [True, False, True, False]


def test_measures(table):
    df = table("f boolean, x int", (True, 0), (None, 1), (False, 2), (True, 3))
    got = df.agg(
        m.count_if(F.col("f")), m.rate(F.col("f")), m.any_flag(F.col("f")), m.sum_if(F.col("f"), "x"), m.approx_median("x"),
        m.ratio(m.count_if(F.col("f")), F.count(F.lit(1))),
    )
    assert rows(got) == [(2, 0.5, 1, 3, 1, 0.5)]


def test_rates_are_double_and_guarded(table):
    df = table("n int, d int", (1, 3), (1, 0))
    out = df.select(m.ratio(F.col("n"), F.col("d")).alias("a"), m.ratio(F.col("n"), F.col("d"), 0.0).alias("b"))
    assert dict(out.dtypes) == {"a": "double", "b": "double"}
    assert [tuple(r) for r in out.collect()] == [(1 / 3, 1 / 3), (None, 0.0)]


def test_texts(table):
    df = table("a boolean, b boolean", (True, True), (False, True), (None, None))
    assert column(df, wd.join_sentences([(F.col("a"), "One"), (F.col("b"), "Two")])) == ["One. Two.", "Two.", None]
    vitals = table("g double, s double, d double, w double", (129.9, 139.9, 89.2, 80.0))
    shown = vitals.select(wd.glucose_text("g"), wd.pressure_text("s", "d"), wd.pounds_text("w"))
    assert rows(shown) == [("129 mg/dL", "139/89 mmHg", "176.4 lbs")]
