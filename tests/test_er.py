"""Emergency-room tables on hand-made raw rows with hand-computed results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carepulse.operators.windows import partition_medians
from carepulse.plans import er, serving_er as se
from helpers import column, rows

VISIT = ("visit_id string, patient_id string, site string, unit string, arrival_time string, arrival_hour int, acuity_level int, "
         "diagnosis_group string, discharge_time string, discharge_disposition string, provider_start_time string, "
         "readmission_30d_flag boolean, cost_per_visit_usd double")
SHIFT = ("shift_id string, staff_id string, role string, site string, unit string, scheduled_start string, scheduled_end string, "
         "actual_attended boolean, sick_leave_status string, overtime_hours double, shift_coverage_hours double, change_log_note string")
FLOW = ("flow_id string, site string, unit string, event_time string, hour_of_day int, door_to_triage_minutes double, "
        "door_to_provider_minutes double, triage_level int, queue_length int, telemetry_status string")
SURVEY = ("survey_id string, visit_id string, site string, unit string, survey_date string, overall_score double, "
          "staff_courtesy double, communication_clarity double, cleanliness double, comments string")
RISK = "visit_id string, patient_id string, prediction_date string, readmission_probability double, risk_band string"

LC = "Lakeview Central"


@pytest.fixture
def visits(table):
    raw = table(
        VISIT,
        (" V1 ", " P1", " Lakeview Central ", None, "2025-09-06T10:00:00.900Z", 10, 3, None, "2025-09-06T11:30:00.100Z", " admitted", "2025-09-06T10:20:30.000Z", None, 100.0),
        ("V2", "P2", LC, " ER", "2025-09-06T10:30:00.000Z", 10, 2, "GI", "NaT", "lwbs", "NaT", True, 50.0),
        ("V3", "P3", "nowhere", "ER", "2025-09-08T23:10:00.000Z", 23, 1, "GI", "2025-09-09T00:40:00.000Z", "?", "broken", False, None),
    )
    return er.silver_er_visits(raw)


@pytest.fixture
def shifts(table):
    raw = table(
        SHIFT,
        ("S1", "a", " Nurse ", LC, "ER", "2025-09-06T10:00:00.000Z", "2025-09-06T18:00:00.000Z", None, None, 1.0, 8.0, None),
        ("S2", "b", "Nurse", LC, "ER", "2025-09-06T10:00:00.000Z", "2025-09-06T22:00:00.000Z", False, "reported", 2.0, 12.0, "x"),
        ("S3", "c", "nurse", "Riverbend", "ER", "2025-09-08T07:00:00.000Z", "2025-09-08T15:00:00.000Z", True, "None", 0.5, 8.0, ""),
    )
    return er.silver_hr_shifts(raw)


@pytest.fixture
def raw_flow(table):
    at = "2025-09-06T10:0%d:00.000Z"
    return table(
        FLOW,
        *[(f"F{i}", LC, "ER", at % i, 10, float(i), 40.0 + i, 3, i, None) for i in range(4)],
        ("F9", "Pine Valley", None, "2025-09-08T01:00:00.000Z", 1, None, None, 3, 7, "DELAYED"),
    )


@pytest.fixture
def surveys(table, visits):
    raw = table(
        SURVEY,
        ("Q1", "V1", LC, "ER", "2025-09-07", 4.0, 3.0, 2.0, 1.0, "fine"),
        ("Q2", " V2 ", None, None, "2025-09-08", 2.0, 3.0, 2.0, 1.0, None),
        ("Q3", "V404", "Riverbend", "ER", "2025-09-08", 5.0, None, 2.0, 1.0, None),
    )
    return er.silver_surveys(raw, visits)


@pytest.fixture
def hourly(visits, raw_flow, shifts):
    return er.gold_er_operational_hourly(visits, er.clean_patient_flow(raw_flow), shifts)


@pytest.fixture
def quality(visits, raw_flow, surveys):
    return er.gold_er_quality_daily(visits, er.clean_patient_flow(raw_flow), surveys)


def test_visit_columns_in_order(visits):
    assert visits.columns == [
        "visit_id", "patient_id", "site", "unit", "arrival_time_utc", "discharge_time_utc", "provider_start_time_utc",
        "arrival_hour", "acuity_level", "diagnosis_group", "discharge_disposition", "readmission_30d_flag",
        "cost_per_visit_usd", "arrival_date", "week_start", "month_start", "day_of_week_num", "is_weekend",
        "provider_start_time_null_flag", "visit_duration_minutes", "door_to_provider_minutes_raw", "region", "service_line",
    ]


def test_visits_are_cleaned(visits):
    got = {r["visit_id"]: r for r in visits.collect()}
    v1, v2, v3 = got["V1"], got["V2"], got["V3"]
    assert (v1["site"], v1["unit"], v1["region"], v1["discharge_disposition"], v1["diagnosis_group"]) == (LC, "ER", "Urban", "Admitted", "Other")
    assert (v1["visit_duration_minutes"], v1["door_to_provider_minutes_raw"]) == (90.0, 20.5)
    assert (v1["day_of_week_num"], v1["is_weekend"], str(v1["week_start"]), str(v1["month_start"])) == (7, True, "2025-09-01 00:00:00", "2025-09-01 00:00:00")
    assert (v2["discharge_time_utc"], v2["provider_start_time_null_flag"], v2["visit_duration_minutes"], v2["discharge_disposition"]) == (None, True, None, "LWBS")
    assert (v3["site"], v3["region"], v3["discharge_disposition"], v3["provider_start_time_utc"], v3["readmission_30d_flag"]) == (
        "Unknown Site", "Unknown Region", "Discharged", None, False)


def test_visits_accept_timestamps_as_well_as_text(table, visits):
    raw = table(VISIT.replace("arrival_time string", "arrival_time timestamp"),
                ("V9", "P", LC, "ER", dt.datetime(2025, 9, 6, 10), 10, 3, None, "NaT", "LWBS", "NaT", None, 1.0))
    assert column(er.silver_er_visits(raw), "arrival_date") == [dt.date(2025, 9, 6)]


def test_shifts(shifts):
    got = {r["shift_id"]: r for r in shifts.collect()}
    assert (got["S1"]["role"], got["S1"]["attended_flag"], got["S1"]["sick_leave_flag"], got["S1"]["effective_shift_hours"]) == ("Nurse", True, False, 8.0)
    assert (got["S2"]["sick_leave_flag"], got["S2"]["effective_shift_hours"], got["S2"]["end_hour"]) == (True, 0.0, 22)
    assert (got["S3"]["role"], got["S3"]["region"], got["S3"]["is_weekend"]) == ("Other", "Rural", False)


def test_flow_median_is_the_lower_one_of_the_hour(raw_flow):
    flow = er.silver_patient_flow(raw_flow)
    assert rows(flow, "flow_id", "queue_length_median_15min", "telemetry_status", "telemetry_delayed", "unit") == [
        *[(f"F{i}", 1, "OK", False, "ER") for i in range(4)], ("F9", 7, "DELAYED", True, "ER")
    ]


def test_medians_are_exact_for_large_groups(spark):
    n = 200_001
    flow = spark.range(n).select(F.lit(LC).alias("site"), (F.pmod(F.col("id") * 7919, F.lit(n)) / 8).alias("queue_length"))
    assert column(partition_medians(flow, "queue_length", ["site"], "m"), "m") == [(n // 2) / 8]


def test_stored_medians_give_the_same_flow(raw_flow):
    medians = er.flow_hour_medians(raw_flow)
    assert rows(er.silver_patient_flow(raw_flow, medians=medians)) == rows(er.silver_patient_flow(raw_flow))


def test_surveys_keep_unmatched_rows_and_own_site(surveys):
    assert rows(surveys, "survey_id", "site", "unit", "arrival_date", "is_weekend", "region") == [
        ("Q1", LC, "ER", dt.date(2025, 9, 6), True, "Urban"),
        ("Q2", "Unknown Site", "ER", dt.date(2025, 9, 6), True, "Urban"),
        ("Q3", "Riverbend", "ER", None, None, None),
    ]


def test_risk_needs_visit_and_patient(table, visits):
    raw = table(RISK, ("V1", "P1", "2025-09-08", 0.25, " HIGH"), ("V1", "P9", "2025-09-08", 0.5, "odd"))
    assert rows(er.silver_readmission_risk(raw, visits), "patient_id", "risk_band", "site", "lag_days") == [
        ("P1", "High", LC, 2), ("P9", "Medium", None, None)
    ]


def test_hourly_is_dense_and_adds_up(hourly, visits):
    assert hourly.count() == 3 * 24 * 2  # days x hours x sites
    sums = hourly.agg(F.sum("arrivals"), F.sum("throughput")).first()
    assert tuple(sums) == (3, 1)  # the last discharge falls after the last arrival day
    assert hourly.select("site", "date", "hour_of_day").distinct().count() == hourly.count()


def test_hourly_values(hourly):
    busy = hourly.where(f"site = '{LC}' AND date = DATE '2025-09-06' AND hour_of_day = 10").first()
    assert (busy["arrivals"], busy["throughput"], busy["queue_length_median"], busy["door_to_triage_median"]) == (2, 0, 1.0, 1.0)
    assert (busy["effective_staffing_hours"], busy["nurse_to_patient_ratio"], busy["occupancy_pct"]) == (8.0, 1.0, 0.0)
    leaving = hourly.where(f"site = '{LC}' AND date = DATE '2025-09-06' AND hour_of_day = 11").first()
    assert (leaving["arrivals"], leaving["throughput"], leaving["nurse_to_patient_ratio"], leaving["occupancy_pct"]) == (0, 1, None, None)
    assert (leaving["queue_length_median"], leaving["door_to_triage_median"]) == (0.0, None)


def test_rates_are_double(hourly, quality):
    assert {dict(hourly.dtypes)[c] for c in ("nurse_to_patient_ratio", "occupancy_pct", "queue_length_median")} == {"double"}
    assert dict(quality.dtypes)["lwbs_rate"] == "double"


def test_quality(quality):
    assert rows(quality.where("date = DATE '2025-09-06'"), "visits_total", "throughput_daily", "lwbs_rate",
                "median_triage_wait_minutes", "median_door_to_provider_minutes", "satisfaction_overall_avg", "day_of_week_num") == [
        (2, 1, 0.5, 1.0, 41.0, 4.0, 7)
    ]


def test_finance_running_total_per_site(table, shifts, visits, quality):
    more = table(SHIFT, *[(f"T{i}", "a", "Tech", LC, "ER", f"2025-09-{day}T10:00:00.000Z", None, True, None, 1.0, 8.0, None)
                          for i, day in enumerate(("05", "06", "07"))])
    finance = er.gold_er_finance_daily(shifts.unionByName(er.silver_hr_shifts(more)), visits, quality)
    got = rows(finance.where(f"site = '{LC}'"), "date", "overtime_hours_sum", "cost_per_visit_avg",
               "reimbursement_at_risk_usd", "cumulative_reimbursement_at_risk_usd")
    assert got == [
        (dt.date(2025, 9, 5), 1.0, None, 0.0, 0.0),
        (dt.date(2025, 9, 6), 4.0, 75.0, 0.5 * 100 * 250 + 750, 13250.0),
        (dt.date(2025, 9, 7), 1.0, None, 0.0, 13250.0),
    ]


def test_finance_breaks_date_ties_by_unit(table, quality, visits):
    raw = table(SHIFT, *[(f"T{u}", "a", "Tech", LC, u, "2025-09-06T10:00:00.000Z", None, True, None, 1.0, 8.0, None) for u in ("Z", "ER", "A")])
    finance = er.gold_er_finance_daily(er.silver_hr_shifts(raw), visits, quality)
    assert rows(finance, "unit", "cumulative_reimbursement_at_risk_usd") == [("A", 0.0), ("ER", 13250.0), ("Z", 13250.0)]


def test_staffing_gap_is_a_high_ratio_of_nurses(shifts, hourly):
    staffing = er.gold_er_staffing_daily(shifts, hourly)
    assert rows(staffing, "site", "role", "scheduled_hours", "effective_hours", "sick_leave_rate", "avg_nurse_to_patient_ratio", "coverage_gap_flag") == [
        (LC, "Nurse", 20.0, 8.0, 0.5, 1.0, True), ("Riverbend", "Other", 8.0, 8.0, 0.0, None, False)
    ]


def test_readmission(table, visits):
    raw = table(RISK, ("V1", "P1", "2025-09-08", 0.25, "high"), ("V2", "P2", "2025-09-08", 0.75, "low"), ("V0", "P0", "2025-09-08", 0.5, "low"))
    daily = er.gold_er_readmission_daily(er.silver_readmission_risk(raw, visits), visits)
    assert rows(daily, "site", "region", "avg_readmission_probability", "high_risk_share", "realized_readmissions_30d") == [
        (LC, "Urban", 0.5, 0.5, 1), (None, "Unknown Region", 0.5, 0.0, None)
    ]


def test_filters_bridge_is_distinct(visits, shifts):
    bridge = er.gold_er_filters_bridge(visits, shifts.unionByName(shifts))
    assert bridge.count() == bridge.distinct().count() == 4
    assert bridge.where("role IS NULL").count() == 2


# ---- serving --------------------------------------------------------------


def test_periods(table):
    df = table("date string", *[(x,) for x in ("2025-08-31", "2025-09-01", "2025-09-30", "2025-10-01")]).select(F.col("date").cast("date").alias("date"))
    assert column(df, se.SEPTEMBER.holds()) == column(df, se.SEPTEMBER.holds_half_open()) == [False, True, True, False]


def test_reports_are_ordered(quality, hourly, shifts, visits):
    ranking = se.er_lwbs_ranking(quality).collect()
    assert [r["lwbs_rate"] for r in ranking] == [0.5, 0.0]
    compare = se.er_weekend_compare(quality).collect()
    assert [(r["site"], r["is_weekend"], r["total_throughput"]) for r in compare] == [(LC, True, 1), ("Unknown Site", False, 1)]
    finance = er.gold_er_finance_daily(shifts, visits, quality)
    assert rows(se.er_reimbursement_weekend(finance)) == [(LC, 13250.0, 13250.0)]
    assert rows(se.er_top10_lwbs_pct(quality, 1), "site", "lwbs_rate_pct") == [(LC, 50.0)]
    gaps = se.er_coverage_gaps(er.gold_er_staffing_daily(shifts, hourly))
    assert rows(gaps, "site", "nurse_to_patient_ratio") == [(LC, 1.0)]
