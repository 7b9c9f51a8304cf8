"""Chronic-care tables on hand-made rows; the risk table against a patient-day brute force."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from carepulse.plans import cc, serving_cc as sc
from helpers import column, rows

PATIENT = "patient_id string, region string, condition string, risk_tier string, program string, enrollment_date timestamp, active_flag boolean"
READING = ("reading_id string, patient_id string, region string, device_type string, vendor string, firmware_version string, "
           "reading_time timestamp, glucose_mg_dl double, bp_systolic_mm_hg double, bp_diastolic_mm_hg double, weight_kg double, "
           "valid_flag boolean, error_code string")
NOTE = "note_id string, patient_id string, region string, note_time timestamp, note_text string, diet_non_adherence_flag boolean, med_adherence_flag boolean"
CHANGE = ("change_id string, change_date timestamp, vendor string, device_type string, version string, regions_scope string, "
          "change_type string, error_codes string, notes string")
ACTION = ("action_id string, patient_id string, region string, action_time timestamp, action_type string, condition string, "
          "executed_flag boolean, estimated_cost_usd double")


def t(day, hour=8, minute=0, month=10):
    return dt.datetime(2025, month, day, hour, minute)


@pytest.fixture
def patients(table):
    return cc.silver_patient_master(table(
        PATIENT,
        ("A", " east", "Diabetes", "HIGH", "CCM", t(1), True),
        ("B", "CENTRAL", "hypertension ", "low", "Nutri+", t(1), True),
        ("C", "North", None, None, "x", t(1), True),
        ("D", None, "asthma", "odd", None, t(1), False),
        ("E", "East", "diabetes", "high", "CCM+Nutrition", t(1), None),
    ))


def reading(i, who, device, when, glucose=None, sys=None, dia=None, kg=None, ok=True, err=None, vendor="DEVCO-GM", region="East"):
    return (f"R{i:03d}", who, region, device, vendor, "v1", when, glucose, sys, dia, kg, ok, err)


@pytest.fixture
def readings(table):
    return cc.silver_device_readings(table(
        READING,
        reading(1, "A", "glucose", t(1), glucose=150.0),
        reading(2, "A", "BP ", t(1), sys=141.0, ok=False, vendor="devco-bp"),
        reading(3, "A", "bp", t(2), sys=120.0, dia=80.0, err="NONE"),
        reading(4, "B", "pump", t(2), ok=None, err="BT-GM-3921", vendor="other", region="Central"),
        reading(5, "B", "bp", t(21), sys=120.0, dia=None, region="Central"),
        reading(6, "Z", "weight", t(2), kg=70.0, region="West"),
    ))


@pytest.fixture
def notes(table):
    return cc.silver_encounter_notes(table(
        NOTE,
        ("N1", "A", "East", t(1), "..", True, None),
        ("N2", "A", "East", t(2), "..", False, True),
        ("N3", "C", "North", t(22), "..", True, True),
    ))


@pytest.fixture
def calendar(spark):
    return cc.gold_date_spine(spark, "2025-10-01", "2025-10-22")


def test_patients(patients):
    assert rows(patients, "patient_id", "region", "condition", "risk_tier", "program") == [
        ("A", "East", "diabetes", "high", "CCM"), ("B", "Central", "hypertension", "low", "CCM+Nutrition"),
        ("C", "North", "diabetes", "medium", "CCM"), ("D", "East", "diabetes", "medium", "CCM"),
        ("E", "East", "diabetes", "high", "CCM+Nutrition"),
    ]


def test_readings(readings):
    assert rows(readings, "reading_id", "device_type", "vendor", "error_code", "bp_missing_diastolic") == [
        ("R001", "glucose", "DEVCO-GM", "NONE", False), ("R002", "bp", "DEVCO-BP", "NONE", True),
        ("R003", "bp", "DEVCO-GM", "NONE", False), ("R004", "glucose", "DEVCO-GM", "BT-GM-3921", False),
        ("R005", "bp", "DEVCO-GM", "NONE", True), ("R006", "weight", "DEVCO-GM", "NONE", False),
    ]


def test_notes_have_no_text(notes):
    assert "note_text" not in notes.columns


def test_medications_are_matched_exactly(table):
    raw = table("list_id string, patient_id string, region string, snapshot_time timestamp, med_class string, change_type string",
                ("1", "A", "East", t(1), "ARB", "stop"), ("2", "A", "East", t(1), "arb", " stop"), ("3", "A", "East", t(1), None, None))
    assert rows(cc.silver_medication_lists(raw), "list_id", "med_class", "change_type") == [
        ("1", "ARB", "stop"), ("2", "Other", "no_change"), ("3", "Other", "no_change")
    ]


def test_actions_fall_back_to_the_registry(table, patients):
    raw = table(ACTION, ("1", "B", "East", t(1), "call", "odd", True, 5.0), ("2", "B", "East", t(1), "Medication_Review", "Diabetes", False, 7.0),
                ("3", "nobody", "East", t(1), None, None, None, None))
    assert rows(cc.silver_care_actions(raw, patients), "action_id", "condition", "action_type") == [
        ("1", "hypertension", "nurse_outreach"), ("2", "diabetes", "medication_review"), ("3", None, "nurse_outreach")
    ]


def test_ingestion_is_dense(readings, calendar, patients):
    out = cc.gold_device_ingestion(readings, calendar, patients)
    assert out.count() == 22 * 3 * 3  # days x regions x devices
    assert rows(out.where("readings_total > 0"), "date", "region", "device_type", "readings_total", "readings_valid", "valid_rate") == [
        (dt.date(2025, 10, 1), "East", "bp", 1, 0, 0.0), (dt.date(2025, 10, 1), "East", "glucose", 1, 1, 1.0),
        (dt.date(2025, 10, 2), "Central", "glucose", 1, 0, 0.0), (dt.date(2025, 10, 2), "East", "bp", 1, 1, 1.0),
        (dt.date(2025, 10, 21), "Central", "bp", 1, 1, 1.0),
    ]
    assert out.where("readings_total = 0 AND valid_rate IS NOT NULL").count() == 0


def test_bp_quality_and_signals(readings, notes):
    assert (dt.date(2025, 10, 1), "East", 1, 1, 1.0) in rows(cc.gold_bp_quality(readings))
    assert (dt.date(2025, 10, 2), "West", 0, 0, None) in rows(cc.gold_bp_quality(readings))
    assert (dt.date(2025, 10, 1), "East", 1.0, 0.0, 1) in rows(cc.gold_encounter_signals(notes))


def brute_force_risk(calendar, patients, readings, notes, w):
    """Plain Python over every active patient and day."""
    groups = {}
    rs, ns = readings.collect(), notes.collect()
    for day in column(calendar, "date"):
        for p in patients.where("active_flag").collect():
            mine = [r for r in rs if r["patient_id"] == p["patient_id"] and r["date"] == day]
            said = [n for n in ns if n["patient_id"] == p["patient_id"] and n["date"] == day]
            score = {"high": w.high, "medium": w.medium}.get(p["risk_tier"], w.low)
            if p["condition"] == "diabetes" and not any(r["device_type"] == "glucose" and r["valid_flag"] for r in mine):
                score += w.no_glucose
            if p["condition"] == "hypertension" and not any(r["device_type"] == "bp" and r["valid_flag"] for r in mine):
                score += w.no_bp
            if mine:
                score += min(sum(r["device_type"] == "bp" and r["bp_missing_diastolic"] for r in mine) / len(mine) * w.missing_factor, w.missing_cap)
            score += w.diet * any(n["diet_non_adherence_flag"] for n in said) + w.medication * any(n["med_adherence_flag"] for n in said)
            if w.incident_start <= str(day) <= w.incident_end and (p["risk_tier"], p["condition"]) == ("high", "diabetes"):
                score *= w.incident_factor
            groups.setdefault((day, p["region"], p["risk_tier"], p["condition"]), []).append(min(score, w.cap))
    return {k: (sum(v) / len(v), len(v)) for k, v in groups.items()}


def test_risk_equals_the_patient_day_brute_force(calendar, patients, readings, notes):
    w = cc.RiskWeights()
    more = patients.unionByName(patients.where("patient_id IN ('A', 'B')").withColumn("patient_id", F.concat("patient_id", F.lit("2"))))
    got = cc.gold_patient_risk_daily(calendar, more, readings, notes, w).collect()
    want = brute_force_risk(calendar, more, readings, notes, w)
    assert len(got) == len(want)
    for r in got:
        score, n = want[(r["date"], r["region"], r["risk_tier"], r["condition"])]
        assert r["patient_days"] == n and r["avg_risk_score"] == pytest.approx(score, abs=1e-12)


def test_incident_window_includes_its_last_day(calendar, patients, readings, notes):
    risk = cc.gold_patient_risk_daily(calendar, patients, readings, notes)
    score = {r["date"].day: r["avg_risk_score"] for r in risk.where("risk_tier = 'high'").collect()}
    assert score[21] == pytest.approx(1.0) and score[22] == pytest.approx(0.7)


def test_weekly_means(table):
    daily = table("date string, region string, risk_tier string, condition string, avg_risk_score double, patient_days long",
                  ("2025-10-06", "East", "high", "diabetes", 0.2, 1), ("2025-10-07", "East", "high", "diabetes", 0.6, 3))
    daily = daily.withColumn("date", F.col("date").cast("date"))
    assert rows(cc.gold_patient_risk_weekly(daily), "avg_risk_score", "patient_days") == [(0.4, 4)]
    assert cc.gold_patient_risk_weekly_weighted(daily).first()["avg_risk_score"] == pytest.approx(0.5)


def test_costs_and_weekly_actions(table, patients):
    raw = table(ACTION, *[(str(i), "A", "East", t(day), "nurse_outreach", "diabetes", done, 10.0 * i)
                          for i, (day, done) in enumerate([(6, True), (7, False), (7, True), (8, None)], 1)])
    actions = cc.silver_care_actions(raw, patients)
    assert rows(cc.gold_cumulative_care_cost(actions), "executed_cost_usd", "running_total_cost_usd") == [(0.0, 40.0), (10.0, 10.0), (30.0, 40.0)]
    assert rows(cc.gold_care_actions_weekly(actions), "actions_total", "actions_executed", "execute_rate", "avg_cost_usd") == [(4, 2, 0.5, 25.0)]


def test_root_cause_fans_out_by_change_and_by_vendor(table, calendar, patients):
    readings = cc.silver_device_readings(table(
        READING, reading(1, "A", "glucose", t(9), glucose=1.0, err="E1"), reading(2, "A", "glucose", t(9), glucose=1.0, vendor="DEVCO-BP"),
        reading(3, "A", "weight", t(9), kg=1.0)))
    changes = cc.silver_device_change_log(table(
        CHANGE, ("1", t(9), "x", "Glucose", "v2", " Central ,East", "Rollout", None, "n"), ("2", t(9), None, "glucose", "v3", "East", "odd ", "E", "n"),
        ("3", t(9), "x", "glucose", "v4", None, "hotfix", "E", "n"), ("4", t(9), "x", "weight", "v5", "East", "hotfix", "E", "n")))
    out = cc.gold_root_cause_alignment(cc.gold_device_ingestion(readings, calendar, patients), changes, readings)
    east = out.where("date = DATE '2025-10-09' AND region = 'East' AND device_type = 'glucose'")
    assert rows(east, "vendor", "version", "change_type", "error_codes", "error_events") == [
        ("DEVCO-GM", "v3", "odd", "E", 0), ("DEVCO-GM", "v3", "odd", "E", 1), ("x", "v2", "rollout", "NONE", 0), ("x", "v2", "rollout", "NONE", 1)
    ]
    assert out.where("device_type = 'weight'").count() == 0
    assert rows(out.where("date = DATE '2025-10-09' AND region = 'Central' AND device_type = 'glucose'"), "version", "error_events") == [("v2", None)]


def test_counters(readings, calendar, patients, notes, table):
    assert rows(cc.counter_active_patients(patients, readings, calendar)) == [(2,)]
    assert rows(cc.counter_active_patients(patients, readings, calendar, days=2)) == [(1,)]
    assert rows(cc.counter_valid_readings_7d(readings, calendar)) == [(1,)]
    risk = cc.gold_patient_risk_daily(calendar, patients, readings, notes)
    want = risk.where("risk_tier = 'high' AND date >= DATE '2025-10-16'").agg(F.avg("avg_risk_score")).first()[0]
    assert cc.counter_high_risk_avg_7d(risk).first()[0] == pytest.approx(want)
    raw = table(ACTION, *[(str(day), "A", "East", t(day), "call", "diabetes", day != 10, 1.0) for day in (8, 9, 10, 22)])
    assert rows(cc.counter_actions_executed_14d(cc.silver_care_actions(raw, patients), calendar)) == [(2,)]


def test_bridge(readings, calendar, patients, notes, table):
    ingestion = cc.gold_device_ingestion(readings, calendar, patients)
    risk = cc.gold_patient_risk_daily(calendar, patients, readings, notes)
    weekly = cc.gold_care_actions_weekly(cc.silver_care_actions(table(ACTION, ("1", "A", "East", t(8), "call", "diabetes", True, 1.0)), patients))
    out = cc.gold_cc_filters_bridge(ingestion, risk, weekly)
    assert out.columns == ["date", "region", "field_name", "field_value"]
    assert out.count() == 2 * ingestion.count() + 2 * risk.count() + weekly.count()


# ---- per-patient reports --------------------------------------------------


def test_latest_vitals(table):
    old = reading(0, "A", "weight", t(1), kg=80.0)  # among the patient's readings, but not the last ten
    many = [reading(i, "A", "glucose", t(2, 8, i), glucose=100.0 + i) for i in range(1, 10)]
    tie = [reading(i, "A", "bp", t(3), sys=130.0, dia=dia) for i, dia in ((20, 95.0), (21, 80.9))]
    other = [reading(30, "B", "bp", t(3), sys=150.0, dia=None), reading(31, "B", "bp", t(2), sys=150.0, dia=90.0), reading(32, "B", "weight", t(3), kg=80.0)]
    readings = cc.silver_device_readings(table(READING, old, *many, *tie, *other))
    out = sc.latest_vitals(readings, "2025-10-03 10:00:00")
    assert rows(out, "patient_id", "type", "value", "status", "trend", "last_reading") == [
        ("A", "Blood Pressure", "130/80 mmHg", "normal", "down", "2 hours ago"),
        ("A", "Glucose", "109 mg/dL", "normal", "down", "1 day ago"),
        ("B", "Weight", "176.4 lbs", "normal", "down", "2 hours ago"),
    ]


def test_vitals_limits(table):
    readings = cc.silver_device_readings(table(
        READING, reading(1, "A", "glucose", t(1), glucose=130.0), reading(2, "B", "glucose", t(1), glucose=130.5),
        reading(3, "C", "bp", t(1), sys=140.0, dia=60.0), reading(4, "D", "bp", t(1), sys=100.0, dia=90.0)))
    assert rows(sc.latest_vitals(readings, "2025-10-02"), "patient_id", "status", "trend") == [
        ("A", "normal", "down"), ("B", "warning", "up"), ("C", "warning", "up"), ("D", "warning", "up")
    ]


def test_latest_risk_and_fallback(calendar, patients, readings, notes):
    risk = cc.gold_patient_risk_daily(calendar, patients.where("patient_id <> 'C'"), readings, notes)
    got = {r["patient_id"]: r for r in sc.latest_risk(patients, risk).collect()}
    assert got["A"]["overall"] == pytest.approx(0.7) and got["A"]["score_date"] == dt.date(2025, 10, 22)
    assert (got["A"]["hospitalization"], got["A"]["deterioration"]) == ("Medium-High", "Medium")
    assert (got["B"]["hospitalization"], got["B"]["deterioration"]) == ("Low", "Low")
    assert (got["C"]["overall"], got["C"]["score_date"], got["C"]["hospitalization"]) == (0.68, None, "Medium-High")


def test_recent_notes_show_flagged_ones_of_the_last_five(table):
    flags = [(True, True)] + [(False, False), (True, False), (False, True), (True, True), (None, None)]
    notes = cc.silver_encounter_notes(table(NOTE, *[(f"N{i}", "A", "East", t(1 + i), "", *f) for i, f in enumerate(flags)]))
    assert rows(sc.recent_notes(notes), "note_id", "date", "summary") == [
        ("N2", "10/03/2025", "Diet non-adherence noted."), ("N3", "10/04/2025", "Medication adherence issues."),
        ("N4", "10/05/2025", "Diet non-adherence noted. Medication adherence issues."),
    ]


def test_patient_info(patients):
    assert rows(sc.patient_info(patients, "B"), "patient_id", "risk_tier") == [("B", "low")]
    assert sc.patient_info(patients, "none").count() == 0
