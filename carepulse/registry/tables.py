"""The silver, gold and counter tables."""

from __future__ import annotations

from ..plans import cc, er
from ..session import shared_dir
from ..sources.files import stored
from .core import query
from .inputs import Inputs


def _table(key: str, doubles: str = "", sql: str | None = None):
    return query(key, sql or f"SELECT * FROM {key}", doubles)


_table("silver_er_visits", "visit_duration_minutes door_to_provider_minutes_raw")(lambda t: t.visits)
_table("silver_hr_shifts")(lambda t: t.shifts)


@query("silver_patient_flow", "SELECT * FROM silver_patient_flow")
def _flow(t: Inputs):
    """The small medians are stored first, so the telemetry rows need no shuffle to meet them."""
    medians = stored(er.flow_hour_medians(t.raw("raw_patient_flow")), shared_dir(t.spark, "medians"))
    return er.silver_patient_flow(t.raw("raw_patient_flow"), medians=medians)


_table("silver_surveys")(lambda t: t.surveys)
_table("silver_readmission_risk", "readmission_probability")(lambda t: t.risk_feed)

_table(
    "gold_er_operational_hourly",
    "queue_length_median door_to_triage_median door_to_provider_median effective_staffing_hours "
    "nurse_to_patient_ratio occupancy_pct",
)(lambda t: t.hourly)
_table("gold_er_quality_daily", "lwbs_rate satisfaction_overall_avg")(lambda t: t.quality)
_table(
    "gold_er_finance_daily",
    "overtime_hours_sum cost_per_visit_avg reimbursement_at_risk_usd cumulative_reimbursement_at_risk_usd",
)(lambda t: t.finance)
_table("gold_er_staffing_daily", "sick_leave_rate avg_nurse_to_patient_ratio")(lambda t: t.staffing)
_table("gold_er_readmission_daily", "avg_readmission_probability high_risk_share")(lambda t: t.readmission)
_table("gold_er_filters_bridge")(lambda t: er.gold_er_filters_bridge(t.visits, t.shifts))

_table("silver_patient_master")(lambda t: t.patients)
_table("silver_device_readings")(lambda t: t.readings)
_table("silver_encounter_notes")(lambda t: t.notes)
_table("silver_medication_lists")(lambda t: cc.silver_medication_lists(t.raw("raw_medication_lists")))
_table("silver_device_change_log")(lambda t: t.changes)
_table("silver_care_actions")(lambda t: t.actions)

_table("gold_device_ingestion", "valid_rate")(lambda t: t.ingestion)
_table("gold_bp_quality", "missing_rate_diastolic")(lambda t: cc.gold_bp_quality(t.readings))
_table("gold_encounter_signals", "pct_notes_with_diet_non_adherence pct_notes_with_med_adherence_issues")(
    lambda t: cc.gold_encounter_signals(t.notes)
)
_table("gold_patient_risk_daily", "avg_risk_score")(lambda t: t.patient_risk)
_table("gold_patient_risk_weekly", "avg_risk_score")(lambda t: cc.gold_patient_risk_weekly(t.patient_risk))
_table("gold_care_actions_weekly", "execute_rate avg_cost_usd")(lambda t: t.actions_weekly)
_table("gold_cumulative_care_cost")(
    lambda t: cc.gold_cumulative_care_cost(t.actions)
)
_table("gold_root_cause_alignment", "valid_rate valid_rate_lag7 delta_vs_7d")(lambda t: t.alignment)
_table("gold_cc_filters_bridge")(
    lambda t: cc.gold_cc_filters_bridge(t.ingestion, t.patient_risk, t.actions_weekly)
)


@query("gold_date_spine", """
SELECT s.*, count(r.reading_id) AS readings_total FROM gold_date_spine s
LEFT JOIN silver_device_readings r ON r.date = s.date GROUP BY ALL""")
def _spine(t: Inputs):
    """The calendar with the readings of each day, so that the work follows the data."""
    from ..operators.aggregates import count_by
    from ..operators.joining import densify

    daily = count_by(t.readings, {"date": "date"}, "readings_total")
    return densify(t.calendar, [daily], ["date"], {"readings_total": 0})


@query("gold_patient_risk_weekly_weighted", """
SELECT CAST(date_trunc('week', date) AS TIMESTAMP) AS week_start, region, risk_tier, condition,
  sum(avg_risk_score * patient_days) / sum(patient_days) AS avg_risk_score, CAST(sum(patient_days) AS BIGINT) AS patient_days
FROM gold_patient_risk_daily GROUP BY ALL""", "avg_risk_score")
def _weighted(t: Inputs):
    return cc.gold_patient_risk_weekly_weighted(t.patient_risk)


@query("counter_active_patients", """
SELECT count(DISTINCT patient_id) AS active_ccm_patients
FROM silver_patient_master JOIN silver_device_readings USING (patient_id), (SELECT max(date) AS d FROM gold_date_spine) m
WHERE active_flag AND date BETWEEN d - 29 AND d""")
def _active(t: Inputs):
    return cc.counter_active_patients(t.patients, t.readings, t.calendar)


@query("counter_valid_readings_7d", """
SELECT count(*) FILTER (WHERE valid_flag) AS valid_readings_last7
FROM silver_device_readings, (SELECT max(date) AS d FROM gold_date_spine) m WHERE date BETWEEN d - 6 AND d""")
def _valid(t: Inputs):
    return cc.counter_valid_readings_7d(t.readings, t.calendar)


@query("counter_high_risk_avg_7d", """
SELECT avg(avg_risk_score) AS avg_daily_risk_high_last7
FROM gold_patient_risk_daily, (SELECT max(date) AS d FROM gold_patient_risk_daily) m
WHERE risk_tier = 'high' AND date BETWEEN d - 6 AND d""", "avg_daily_risk_high_last7")
def _high(t: Inputs):
    return cc.counter_high_risk_avg_7d(t.served("patient_risk"))


@query("counter_actions_executed_14d", """
SELECT count(*) FILTER (WHERE executed_flag) AS actions_executed_last14
FROM silver_care_actions, (SELECT max(date) AS d FROM gold_date_spine) m WHERE date BETWEEN d - 13 AND d""")
def _executed(t: Inputs):
    return cc.counter_actions_executed_14d(t.actions, t.calendar)
