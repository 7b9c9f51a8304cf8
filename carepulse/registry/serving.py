"""The serving queries."""

from __future__ import annotations

from ..plans import serving_cc as sc, serving_er as se
from ..sources.files import footer_counts
from .core import query
from .inputs import AS_OF, JANUARY, MID_MONTH, Inputs
from .oracle import half_up

DAYS = f"date BETWEEN DATE '{MID_MONTH.first}' AND DATE '{MID_MONTH.last}'"
ALL_DAYS = f"date BETWEEN DATE '{JANUARY.first}' AND DATE '{JANUARY.last}'"
WEEKS = f"week_start BETWEEN TIMESTAMP '{MID_MONTH.first}' AND TIMESTAMP '{MID_MONTH.last}'"
WAITS = "median_triage_wait_minutes, median_door_to_provider_minutes"


STORED = {"quality": "gold_er_quality_daily", "hourly": "gold_er_operational_hourly", "finance": "gold_er_finance_daily",
          "staffing": "gold_er_staffing_daily", "readmission": "gold_er_readmission_daily", "ingestion": "gold_device_ingestion",
          "patient_risk": "gold_patient_risk_daily", "bp_quality": "gold_bp_quality", "encounter_signals": "gold_encounter_signals"}


@query("store_reports", " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in STORED.values()))
def _store(t: Inputs):
    """The step before the reports: their tables stored by date, and counted from the footers."""
    return footer_counts(t.spark, {table: t.served_path(name) for name, table in STORED.items()})


@query("er_weekend_compare", f"""
SELECT site, is_weekend, {half_up('avg(lwbs_rate)', 4)} AS avg_lwbs_rate,
  {half_up('avg(median_triage_wait_minutes)', 2)} AS avg_triage_wait_min,
  {half_up('avg(median_door_to_provider_minutes)', 2)} AS avg_door_to_provider_min,
  CAST(sum(throughput_daily) AS BIGINT) AS total_throughput
FROM gold_er_quality_daily WHERE {DAYS} GROUP BY ALL""")
def _weekend(t: Inputs):
    return se.er_weekend_compare(t.served("quality"), MID_MONTH)


@query("er_coverage_gaps", f"""
SELECT site, date, role, coverage_gap_flag, avg_nurse_to_patient_ratio AS nurse_to_patient_ratio, sick_leave_rate
FROM gold_er_staffing_daily WHERE role = 'Nurse' AND is_weekend AND coverage_gap_flag AND {DAYS}""",
       "nurse_to_patient_ratio sick_leave_rate")
def _gaps(t: Inputs):
    return se.er_coverage_gaps(t.served("staffing"), MID_MONTH)


@query("er_overtime_vs_quality", f"""
SELECT site, date, overtime_hours_sum, lwbs_rate, median_door_to_provider_minutes
FROM gold_er_finance_daily JOIN (SELECT site, unit, date, lwbs_rate, median_door_to_provider_minutes FROM gold_er_quality_daily) q
USING (site, unit, date) WHERE {DAYS}""", "lwbs_rate")
def _overtime(t: Inputs):
    return se.er_overtime_vs_quality(t.served("finance"), t.served("quality"), MID_MONTH)


@query("er_reimbursement_weekend", f"""
SELECT site, sum(reimbursement_at_risk_usd) AS weekend_reimbursement_at_risk_usd,
  max(cumulative_reimbursement_at_risk_usd) AS cumulative_reimbursement_at_risk_usd
FROM gold_er_finance_daily WHERE is_weekend AND {DAYS} GROUP BY site""",
       "weekend_reimbursement_at_risk_usd cumulative_reimbursement_at_risk_usd")
def _reimbursement(t: Inputs):
    return se.er_reimbursement_weekend(t.served("finance"), MID_MONTH)


@query("er_hourly_signature", f"""
SELECT site, date, hour_of_day, arrivals, queue_length_median, {half_up('door_to_triage_median', 2)} AS door_to_triage_median_min,
  {half_up('door_to_provider_median', 2)} AS door_to_provider_median_min, {half_up('nurse_to_patient_ratio', 3)} AS nurse_to_patient_ratio
FROM gold_er_operational_hourly WHERE is_weekend AND {DAYS}""", "nurse_to_patient_ratio")
def _signature(t: Inputs):
    return se.er_hourly_signature(t.served("hourly"), MID_MONTH)


@query("er_readmission_exposure", f"""
SELECT site, is_weekend, {half_up('avg(avg_readmission_probability)', 4)} AS avg_readmit_prob,
  {half_up('avg(high_risk_share)', 5)} AS high_risk_share_avg, CAST(sum(realized_readmissions_30d) AS BIGINT) AS readmissions_30d
FROM gold_er_readmission_daily WHERE {DAYS} GROUP BY ALL""", "avg_readmit_prob high_risk_share_avg")
def _exposure(t: Inputs):
    return se.er_readmission_exposure(t.served("readmission"), MID_MONTH)


@query("er_lwbs_daily", f"""
SELECT site, date, is_weekend, visits_total, lwbs_rate, {WAITS} FROM gold_er_quality_daily WHERE {DAYS}""", "lwbs_rate")
def _lwbs(t: Inputs):
    return se.er_lwbs_daily(t.served("quality"), MID_MONTH)


@query("er_nurse_sick_leave", f"""
SELECT site, date, is_weekend, role, effective_hours, sick_leave_rate, avg_nurse_to_patient_ratio, coverage_gap_flag
FROM gold_er_staffing_daily WHERE role = 'Nurse' AND {DAYS}""", "sick_leave_rate avg_nurse_to_patient_ratio")
def _sick(t: Inputs):
    return se.er_nurse_sick_leave(t.served("staffing"), MID_MONTH)


@query("er_urban_hourly", f"""
SELECT site, date, hour_of_day, is_weekend, arrivals, throughput, queue_length_median,
  door_to_triage_median AS triage_wait_median, door_to_provider_median, effective_staffing_hours, nurse_to_patient_ratio
FROM gold_er_operational_hourly WHERE region = 'Urban' AND {DAYS}""", "nurse_to_patient_ratio")
def _urban(t: Inputs):
    return se.er_urban_hourly(t.served("hourly"), MID_MONTH)


@query("er_finance_listing", f"""
SELECT site, date, is_weekend, overtime_hours_sum, cost_per_visit_avg, reimbursement_at_risk_usd,
  cumulative_reimbursement_at_risk_usd FROM gold_er_finance_daily WHERE {DAYS}""",
       "cost_per_visit_avg reimbursement_at_risk_usd cumulative_reimbursement_at_risk_usd")
def _finance(t: Inputs):
    return se.er_finance_listing(t.served("finance"), MID_MONTH)


@query("er_finance_by_region", f"""
SELECT date, site, region, is_weekend, overtime_hours_sum, reimbursement_at_risk_usd, cumulative_reimbursement_at_risk_usd
FROM gold_er_finance_daily WHERE unit = 'ER' AND {DAYS}""",
       "reimbursement_at_risk_usd cumulative_reimbursement_at_risk_usd")
def _finance_region(t: Inputs):
    return se.er_finance_by_region(t.served("finance"), MID_MONTH)


@query("er_readmission_listing", f"""
SELECT site, date, is_weekend, avg_readmission_probability, high_risk_share, realized_readmissions_30d
FROM gold_er_readmission_daily WHERE {DAYS}""", "avg_readmission_probability high_risk_share")
def _readmissions(t: Inputs):
    return se.er_readmission_listing(t.served("readmission"), MID_MONTH)


@query("er_lwbs_ranking", f"""
SELECT date, is_weekend, site, visits_total, lwbs_rate, {WAITS} FROM gold_er_quality_daily WHERE unit = 'ER' AND {DAYS}""",
       "lwbs_rate")
def _ranking(t: Inputs):
    return se.er_lwbs_ranking(t.served("quality"), MID_MONTH)


@query("er_gap_vs_quality", f"""
SELECT q.date, q.site, q.region, s.sick_leave_rate, s.avg_nurse_to_patient_ratio, s.coverage_gap_flag, q.lwbs_rate,
  q.median_triage_wait_minutes, q.median_door_to_provider_minutes
FROM gold_er_quality_daily q JOIN gold_er_staffing_daily s ON q.date = s.date AND q.site = s.site AND q.unit = s.unit
WHERE q.unit = 'ER' AND s.role = 'Nurse' AND q.{DAYS}""", "sick_leave_rate avg_nurse_to_patient_ratio lwbs_rate")
def _gap_quality(t: Inputs):
    return se.er_gap_vs_quality(t.served("quality"), t.served("staffing"), MID_MONTH)


@query("er_weekend_hour_peaks", f"""
SELECT site, hour_of_day, avg(arrivals) AS avg_arrivals, avg(queue_length_median) AS avg_queue_median,
  avg(door_to_triage_median) AS avg_triage_wait_mins, avg(door_to_provider_median) AS avg_dtp_mins,
  avg(effective_staffing_hours) AS avg_effective_staffing_hours
FROM gold_er_operational_hourly WHERE unit = 'ER' AND is_weekend AND {DAYS} GROUP BY ALL""",
       "avg_arrivals avg_queue_median avg_triage_wait_mins avg_dtp_mins avg_effective_staffing_hours")
def _peaks(t: Inputs):
    return se.er_weekend_hour_peaks(t.served("hourly"), MID_MONTH)


@query("er_risk_vs_access", f"""
SELECT r.date, r.site, r.region, r.is_weekend, r.avg_readmission_probability, r.high_risk_share, q.lwbs_rate,
  q.median_door_to_provider_minutes
FROM gold_er_readmission_daily r JOIN gold_er_quality_daily q ON r.date = q.date AND r.site = q.site AND r.unit = q.unit
WHERE r.unit = 'ER' AND r.{DAYS}""", "avg_readmission_probability high_risk_share lwbs_rate")
def _access(t: Inputs):
    return se.er_risk_vs_access(t.served("readmission"), t.served("quality"), MID_MONTH)


@query("er_top10_lwbs_pct", f"""
SELECT site, date, is_weekend, visits_total, {half_up('lwbs_rate * 100', 2)} AS lwbs_rate_pct, {WAITS}, satisfaction_overall_avg
FROM gold_er_quality_daily WHERE {ALL_DAYS} ORDER BY lwbs_rate DESC, date, site, unit, is_weekend LIMIT 10""",
       "lwbs_rate_pct satisfaction_overall_avg")
def _top(t: Inputs):
    return se.er_top10_lwbs_pct(t.served("quality"), 10, JANUARY)


@query("cc_valid_readings", f"SELECT * FROM gold_device_ingestion WHERE {DAYS}", "valid_rate")
def _cc_valid(t: Inputs):
    return sc.cc_valid_readings(t.served("ingestion"), MID_MONTH)


@query("cc_bp_missing", f"SELECT * FROM gold_bp_quality WHERE {DAYS}", "missing_rate_diastolic")
def _cc_bp(t: Inputs):
    return sc.cc_bp_missing(t.served("bp_quality"), MID_MONTH)


@query("cc_risk_weekly", f"SELECT * FROM gold_patient_risk_weekly WHERE {WEEKS}", "avg_risk_score")
def _cc_weekly(t: Inputs):
    return sc.cc_risk_weekly(t.served("risk_weekly"), MID_MONTH)


@query("cc_root_cause", f"SELECT * FROM gold_root_cause_alignment WHERE {DAYS}", "valid_rate valid_rate_lag7 delta_vs_7d")
def _cc_cause(t: Inputs):
    return sc.cc_root_cause(t.served("alignment"), MID_MONTH)


@query("cc_actions_weekly", f"SELECT * FROM gold_care_actions_weekly WHERE {WEEKS}", "execute_rate avg_cost_usd")
def _cc_actions(t: Inputs):
    return sc.cc_actions_weekly(t.served("actions_weekly"), MID_MONTH)


@query("cc_cumulative_cost", f"SELECT * FROM gold_cumulative_care_cost WHERE {DAYS}")
def _cc_cost(t: Inputs):
    return sc.cc_cumulative_cost(t.served("cumulative_cost"), MID_MONTH)


@query("cc_encounter_signals", f"SELECT * FROM gold_encounter_signals WHERE {DAYS}",
       "pct_notes_with_diet_non_adherence pct_notes_with_med_adherence_issues")
def _cc_signals(t: Inputs):
    return sc.cc_encounter_signals(t.served("encounter_signals"), MID_MONTH)


@query("patient_info", "SELECT * FROM silver_patient_master WHERE patient_id = 'PT-42'")
def _info(t: Inputs):
    return sc.patient_info(t.served("patients"), "PT-42")


@query("latest_vitals", f"""
SELECT patient_id, type, value, CASE WHEN high THEN 'warning' ELSE 'normal' END AS status,
  CASE WHEN high THEN 'up' ELSE 'down' END AS trend,
  CASE WHEN days > 0 THEN days || CASE WHEN days > 1 THEN ' days ago' ELSE ' day ago' END
    WHEN secs > 3600 THEN (secs // 3600) || CASE WHEN secs >= 7200 THEN ' hours ago' ELSE ' hour ago' END
    ELSE (secs // 60) || CASE WHEN secs >= 120 THEN ' minutes ago' ELSE ' minute ago' END END AS last_reading,
  CASE type WHEN 'Glucose' THEN '80-130 mg/dL' WHEN 'Weight' THEN '170-175 lbs' ELSE '<140/90 mmHg' END AS target
FROM (
  SELECT patient_id, CASE device_type WHEN 'glucose' THEN 'Glucose' WHEN 'bp' THEN 'Blood Pressure' ELSE 'Weight' END AS type,
    CASE device_type WHEN 'glucose' THEN CAST(trunc(glucose_mg_dl) AS INT) || ' mg/dL'
      WHEN 'bp' THEN CAST(trunc(bp_systolic_mm_hg) AS INT) || '/' || CAST(trunc(bp_diastolic_mm_hg) AS INT) || ' mmHg'
      ELSE printf('%.1f lbs', weight_kg * 2.20462::DOUBLE) END AS value,
    coalesce(CASE device_type WHEN 'glucose' THEN glucose_mg_dl > 130 WHEN 'bp' THEN bp_systolic_mm_hg >= 140 OR bp_diastolic_mm_hg >= 90 END,
      FALSE) AS high,
    CAST(floor(epoch(TIMESTAMP '{AS_OF}' - reading_time) / 86400) AS BIGINT) AS days,
    CAST(floor(epoch(TIMESTAMP '{AS_OF}' - reading_time)) - 86400 * floor(epoch(TIMESTAMP '{AS_OF}' - reading_time) / 86400) AS BIGINT) AS secs
  FROM (SELECT *, row_number() OVER (PARTITION BY patient_id, device_type ORDER BY reading_time DESC, reading_id DESC) AS newest
    FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY reading_time DESC, reading_id DESC) AS rank
      FROM silver_device_readings) ranked WHERE rank <= 10) recent
  WHERE newest = 1) shown
WHERE value IS NOT NULL""")
def _vitals(t: Inputs):
    return sc.latest_vitals(t.served("readings"), AS_OF)


@query("latest_risk", """
SELECT p.patient_id, p.risk_tier, p.condition, p.region, coalesce(s.avg_risk_score, 0.68) AS overall, s.date AS score_date,
  CASE WHEN s.date IS NULL OR p.risk_tier = 'high' THEN 'Medium-High' WHEN p.risk_tier = 'medium' THEN 'Medium' ELSE 'Low' END AS hospitalization,
  CASE WHEN s.date IS NULL OR p.risk_tier = 'high' THEN 'Medium' WHEN p.risk_tier = 'medium' THEN 'Low-Medium' ELSE 'Low' END AS deterioration
FROM silver_patient_master p
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY region, risk_tier, condition ORDER BY date DESC) AS rank
  FROM gold_patient_risk_daily) s
  ON s.rank = 1 AND s.region = p.region AND s.risk_tier = p.risk_tier AND s.condition = p.condition""", "overall")
def _risk(t: Inputs):
    return sc.latest_risk(t.served("patients"), t.served("patient_risk"))


@query("recent_notes", """
SELECT patient_id, note_id, strftime(note_time, '%m/%d/%Y') AS date, 'Phone Follow-up' AS type,
  CASE WHEN diet_non_adherence_flag AND med_adherence_flag THEN 'Diet non-adherence noted. Medication adherence issues.'
    WHEN diet_non_adherence_flag THEN 'Diet non-adherence noted.' ELSE 'Medication adherence issues.' END AS summary
FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY note_time DESC, note_id DESC) AS rank
  FROM silver_encounter_notes) ranked
WHERE rank <= 5 AND (diet_non_adherence_flag OR med_adherence_flag)""")
def _recent(t: Inputs):
    return sc.recent_notes(t.served("notes"))
