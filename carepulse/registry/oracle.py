"""Independent SQL for the check: the tables as DuckDB common table expressions."""

from __future__ import annotations

import re

from .bindings import BINDINGS
from .inputs import FIRST_DAY, LAST_DAY


# Fixed values, written out here: what the plans hold is what is checked, so nothing is taken from there.
ER_DISPOSITIONS = ['Discharged', 'Admitted', 'Transferred', 'LWBS']
ER_RISK_BANDS = ['Low', 'Medium', 'High']
ER_ROLES = ['Nurse', 'Physician', 'Tech', 'Registration']
ER_SITE_REGIONS = {'Urban': ['Lakeview Central', 'Lakeview East'], 'Suburban': ['North Ridge', 'South Point'], 'Rural': ['Pine Valley', 'Riverbend']}
CC_ACTIONS = ['nurse_outreach', 'medication_review', 'nutrition_check_in', 'device_troubleshoot']
CC_CONDITIONS = ['diabetes', 'hypertension']
CC_DEVICE_TYPES = ['glucose', 'bp', 'weight']
CC_LOG_CHANGES = ['rollout', 'config_push', 'hotfix']
CC_MED_CHANGES = ['new', 'stop', 'dose_change', 'no_change']
CC_MED_CLASSES = ['Metformin', 'Insulin', 'GLP-1', 'ACE_inhibitor', 'ARB', 'Beta_blocker', 'Diuretic']
CC_REGIONS = ['East', 'Central', 'West']
CC_RISK_TIERS = ['low', 'medium', 'high']
CC_VENDORS = ['DEVCO-GM', 'DEVCO-BP', 'DEVCO-SC']
RISK = {'high': 0.5, 'medium': 0.25, 'low': 0.1, 'no_glucose': 0.2, 'no_bp': 0.15, 'missing_factor': 0.3, 'missing_cap': 0.3, 'diet': 0.1, 'medication': 0.1, 'incident_factor': 1.6, 'cap': 1.0, 'incident_start': '2024-01-10', 'incident_end': '2024-01-20'}


def members(c: str, allowed: list[str], other: str, fold: bool = True, trim: bool = True) -> str:
    """CASE that maps a raw value to a member of a list."""
    value = f"trim({c})" if trim else c
    if fold:
        value = f"lower({value})"
    arms = " ".join(f"WHEN '{a.lower() if fold else a}' THEN '{a}'" for a in allowed)
    return f"CASE {value} {arms} ELSE {other} END"


SITES = [s for group in ER_SITE_REGIONS.values() for s in group]


def site(c: str = "site") -> str:
    return members(c, SITES, "'Unknown Site'", fold=False)


def region(c: str = "site") -> str:
    arms = " ".join(
        f"WHEN {c} IN ({', '.join(repr(s) for s in group)}) THEN '{label}'" for label, group in ER_SITE_REGIONS.items()
    )
    return f"CASE {arms} ELSE 'Unknown Region' END"


def weekend(c: str) -> str:
    return f"coalesce(dayofweek({c}) IN (0, 6), FALSE)"


def dow(c: str) -> str:
    return f"CAST(dayofweek({c}) + 1 AS INT)"


def minutes(a: str, b: str) -> str:
    return f"round((floor(epoch({b})) - floor(epoch({a}))) / 60.0, 2)"


def half_up(x: str, digits: int) -> str:
    """Decimal rounding, so that a tie such as 0.06375 goes up whatever its binary form."""
    return f"CAST(round(CAST({x} AS DECIMAL(28, 12)), {digits}) AS DOUBLE)"


def cc_region(c: str = "region") -> str:
    return members(c, CC_REGIONS, f"coalesce({c}, 'East')")


def share(pred: str) -> str:
    return f"avg(CASE WHEN {pred} THEN 1.0 ELSE 0.0 END)"


def median(c: str) -> str:
    return f"quantile_disc({c}, 0.5)"


def moment(c: str) -> str:
    return (
        f"CAST({c} AS TIMESTAMP) AS {c}, CAST({c} AS DATE) AS date, "
        f"CAST(date_trunc('week', {c}) AS TIMESTAMP) AS week_start"
    )


TABLES: dict[str, str] = {name: sql.format_map({t: t for t in re.findall(r"{(\w+)}", sql)}) for name, sql in BINDINGS.items()}

TABLES |= {
    # ---- emergency room, silver
    "silver_er_visits": f"""
SELECT *, CAST(arrival_time_utc AS DATE) AS arrival_date,
  CAST(date_trunc('week', arrival_time_utc) AS TIMESTAMP) AS week_start,
  CAST(date_trunc('month', arrival_time_utc) AS TIMESTAMP) AS month_start,
  {dow('arrival_time_utc')} AS day_of_week_num, {weekend('arrival_time_utc')} AS is_weekend,
  provider_start_time_utc IS NULL AS provider_start_time_null_flag,
  {minutes('arrival_time_utc', 'discharge_time_utc')} AS visit_duration_minutes,
  {minutes('arrival_time_utc', 'provider_start_time_utc')} AS door_to_provider_minutes_raw,
  {region()} AS region, 'ER' AS service_line
FROM (
  SELECT trim(visit_id) AS visit_id, trim(patient_id) AS patient_id, {site()} AS site, coalesce(trim(unit), 'ER') AS unit,
    try_cast(arrival_time AS TIMESTAMP) AS arrival_time_utc, try_cast(discharge_time AS TIMESTAMP) AS discharge_time_utc,
    try_cast(provider_start_time AS TIMESTAMP) AS provider_start_time_utc, arrival_hour, acuity_level,
    coalesce(diagnosis_group, 'Other') AS diagnosis_group,
    {members('discharge_disposition', ER_DISPOSITIONS, "'Discharged'")} AS discharge_disposition,
    coalesce(readmission_30d_flag, FALSE) AS readmission_30d_flag, CAST(cost_per_visit_usd AS DOUBLE) AS cost_per_visit_usd
  FROM raw_er_visits) typed""",
    "silver_hr_shifts": f"""
SELECT *, CAST(scheduled_start_utc AS DATE) AS shift_date, {dow('scheduled_start_utc')} AS day_of_week_num,
  {weekend('scheduled_start_utc')} AS is_weekend, CAST(hour(scheduled_start_utc) AS INT) AS start_hour,
  CAST(hour(scheduled_end_utc) AS INT) AS end_hour, lower(sick_leave_status) IN ('reported', 'confirmed') AS sick_leave_flag,
  CASE WHEN attended_flag THEN shift_coverage_hours ELSE 0 END AS effective_shift_hours, {region()} AS region, 'ER' AS service_line
FROM (
  SELECT trim(shift_id) AS shift_id, trim(staff_id) AS staff_id, {members('role', ER_ROLES, "'Other'", fold=False)} AS role,
    {site()} AS site, coalesce(trim(unit), 'ER') AS unit, CAST(scheduled_start AS TIMESTAMP) AS scheduled_start_utc,
    CAST(scheduled_end AS TIMESTAMP) AS scheduled_end_utc, coalesce(actual_attended, TRUE) AS attended_flag,
    coalesce(sick_leave_status, 'None') AS sick_leave_status, CAST(overtime_hours AS DOUBLE) AS overtime_hours,
    CAST(shift_coverage_hours AS DOUBLE) AS shift_coverage_hours, coalesce(change_log_note, '') AS change_log_note
  FROM raw_hr_shifts) typed""",
    "flow_rows": f"""
SELECT trim(flow_id) AS flow_id, {site()} AS site, coalesce(trim(unit), 'ER') AS unit, event_time AS event_time_utc,
  CAST(event_time AS DATE) AS date, hour_of_day, CAST(door_to_triage_minutes AS DOUBLE) AS triage_wait_minutes,
  CAST(door_to_provider_minutes AS DOUBLE) AS door_to_provider_minutes, triage_level, queue_length,
  coalesce(telemetry_status, 'OK') AS telemetry_status
FROM raw_patient_flow""",
    "silver_patient_flow": f"""
SELECT *, {median('queue_length')} OVER (PARTITION BY site, date, hour_of_day) AS queue_length_median_15min,
  telemetry_status = 'DELAYED' AS telemetry_delayed, {dow('event_time_utc')} AS day_of_week_num,
  {weekend('event_time_utc')} AS is_weekend, {region()} AS region, 'ER' AS service_line
FROM flow_rows""",
    "silver_surveys": f"""
SELECT trim(s.survey_id) AS survey_id, trim(s.visit_id) AS visit_id, {site('s.site')} AS site,
  coalesce(trim(s.unit), 'ER') AS unit, CAST(s.survey_date AS DATE) AS survey_date,
  CAST(s.overall_score AS DOUBLE) AS overall_score, CAST(s.staff_courtesy AS DOUBLE) AS staff_courtesy,
  CAST(s.communication_clarity AS DOUBLE) AS communication_clarity, CAST(s.cleanliness AS DOUBLE) AS cleanliness,
  s.comments, v.arrival_date, v.is_weekend, v.region, 'ER' AS service_line
FROM raw_surveys s LEFT JOIN silver_er_visits v ON trim(s.visit_id) = v.visit_id""",
    "silver_readmission_risk": f"""
SELECT r.*, v.site, v.unit, v.arrival_date, v.is_weekend, v.region, 'ER' AS service_line,
  CAST(date_diff('day', v.arrival_date, r.prediction_date) AS INT) AS lag_days
FROM (
  SELECT trim(visit_id) AS visit_id, trim(patient_id) AS patient_id, CAST(prediction_date AS DATE) AS prediction_date,
    CAST(readmission_probability AS DOUBLE) AS readmission_probability,
    {members('risk_band', ER_RISK_BANDS, "'Medium'")} AS risk_band
  FROM raw_readmission_risk) r LEFT JOIN silver_er_visits v USING (visit_id, patient_id)""",
    # ---- emergency room, gold
    "er_grid": """
SELECT site, CAST(day AS DATE) AS date, CAST(hour_of_day AS INT) AS hour_of_day
FROM (SELECT DISTINCT site FROM silver_er_visits) sites,
  (SELECT unnest(generate_series(min(arrival_date), max(arrival_date), INTERVAL 1 DAY)) AS day FROM silver_er_visits) days,
  (SELECT unnest(generate_series(0, 23)) AS hour_of_day) hours""",
    "gold_er_operational_hourly": f"""
SELECT g.site, {region('g.site')} AS region, 'ER' AS unit, g.date, g.hour_of_day, {weekend('g.date')} AS is_weekend,
  coalesce(a.n, 0) AS arrivals, coalesce(t.n, 0) AS throughput, CAST(coalesce(m.queue, 0) AS DOUBLE) AS queue_length_median,
  m.triage AS door_to_triage_median, m.provider AS door_to_provider_median, coalesce(s.hours, 0) AS effective_staffing_hours,
  {half_up('coalesce(s.hours, 0) * 60 / (a.n * 240.0)', 3)} AS nurse_to_patient_ratio,
  {half_up('coalesce(t.n, 0) / CAST(a.n AS DOUBLE)', 3)} AS occupancy_pct
FROM er_grid g
LEFT JOIN (SELECT site, arrival_date AS date, arrival_hour AS hour_of_day, count(*) AS n FROM silver_er_visits GROUP BY ALL) a
  USING (site, date, hour_of_day)
LEFT JOIN (SELECT site, CAST(discharge_time_utc AS DATE) AS date, hour(discharge_time_utc) AS hour_of_day, count(*) AS n
  FROM silver_er_visits WHERE discharge_time_utc IS NOT NULL GROUP BY ALL) t USING (site, date, hour_of_day)
LEFT JOIN (SELECT site, date, hour_of_day, {median('triage_wait_minutes')} AS triage,
  {median('door_to_provider_minutes')} AS provider, {median('queue_length_median_15min')} AS queue
  FROM silver_patient_flow GROUP BY ALL) m USING (site, date, hour_of_day)
LEFT JOIN (SELECT site, shift_date AS date, start_hour AS hour_of_day, sum(effective_shift_hours) AS hours
  FROM silver_hr_shifts GROUP BY ALL) s USING (site, date, hour_of_day)""",
    "gold_er_quality_daily": f"""
SELECT v.site, {region('v.site')} AS region, v.unit, v.date, v.is_weekend, v.visits_total, v.throughput_daily,
  {half_up('v.lwbs / CAST(v.visits_total AS DOUBLE)', 4)} AS lwbs_rate, m.triage AS median_triage_wait_minutes,
  m.provider AS median_door_to_provider_minutes, s.score AS satisfaction_overall_avg, {dow('v.date')} AS day_of_week_num
FROM (SELECT site, unit, arrival_date AS date, is_weekend, count(*) AS visits_total,
    count(*) FILTER (WHERE discharge_disposition = 'LWBS') AS lwbs, count(discharge_time_utc) AS throughput_daily
  FROM silver_er_visits GROUP BY ALL) v
LEFT JOIN (SELECT site, unit, date, {median('triage_wait_minutes')} AS triage, {median('door_to_provider_minutes')} AS provider
  FROM silver_patient_flow GROUP BY ALL) m USING (site, unit, date)
LEFT JOIN (SELECT site, unit, arrival_date AS date, avg(overall_score) AS score FROM silver_surveys GROUP BY ALL) s
  USING (site, unit, date)""",
    "gold_er_finance_daily": f"""
SELECT *, sum(reimbursement_at_risk_usd) OVER (PARTITION BY site ORDER BY date, unit ROWS UNBOUNDED PRECEDING)
  AS cumulative_reimbursement_at_risk_usd
FROM (
  SELECT o.site, {region('o.site')} AS region, o.unit, o.date, o.is_weekend, o.overtime_hours_sum, c.cost_per_visit_avg,
    {half_up('coalesce(q.lwbs_rate, 0) * 100 * 250 + CASE WHEN q.median_door_to_provider_minutes > 35 THEN 750 ELSE 0 END', 2)}
      AS reimbursement_at_risk_usd
  FROM (SELECT site, unit, shift_date AS date, is_weekend, sum(overtime_hours) AS overtime_hours_sum
    FROM silver_hr_shifts GROUP BY ALL) o
  LEFT JOIN (SELECT site, unit, arrival_date AS date, avg(cost_per_visit_usd) AS cost_per_visit_avg
    FROM silver_er_visits GROUP BY ALL) c USING (site, unit, date)
  LEFT JOIN (SELECT site, unit, date, lwbs_rate, median_door_to_provider_minutes FROM gold_er_quality_daily) q
    USING (site, unit, date)) daily""",
    "gold_er_staffing_daily": f"""
SELECT h.site, {region('h.site')} AS region, h.unit, h.date, h.is_weekend, h.role, h.scheduled_hours, h.effective_hours,
  h.sick_leave_rate, o.ratio AS avg_nurse_to_patient_ratio,
  h.role = 'Nurse' AND coalesce(o.ratio, 0) > 0.25 AS coverage_gap_flag
FROM (SELECT site, unit, shift_date AS date, is_weekend, role, sum(shift_coverage_hours) AS scheduled_hours,
    sum(effective_shift_hours) AS effective_hours, {share('sick_leave_flag')} AS sick_leave_rate
  FROM silver_hr_shifts GROUP BY ALL) h
LEFT JOIN (SELECT site, date, avg(nurse_to_patient_ratio) AS ratio FROM gold_er_operational_hourly GROUP BY ALL) o
  USING (site, date)""",
    "gold_er_readmission_daily": f"""
SELECT r.site, {region('r.site')} AS region, r.unit, r.date, r.is_weekend, r.avg_readmission_probability, r.high_risk_share,
  z.n AS realized_readmissions_30d
FROM (SELECT site, unit, arrival_date AS date, is_weekend, avg(readmission_probability) AS avg_readmission_probability,
    {share("risk_band = 'High'")} AS high_risk_share FROM silver_readmission_risk GROUP BY ALL) r
LEFT JOIN (SELECT site, unit, arrival_date AS date, count(*) FILTER (WHERE readmission_30d_flag) AS n
  FROM silver_er_visits GROUP BY ALL) z ON r.site = z.site AND r.unit = z.unit AND r.date = z.date""",
    "gold_er_filters_bridge": f"""
SELECT arrival_date AS date, site, region, unit, is_weekend, CAST(NULL AS VARCHAR) AS role,
  {dow('arrival_date')} AS day_of_week_num, service_line FROM silver_er_visits
UNION
SELECT shift_date, site, region, unit, is_weekend, role, {dow('shift_date')}, service_line FROM silver_hr_shifts""",
    # ---- chronic care, silver
    "silver_patient_master": f"""
SELECT CAST(patient_id AS VARCHAR) AS patient_id, {cc_region()} AS region,
  {members('condition', CC_CONDITIONS, "'diabetes'")} AS condition, {members('risk_tier', CC_RISK_TIERS, "'medium'")} AS risk_tier,
  CASE WHEN program IN ('CCM', 'CCM+Nutrition') THEN program WHEN upper(program) LIKE '%NUTR%' THEN 'CCM+Nutrition' ELSE 'CCM' END
    AS program,
  CAST(enrollment_date AS DATE) AS enrollment_date, CAST(active_flag AS BOOLEAN) AS active_flag
FROM raw_patient_master""",
    "silver_device_readings": f"""
SELECT CAST(reading_id AS VARCHAR) AS reading_id, patient_id, {cc_region()} AS region,
  {members('device_type', CC_DEVICE_TYPES, "'glucose'")} AS device_type, {members('vendor', CC_VENDORS, "'DEVCO-GM'")} AS vendor,
  firmware_version, {moment('reading_time')}, CAST(glucose_mg_dl AS DOUBLE) AS glucose_mg_dl,
  CAST(bp_systolic_mm_hg AS DOUBLE) AS bp_systolic_mm_hg, CAST(bp_diastolic_mm_hg AS DOUBLE) AS bp_diastolic_mm_hg,
  CAST(weight_kg AS DOUBLE) AS weight_kg, valid_flag, coalesce(error_code, 'NONE') AS error_code,
  coalesce(lower(trim(device_type)) = 'bp' AND bp_diastolic_mm_hg IS NULL, FALSE) AS bp_missing_diastolic
FROM raw_device_readings""",
    "silver_encounter_notes": f"""
SELECT CAST(note_id AS VARCHAR) AS note_id, patient_id, {cc_region()} AS region, {moment('note_time')},
  diet_non_adherence_flag, med_adherence_flag
FROM raw_encounter_notes""",
    "silver_medication_lists": f"""
SELECT CAST(list_id AS VARCHAR) AS list_id, patient_id, {cc_region()} AS region, {moment('snapshot_time')},
  {members('med_class', CC_MED_CLASSES, "'Other'", fold=False, trim=False)} AS med_class,
  {members('change_type', CC_MED_CHANGES, "'no_change'", fold=False, trim=False)} AS change_type
FROM raw_medication_lists""",
    "silver_device_change_log": f"""
SELECT CAST(change_id AS VARCHAR) AS change_id, CAST(change_date AS TIMESTAMP) AS change_date, CAST(change_date AS DATE) AS date,
  {members('vendor', CC_VENDORS, "coalesce(vendor, 'DEVCO-GM')")} AS vendor,
  {members('device_type', CC_DEVICE_TYPES, "'glucose'")} AS device_type, version, trim(regions_scope) AS regions_scope,
  {members('change_type', CC_LOG_CHANGES, 'lower(trim(change_type))')} AS change_type,
  coalesce(error_codes, 'NONE') AS error_codes, notes
FROM raw_device_change_log""",
    "silver_care_actions": f"""
SELECT a.action_id, a.patient_id, {cc_region('a.region')} AS region,
  {members('a.condition', CC_CONDITIONS, 'p.condition')} AS condition, CAST(a.action_time AS TIMESTAMP) AS action_time,
  CAST(a.action_time AS DATE) AS date, CAST(date_trunc('week', a.action_time) AS TIMESTAMP) AS week_start,
  {members('a.action_type', CC_ACTIONS, "'nurse_outreach'")} AS action_type, a.executed_flag,
  CAST(a.estimated_cost_usd AS DOUBLE) AS estimated_cost_usd
FROM raw_care_actions a LEFT JOIN silver_patient_master p USING (patient_id)""",
    # ---- chronic care, gold
    "gold_date_spine": f"""
SELECT date, {dow('date')} AS dow, {weekend('date')} AS is_weekend, CAST(date_trunc('week', date) AS TIMESTAMP) AS week_start,
  CAST(date_trunc('month', date) AS TIMESTAMP) AS month
FROM (SELECT CAST(unnest(generate_series(DATE '{FIRST_DAY}', DATE '{LAST_DAY}', INTERVAL 1 DAY)) AS DATE) AS date) days""",
    "gold_device_ingestion": """
SELECT date, region, device_type, coalesce(n, 0) AS readings_total, coalesce(ok, 0) AS readings_valid,
  ok / CAST(n AS DOUBLE) AS valid_rate
FROM (SELECT date FROM gold_date_spine) days CROSS JOIN (SELECT DISTINCT region FROM silver_patient_master) regions
CROSS JOIN (VALUES ('glucose'), ('bp'), ('weight')) devices(device_type)
LEFT JOIN (SELECT date, region, device_type, count(*) AS n, count(*) FILTER (WHERE valid_flag) AS ok
  FROM silver_device_readings GROUP BY ALL) counts USING (date, region, device_type)""",
    "gold_bp_quality": """
SELECT date, region, bp_readings, diastolic_missing,
  CASE WHEN bp_readings > 0 THEN diastolic_missing / CAST(bp_readings AS DOUBLE) END AS missing_rate_diastolic
FROM (SELECT date, region, count(*) FILTER (WHERE device_type = 'bp') AS bp_readings,
    count(*) FILTER (WHERE device_type = 'bp' AND bp_missing_diastolic) AS diastolic_missing
  FROM silver_device_readings GROUP BY ALL) daily""",
    "gold_encounter_signals": f"""
SELECT date, region, {share('diet_non_adherence_flag')} AS pct_notes_with_diet_non_adherence,
  {share('med_adherence_flag')} AS pct_notes_with_med_adherence_issues, count(*) AS notes_count
FROM silver_encounter_notes GROUP BY ALL""",
    "gold_patient_risk_daily": f"""
SELECT date, region, risk_tier, condition, avg(least(points * factor, {RISK['cap']}::DOUBLE)) AS avg_risk_score, count(*) AS patient_days
FROM (
  SELECT d.date, p.region, p.risk_tier, p.condition,
    CASE p.risk_tier WHEN 'high' THEN {RISK['high']}::DOUBLE WHEN 'medium' THEN {RISK['medium']} ELSE {RISK['low']} END
    + CASE WHEN p.condition = 'diabetes' AND NOT coalesce(r.glucose, FALSE) THEN {RISK['no_glucose']}::DOUBLE ELSE 0 END
    + CASE WHEN p.condition = 'hypertension' AND NOT coalesce(r.bp, FALSE) THEN {RISK['no_bp']}::DOUBLE ELSE 0 END
    + least(coalesce(r.missing, 0) * {RISK['missing_factor']}::DOUBLE, {RISK['missing_cap']}::DOUBLE)
    + CASE WHEN coalesce(n.diet, FALSE) THEN {RISK['diet']}::DOUBLE ELSE 0 END
    + CASE WHEN coalesce(n.med, FALSE) THEN {RISK['medication']}::DOUBLE ELSE 0 END AS points,
    CASE WHEN d.date BETWEEN DATE '{RISK['incident_start']}' AND DATE '{RISK['incident_end']}' AND p.risk_tier = 'high'
      AND p.condition = 'diabetes' THEN {RISK['incident_factor']}::DOUBLE ELSE 1 END AS factor
  FROM gold_date_spine d CROSS JOIN (SELECT * FROM silver_patient_master WHERE active_flag) p
  LEFT JOIN (SELECT patient_id, date, bool_or(device_type = 'glucose' AND valid_flag) AS glucose,
      bool_or(device_type = 'bp' AND valid_flag) AS bp, {share("device_type = 'bp' AND bp_missing_diastolic")} AS missing
    FROM silver_device_readings GROUP BY ALL) r ON r.patient_id = p.patient_id AND r.date = d.date
  LEFT JOIN (SELECT patient_id, date, bool_or(diet_non_adherence_flag) AS diet, bool_or(med_adherence_flag) AS med
    FROM silver_encounter_notes GROUP BY ALL) n ON n.patient_id = p.patient_id AND n.date = d.date) patient_days
GROUP BY ALL""",
    "gold_patient_risk_weekly": """
SELECT CAST(date_trunc('week', date) AS TIMESTAMP) AS week_start, region, risk_tier, condition,
  avg(avg_risk_score) AS avg_risk_score, CAST(sum(patient_days) AS BIGINT) AS patient_days
FROM gold_patient_risk_daily GROUP BY ALL""",
    "gold_care_actions_weekly": f"""
SELECT week_start, region, condition, action_type, count(*) AS actions_total,
  count(*) FILTER (WHERE executed_flag) AS actions_executed, {share('executed_flag')} AS execute_rate,
  avg(estimated_cost_usd) AS avg_cost_usd
FROM silver_care_actions GROUP BY ALL""",
    "gold_cumulative_care_cost": """
SELECT *, sum(executed_cost_usd) OVER (PARTITION BY region, condition ORDER BY date ROWS UNBOUNDED PRECEDING)
  AS running_total_cost_usd
FROM (SELECT date, region, condition, coalesce(sum(estimated_cost_usd) FILTER (WHERE executed_flag), 0) AS executed_cost_usd
  FROM silver_care_actions GROUP BY ALL) daily""",
    "gold_root_cause_alignment": """
SELECT a.*, c.vendor, c.version, c.change_type, c.error_codes, c.notes, e.error_events
FROM (SELECT *, lag(valid_rate, 7) OVER days AS valid_rate_lag7, valid_rate - lag(valid_rate, 7) OVER days AS delta_vs_7d
  FROM gold_device_ingestion WINDOW days AS (PARTITION BY region, device_type ORDER BY date)) a
LEFT JOIN (SELECT date, device_type, vendor, version, change_type, error_codes, notes,
    trim(unnest(string_split(regions_scope, ','))) AS region FROM silver_device_change_log) c USING (date, region, device_type)
LEFT JOIN (SELECT date, region, vendor, device_type, count(*) FILTER (WHERE error_code <> 'NONE') AS error_events
  FROM silver_device_readings GROUP BY ALL) e
  ON a.date = e.date AND a.region = e.region AND a.device_type = e.device_type
WHERE a.device_type <> 'weight'""",
    "gold_cc_filters_bridge": """
SELECT CAST(date AS TIMESTAMP) AS date, region, 'region' AS field_name, region AS field_value FROM gold_device_ingestion
UNION ALL SELECT date, NULL, 'device_type', device_type FROM gold_device_ingestion
UNION ALL SELECT date, region, 'risk_tier', risk_tier FROM gold_patient_risk_daily
UNION ALL SELECT date, region, 'condition', condition FROM gold_patient_risk_daily
UNION ALL SELECT week_start, NULL, 'action_type', action_type FROM gold_care_actions_weekly""",
    # ---- streaming
    "sales_orders_flat": """
SELECT o.SalesOrderID, o.SalesOrderDetailID, o.OrderQty, o.UnitPrice, o.UnitPriceDiscount, o.LineTotal,
  o.ModifiedDate AS OrderModifiedDate, p.ProductID, p.Name AS ProductName, p.ProductNumber, p.Color AS ProductColor,
  p.StandardCost, p.ListPrice, p.Size AS ProductSize, p.Weight AS ProductWeight, p.ProductCategoryID, p.ProductModelID,
  p.SellStartDate, p.SellEndDate, p.DiscontinuedDate, o.OrderQty * o.UnitPrice AS ExtendedPrice,
  o.OrderQty * o.UnitPrice - o.LineTotal AS TotalDiscount
FROM order_lines o JOIN products p ON o.ProductID = p.ProductID""",
    "person": """
SELECT md5(source_patient_id) AS person_id, gender_concept_id,
  CAST(year(birth_datetime) AS INT) AS year_of_birth, CAST(month(birth_datetime) AS INT) AS month_of_birth,
  CAST(day(birth_datetime) AS INT) AS day_of_birth, birth_datetime, race_concept_id, ethnicity_concept_id, location_id,
  source_patient_id AS person_source_value
FROM clean_patients LEFT JOIN locations USING (zip)""",
}


def with_tables(sql: str, doubles: str = "", digits: int = 11) -> str:
    """The statement with every table it names as a CTE; ``doubles`` are rounded in the result."""
    wanted: set[str] = set()

    def visit(text: str) -> None:
        for name in TABLES:
            if name not in wanted and re.search(rf"\b{name}\b", text):
                wanted.add(name)
                visit(TABLES[name])

    visit(sql)
    ctes = ",\n".join(f"{name} AS ({TABLES[name].strip()})" for name in TABLES if name in wanted)
    if doubles:
        def shown(c: str) -> str:  # twelve significant digits, whatever the magnitude, as core.present shows them
            return f"CAST(printf('%.{digits}e', CAST({c} AS DOUBLE)) AS DOUBLE) AS {c}"

        rounded = ", ".join(shown(c) for c in doubles.split())
        sql = f"SELECT * REPLACE ({rounded}) FROM ({sql}) result"
    if not ctes:
        return sql
    return f"WITH {ctes}\n{sql}" if sql.startswith("SELECT") else f"WITH {ctes}\nSELECT * FROM ({sql}) result"
