"""The supplied tables in the shape of the raw feeds.

Each binding is one projection (or plain join) over whole tables, in SQL that
Spark and DuckDB both read, so the engine and the check start from the same
rows. Values are messy on purpose (padding, case, NULL, unknown members, 'NaT').
Most measures are multiples of 1/4, so sums come out the same in any order.
"""

from __future__ import annotations

# k, the cents of an event's value, spreads the events over the members of an enum
_EVENTS = "(SELECT *, CAST(CAST(floor(value * 100) AS BIGINT) % 100 AS INT) AS k FROM {events}) e"

_SITE = """CASE {n} % 8 WHEN 0 THEN 'Lakeview Central' WHEN 1 THEN ' Lakeview East' WHEN 2 THEN 'North Ridge '
    WHEN 3 THEN 'South Point' WHEN 4 THEN 'Pine Valley' WHEN 5 THEN ' Riverbend ' WHEN 6 THEN 'riverbend' END"""

_REGION = """CASE {n} % 6 WHEN 0 THEN 'East' WHEN 1 THEN ' central' WHEN 2 THEN 'WEST ' WHEN 3 THEN 'North'
    WHEN 4 THEN 'west' END"""

_UNIT = "CASE {n} % 9 WHEN 0 THEN NULL WHEN 1 THEN 'Fast Track' WHEN 2 THEN ' ER ' ELSE 'ER' END"

BINDINGS: dict[str, str] = {
    "raw_er_visits": f"""
SELECT ' V-' || CAST(event_id AS STRING) || ' ' AS visit_id,
  'P-' || CAST(user_id AS STRING) AS patient_id,
  {_SITE.format(n='k')} AS site,
  {_UNIT.format(n='user_id')} AS unit,
  ts AS arrival_time,
  CAST(hour(ts) AS INT) AS arrival_hour,
  1 + k % 5 AS acuity_level,
  CASE k % 7 WHEN 0 THEN 'Cardiac' WHEN 1 THEN 'GI' WHEN 2 THEN 'Neuro' WHEN 3 THEN 'Injury'
    WHEN 4 THEN 'Respiratory' WHEN 5 THEN 'Other' END AS diagnosis_group,
  CASE WHEN k % 11 = 0 THEN NULL ELSE ts + INTERVAL '1' SECOND * CAST(60 + floor(value * 30) AS INT) END AS discharge_time,
  CASE WHEN k % 11 = 0 THEN ' lwbs' WHEN event_type = 'click' THEN 'Discharged' WHEN event_type = 'view' THEN 'ADMITTED '
    WHEN event_type = 'signup' THEN 'transferred' WHEN event_type = 'error' THEN 'unclear' END AS discharge_disposition,
  CASE WHEN k % 11 = 0 THEN 'NaT' ELSE CAST(ts + INTERVAL '1' SECOND * CAST(floor(value * 12) AS INT) AS STRING) END AS provider_start_time,
  CASE WHEN k % 13 = 0 THEN TRUE WHEN k % 13 = 1 THEN NULL ELSE FALSE END AS readmission_30d_flag,
  floor(value * 4) / 4 AS cost_per_visit_usd
FROM {_EVENTS}""",
    "raw_hr_shifts": f"""
SELECT CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || ' ' AS shift_id,
  ' S-' || CAST(l_suppkey AS STRING) AS staff_id,
  CASE l_returnflag WHEN 'A' THEN ' Nurse' WHEN 'N' THEN 'Physician' ELSE
    CASE l_linestatus WHEN 'F' THEN 'Tech ' ELSE 'tech' END END AS role,
  {_SITE.format(n='l_suppkey')} AS site,
  {_UNIT.format(n='l_partkey')} AS unit,
  CAST('2024-01-01 00:00:00' AS TIMESTAMP) + INTERVAL '1' HOUR * CAST((l_orderkey % 30) * 24 + (l_linenumber * 7) % 24 AS INT) AS scheduled_start,
  CAST('2024-01-01 00:00:00' AS TIMESTAMP) + INTERVAL '1' HOUR * CAST((l_orderkey % 30) * 24 + (l_linenumber * 7) % 24 + 8 AS INT) AS scheduled_end,
  CASE l_partkey % 10 WHEN 0 THEN FALSE WHEN 1 THEN NULL ELSE TRUE END AS actual_attended,
  CASE l_orderkey % 31 WHEN 0 THEN 'Reported' WHEN 1 THEN 'confirmed' WHEN 2 THEN NULL ELSE 'None' END AS sick_leave_status,
  floor(l_tax * 100 + 0.5) / 4 AS overtime_hours,
  l_quantity AS shift_coverage_hours,
  CASE WHEN l_discount > 0.05 THEN 'swap' END AS change_log_note
FROM {{lineitem}}""",
    "raw_patient_flow": f"""
SELECT 'F-' || CAST(event_id AS STRING) || '  ' AS flow_id,
  {_SITE.format(n='k')} AS site,
  {_UNIT.format(n='user_id')} AS unit,
  ts AS event_time,
  CAST(hour(ts) AS INT) AS hour_of_day,
  floor(value) / 4 AS door_to_triage_minutes,
  CASE WHEN k % 17 = 0 THEN NULL ELSE floor(value * 4) / 4 END AS door_to_provider_minutes,
  1 + k % 5 AS triage_level,
  CAST(user_id % 17 AS INT) AS queue_length,
  CASE k WHEN 99 THEN 'DELAYED' WHEN 98 THEN NULL ELSE 'OK' END AS telemetry_status
FROM {_EVENTS}""",
    "raw_surveys": f"""
SELECT 'SV-' || CAST(event_id AS STRING) AS survey_id,
  ' V-' || CAST(event_id + 500 AS STRING) AS visit_id,
  {_SITE.format(n='k')} AS site,
  {_UNIT.format(n='user_id')} AS unit,
  CAST(ts AS DATE) + k % 4 AS survey_date,
  1 + k % 5 AS overall_score,
  1 + (k + 1) % 5 AS staff_courtesy,
  1 + (k + 2) % 5 AS communication_clarity,
  CASE WHEN k % 23 = 0 THEN NULL ELSE 1 + (k + 3) % 5 END AS cleanliness,
  event_type AS comments
FROM {_EVENTS}""",
    "raw_readmission_risk": f"""
SELECT 'V-' || CAST(event_id AS STRING) AS visit_id,
  CASE WHEN k % 19 = 0 THEN 'P-other' ELSE ' P-' || CAST(user_id AS STRING) END AS patient_id,
  CAST(ts AS DATE) + k % 3 AS prediction_date,
  floor(value) / 500 AS readmission_probability,
  CASE event_type WHEN 'click' THEN 'low' WHEN 'view' THEN ' MEDIUM' WHEN 'purchase' THEN 'High ' WHEN 'signup' THEN 'HIGH'
    ELSE 'extreme' END AS risk_band
FROM {_EVENTS}""",
    "raw_patient_master": """
SELECT 'PT-' || CAST(c_custkey AS STRING) AS patient_id,
  CASE r_name WHEN 'AFRICA' THEN 'east ' WHEN 'AMERICA' THEN 'CENTRAL' WHEN 'ASIA' THEN ' West' WHEN 'EUROPE' THEN 'North' END AS region,
  CASE c_mktsegment WHEN 'MACHINERY' THEN 'Diabetes' WHEN 'FURNITURE' THEN ' HYPERTENSION' WHEN 'BUILDING' THEN 'hypertension'
    WHEN 'AUTOMOBILE' THEN 'asthma' END AS condition,
  CASE c_nationkey % 4 WHEN 0 THEN 'HIGH' WHEN 1 THEN ' low' WHEN 2 THEN 'extreme' ELSE 'medium' END AS risk_tier,
  CASE c_nationkey % 5 WHEN 0 THEN 'CCM' WHEN 1 THEN 'CCM+Nutrition' WHEN 2 THEN 'nutrition plus' WHEN 3 THEN 'Basic' END AS program,
  CAST(CAST('2020-01-01' AS DATE) + CAST(c_custkey % 1000 AS INT) AS TIMESTAMP) AS enrollment_date,
  c_acctbal > 0 AS active_flag
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    "raw_device_readings": f"""
SELECT CAST(event_id AS STRING) AS reading_id,
  'PT-' || CAST(user_id AS STRING) AS patient_id,
  {_REGION.format(n='user_id')} AS region,
  CASE event_type WHEN 'click' THEN ' Glucose' WHEN 'view' THEN 'BP' WHEN 'purchase' THEN 'weight' WHEN 'signup' THEN 'bp '
    ELSE 'pump' END AS device_type,
  CASE event_type WHEN 'click' THEN 'devco-gm' WHEN 'view' THEN 'DEVCO-BP' WHEN 'purchase' THEN ' DEVCO-SC'
    WHEN 'signup' THEN 'DEVCO-SC' ELSE 'ACME' END AS vendor,
  'v' || CAST(k % 4 AS STRING) AS firmware_version,
  ts AS reading_time,
  CASE WHEN event_type IN ('click', 'error') AND k % 21 <> 0 THEN 60 + floor(value * 4) / 4 END AS glucose_mg_dl,
  CASE WHEN event_type IN ('view', 'signup') THEN 100 + floor(value) END AS bp_systolic_mm_hg,
  CASE WHEN event_type IN ('view', 'signup') AND k % 6 <> 0 THEN 55 + floor(value / 2) END AS bp_diastolic_mm_hg,
  CASE WHEN event_type = 'purchase' THEN 50 + floor(value * 4) / 4 END AS weight_kg,
  k % 8 <> 0 AS valid_flag,
  CASE k % 8 WHEN 0 THEN 'BT-GM-3921' WHEN 1 THEN 'NONE' WHEN 2 THEN 'BT-BP-2710' END AS error_code
FROM {_EVENTS}""",
    "raw_encounter_notes": f"""
SELECT event_id AS note_id,
  'PT-' || CAST(user_id AS STRING) AS patient_id,
  {_REGION.format(n='user_id')} AS region,
  ts AS note_time,
  props AS note_text,
  CASE WHEN k % 5 = 0 THEN TRUE WHEN k % 5 = 1 THEN NULL ELSE FALSE END AS diet_non_adherence_flag,
  event_type IN ('error', 'signup') AS med_adherence_flag
FROM {_EVENTS}""",
    "raw_medication_lists": f"""
SELECT o_orderkey AS list_id,
  'PT-' || CAST(o_custkey AS STRING) AS patient_id,
  {_REGION.format(n='o_custkey')} AS region,
  o_orderdate AS snapshot_time,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Insulin' WHEN '2-HIGH' THEN 'Metformin' WHEN '3-MEDIUM' THEN 'ARB'
    WHEN '5-LOW' THEN 'metformin' END AS med_class,
  CASE o_orderstatus WHEN 'F' THEN 'new' WHEN 'P' THEN 'dose_change' ELSE 'paused' END AS change_type
FROM {{orders}}""",
    "raw_device_change_log": """
SELECT p_partkey AS change_id,
  CAST('2024-01-01 09:00:00' AS TIMESTAMP) + INTERVAL '1' HOUR * CAST((p_partkey % 30) * 24 AS INT) AS change_date,
  CASE p_size % 4 WHEN 0 THEN 'devco-gm' WHEN 1 THEN 'DEVCO-BP ' WHEN 2 THEN 'Other Co' END AS vendor,
  CASE p_type WHEN 'SMALL' THEN 'bp' WHEN 'MEDIUM' THEN ' Glucose' WHEN 'LARGE' THEN 'WEIGHT' ELSE 'pump' END AS device_type,
  'v' || CAST(p_size AS STRING) AS version,
  CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'Central, West' WHEN 2 THEN 'East' WHEN 3 THEN '' WHEN 4 THEN ' North ,East,  West '
    ELSE replace(p_name, ' ', ', ') END AS regions_scope,
  CASE p_size % 5 WHEN 0 THEN 'Rollout' WHEN 1 THEN ' config_push' WHEN 2 THEN 'HOTFIX' ELSE ' Recall ' END AS change_type,
  CASE WHEN p_size > 25 THEN 'BT-GM-3921' END AS error_codes,
  p_brand AS notes
FROM {part}""",
    "raw_care_actions": f"""
SELECT CAST(o_orderkey AS STRING) AS action_id,
  'PT-' || CAST(o_custkey AS STRING) AS patient_id,
  {_REGION.format(n='o_custkey')} AS region,
  CAST('2024-01-01 10:30:00' AS TIMESTAMP) + INTERVAL '1' HOUR * CAST((o_orderkey % 30) * 24 AS INT) AS action_time,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Nurse_Outreach' WHEN '2-HIGH' THEN 'medication_review '
    WHEN '3-MEDIUM' THEN 'nutrition_check_in' WHEN '4-NOT SPECIFIED' THEN 'device_troubleshoot' ELSE 'call' END AS action_type,
  CASE o_orderpriority WHEN '1-URGENT' THEN ' Diabetes' WHEN '2-HIGH' THEN 'hypertension' WHEN '3-MEDIUM' THEN 'unknown' END AS condition,
  o_orderstatus = 'F' AS executed_flag,
  floor(o_totalprice / 4) AS estimated_cost_usd
FROM {{orders}}""",
    "order_lines": """
SELECT l_orderkey AS SalesOrderID, l_linenumber AS SalesOrderDetailID, l_quantity AS OrderQty, l_partkey AS ProductID,
  floor(l_extendedprice * 4) / 4 AS UnitPrice, l_discount AS UnitPriceDiscount,
  floor(l_quantity * l_extendedprice * (1 - l_discount)) / 1 AS LineTotal,
  l_shipdate AS ModifiedDate
FROM {lineitem}""",
    "products": """
SELECT p_partkey AS ProductID, p_name AS Name, p_brand AS ProductNumber, p_type AS Color, p_retailprice / 2 AS StandardCost,
  p_retailprice AS ListPrice, CAST(p_size AS STRING) AS Size, p_size / 4 AS Weight, p_size % 7 AS ProductCategoryID,
  p_size % 11 AS ProductModelID, CAST('2020-01-01 00:00:00' AS TIMESTAMP) AS SellStartDate, CAST(NULL AS TIMESTAMP) AS SellEndDate,
  CAST(NULL AS TIMESTAMP) AS DiscontinuedDate
FROM {part}""",
    "concept": """
SELECT CAST(p_partkey AS BIGINT) AS concept_id, 'C' || CAST(p_partkey AS STRING) AS concept_code, p_name AS concept_name,
  CASE p_size % 3 WHEN 0 THEN 'ICD10CM' WHEN 1 THEN 'SNOMED' ELSE 'RxNorm' END AS vocabulary_id,
  CASE WHEN p_size % 3 = 0 THEN NULL ELSE 'S' END AS standard_concept
FROM {part}""",
    "concept_relationship": """
SELECT l_partkey AS concept_id_1, l_suppkey AS concept_id_2,
  CASE l_returnflag WHEN 'A' THEN 'Maps to' ELSE 'Is a' END AS relationship_id
FROM {lineitem}""",
    "clean_patients": """
SELECT 'PT-' || CAST(c_custkey AS STRING) AS source_patient_id,
  CAST(CAST('1930-01-01' AS DATE) + CAST(c_custkey * 17 % 30000 AS INT) AS TIMESTAMP) AS birth_datetime,
  CASE c_custkey % 3 WHEN 0 THEN 8507 WHEN 1 THEN 8532 END AS gender_concept_id,
  0 AS race_concept_id, 0 AS ethnicity_concept_id, c_nationkey AS zip
FROM {customer}""",
    "locations": "SELECT n_nationkey AS zip, 1000 + n_nationkey AS location_id FROM {nation}",
}
