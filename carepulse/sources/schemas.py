"""Schemas of the raw feeds, so that no read infers one.

Emergency-room times arrive as ISO text (``'NaT'`` when missing). The cleaning
also takes timestamps: read such files with the type changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .files import scan_parquet

ER_RAW = {
    "raw_emr_er_visits": (
        "visit_id string, patient_id string, site string, unit string, arrival_time string, arrival_hour int, "
        "acuity_level int, diagnosis_group string, discharge_time string, discharge_disposition string, "
        "provider_start_time string, readmission_30d_flag boolean, cost_per_visit_usd double"
    ),
    "raw_hr_shifts_and_sickleave": (
        "shift_id string, staff_id string, role string, site string, unit string, scheduled_start string, "
        "scheduled_end string, actual_attended boolean, sick_leave_status string, overtime_hours double, "
        "shift_coverage_hours double, change_log_note string"
    ),
    "raw_patient_flow_metrics": (
        "flow_id string, site string, unit string, event_time string, hour_of_day int, door_to_triage_minutes double, "
        "door_to_provider_minutes double, triage_level int, queue_length int, telemetry_status string"
    ),
    "raw_patient_satisfaction_surveys": (
        "survey_id string, visit_id string, site string, unit string, survey_date date, overall_score double, "
        "staff_courtesy double, communication_clarity double, cleanliness double, comments string"
    ),
    "raw_readmission_risk_feed": (
        "visit_id string, patient_id string, prediction_date date, readmission_probability double, risk_band string"
    ),
}

CC_RAW = {
    "raw_patient_master": (
        "patient_id string, region string, condition string, risk_tier string, program string, "
        "enrollment_date timestamp_ntz, active_flag boolean"
    ),
    "raw_device_readings": (
        "reading_id string, patient_id string, region string, device_type string, vendor string, "
        "firmware_version string, reading_time timestamp_ntz, glucose_mg_dl double, bp_systolic_mm_hg double, "
        "bp_diastolic_mm_hg double, weight_kg double, valid_flag boolean, error_code string"
    ),
    "raw_encounter_notes": (
        "note_id string, patient_id string, region string, note_time timestamp_ntz, note_text string, "
        "diet_non_adherence_flag boolean, med_adherence_flag boolean"
    ),
    "raw_medication_lists": (
        "list_id string, patient_id string, region string, snapshot_time timestamp_ntz, med_class string, "
        "change_type string"
    ),
    "raw_device_change_log": (
        "change_id string, change_date timestamp_ntz, vendor string, device_type string, version string, "
        "regions_scope string, change_type string, error_codes string, notes string"
    ),
    "raw_care_actions": (
        "action_id string, patient_id string, region string, action_time timestamp_ntz, action_type string, "
        "condition string, executed_flag boolean, estimated_cost_usd double"
    ),
}

ORDERS_LANDING = {
    "customer": "CustomerID int, FirstName string, LastName string",
    "product": (
        "ProductID int, Name string, ProductNumber string, Color string, StandardCost decimal(19,4), "
        "ListPrice decimal(19,4), Size string, Weight decimal(8,2), ProductCategoryID int, ProductModelID int, "
        "SellStartDate timestamp, SellEndDate timestamp, DiscontinuedDate timestamp"
    ),
    "salesorderdetail": (
        "SalesOrderID int, SalesOrderDetailID int, OrderQty int, ProductID int, UnitPrice decimal(19,4), "
        "UnitPriceDiscount decimal(19,4), LineTotal decimal(38,6), ModifiedDate timestamp"
    ),
}


def read_raw(spark: SparkSession, folder: str, schemas: dict[str, str]) -> dict[str, DataFrame]:
    """One DataFrame per feed; each feed is a directory of Parquet parts named like it."""
    return {name: scan_parquet(spark, f"{folder}/{name}", schema) for name, schema in schemas.items()}
