"""Chronic-care device-incident tables. Inputs and outputs are DataFrames; nothing is run here."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import classify, enum_ci, enum_ci_keep_unknown, enum_ci_self, enum_exact, flag, null_default
from ..functions.measures import count_if, rate, ratio, sum_if
from ..functions.temporal import in_trailing_days, week_start
from ..operators.aggregates import roll_up
from ..operators.joining import densify, exists_in, left_enrich
from ..operators.sets import filter_bridge
from ..operators.spine import date_spine, days_of, explode_csv, scaffold
from ..operators.windows import delta_vs_lag, running_sum

# The enum members of the raw feeds.
REGIONS = ["East", "Central", "West"]
CONDITIONS = ["diabetes", "hypertension"]
RISK_TIERS = ["low", "medium", "high"]
PROGRAMS = ["CCM", "CCM+Nutrition"]
DEVICE_TYPES = ["glucose", "bp", "weight"]
VENDORS = ["DEVCO-GM", "DEVCO-BP", "DEVCO-SC"]
MED_CLASSES = ["Metformin", "Insulin", "GLP-1", "ACE_inhibitor", "ARB", "Beta_blocker", "Diuretic"]
MED_CHANGES = ["new", "stop", "dose_change", "no_change"]
LOG_CHANGES = ["rollout", "config_push", "hotfix"]
ACTIONS = ["nurse_outreach", "medication_review", "nutrition_check_in", "device_troubleshoot"]


def clean_region(c: str = "region") -> Column:
    return enum_ci_keep_unknown(c, REGIONS, "East")


def _text(c: str) -> Column:
    return F.col(c).cast("string").alias(c)


def _moment(c: str) -> list[Column]:
    """Timestamp, its date and its week."""
    return [
        F.col(c).cast("timestamp").alias(c),
        F.col(c).cast("date").alias("date"),
        week_start(F.col(c).cast("timestamp")).alias("week_start"),
    ]


# ---- silver ---------------------------------------------------------------


def silver_patient_master(raw: DataFrame) -> DataFrame:
    program = F.col("program")
    return raw.select(
        _text("patient_id"),
        clean_region().alias("region"),
        enum_ci("condition", CONDITIONS, "diabetes").alias("condition"),
        enum_ci("risk_tier", RISK_TIERS, "medium").alias("risk_tier"),
        classify(
            [(program.isin(*PROGRAMS), program), (F.upper(program).like("%NUTR%"), "CCM+Nutrition")], "CCM"
        ).alias("program"),
        F.col("enrollment_date").cast("date").alias("enrollment_date"),
        F.col("active_flag").cast("boolean").alias("active_flag"),
    )


def silver_device_readings(raw: DataFrame) -> DataFrame:
    is_bp = F.lower(F.trim("device_type")) == "bp"
    return raw.select(
        _text("reading_id"),
        _text("patient_id"),
        clean_region().alias("region"),
        enum_ci("device_type", DEVICE_TYPES, "glucose").alias("device_type"),
        enum_ci("vendor", VENDORS, "DEVCO-GM").alias("vendor"),
        "firmware_version",
        *_moment("reading_time"),
        *[
            F.col(c).cast("double").alias(c)
            for c in ("glucose_mg_dl", "bp_systolic_mm_hg", "bp_diastolic_mm_hg", "weight_kg")
        ],
        F.col("valid_flag").cast("boolean").alias("valid_flag"),
        null_default("error_code", "NONE").alias("error_code"),
        flag(is_bp & F.col("bp_diastolic_mm_hg").isNull()).alias("bp_missing_diastolic"),
    )


def silver_encounter_notes(raw: DataFrame) -> DataFrame:
    """Note flags without the note text, which the scan then never reads."""
    return raw.select(
        _text("note_id"),
        _text("patient_id"),
        clean_region().alias("region"),
        *_moment("note_time"),
        F.col("diet_non_adherence_flag").cast("boolean").alias("diet_non_adherence_flag"),
        F.col("med_adherence_flag").cast("boolean").alias("med_adherence_flag"),
    )


def silver_medication_lists(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("list_id"),
        _text("patient_id"),
        clean_region().alias("region"),
        *_moment("snapshot_time"),
        enum_exact("med_class", MED_CLASSES, "Other", trim=False).alias("med_class"),
        enum_exact("change_type", MED_CHANGES, "no_change", trim=False).alias("change_type"),
    )


def silver_device_change_log(raw: DataFrame) -> DataFrame:
    return raw.select(
        _text("change_id"),
        F.col("change_date").cast("timestamp").alias("change_date"),
        F.col("change_date").cast("date").alias("date"),
        enum_ci_keep_unknown("vendor", VENDORS, "DEVCO-GM").alias("vendor"),
        enum_ci("device_type", DEVICE_TYPES, "glucose").alias("device_type"),
        "version",
        F.trim("regions_scope").alias("regions_scope"),
        enum_ci_self("change_type", LOG_CHANGES).alias("change_type"),
        null_default("error_codes", "NONE").alias("error_codes"),
        "notes",
    )


def silver_care_actions(raw: DataFrame, patients: DataFrame) -> DataFrame:
    """Care actions; an unknown condition is taken from the patient registry."""
    registry = patients.select("patient_id", F.col("condition").alias("registry_condition"))
    joined = left_enrich(raw, registry, ["patient_id"], ["registry_condition"])
    return joined.select(
        "action_id",
        "patient_id",
        clean_region().alias("region"),
        enum_ci("condition", CONDITIONS, F.col("registry_condition")).alias("condition"),
        *_moment("action_time"),
        enum_ci("action_type", ACTIONS, "nurse_outreach").alias("action_type"),
        F.col("executed_flag").cast("boolean").alias("executed_flag"),
        F.col("estimated_cost_usd").cast("double").alias("estimated_cost_usd"),
    )


# ---- gold -----------------------------------------------------------------


def gold_date_spine(spark: SparkSession, start: str = "2025-08-01", end: str = "2025-11-10") -> DataFrame:
    return date_spine(spark, start, end)


def gold_device_ingestion(readings: DataFrame, calendar: DataFrame, patients: DataFrame) -> DataFrame:
    """Dense date-region-device table of readings and their valid share (NULL without readings)."""
    regions = patients.select("region").distinct()
    grid = scaffold(regions, {"date": days_of(calendar), "device_type": DEVICE_TYPES})
    key = ["date", "region", "device_type"]
    counts = readings.groupBy(*key).agg(
        F.count(F.lit(1)).alias("readings_total"), count_if(F.col("valid_flag")).alias("readings_valid")
    )
    dense = densify(grid, [counts], key, {"readings_total": 0, "readings_valid": 0})
    return dense.select(
        *key, "readings_total", "readings_valid",
        ratio(F.col("readings_valid"), F.col("readings_total")).alias("valid_rate"),
    )


def gold_bp_quality(readings: DataFrame) -> DataFrame:
    is_bp = F.col("device_type") == "bp"
    counts = readings.groupBy("date", "region").agg(
        count_if(is_bp).alias("bp_readings"),
        count_if(is_bp & F.col("bp_missing_diastolic")).alias("diastolic_missing"),
    )
    return counts.withColumn("missing_rate_diastolic", ratio(F.col("diastolic_missing"), F.col("bp_readings")))


def gold_encounter_signals(notes: DataFrame) -> DataFrame:
    return notes.groupBy("date", "region").agg(
        rate(F.col("diet_non_adherence_flag")).alias("pct_notes_with_diet_non_adherence"),
        rate(F.col("med_adherence_flag")).alias("pct_notes_with_med_adherence_issues"),
        F.count(F.lit(1)).alias("notes_count"),
    )


@dataclass(frozen=True)
class RiskWeights:
    """Fixed values of the patient-day risk score."""

    high: float = 0.5
    medium: float = 0.25
    low: float = 0.1
    no_glucose: float = 0.2
    no_bp: float = 0.15
    missing_factor: float = 0.3
    missing_cap: float = 0.3
    diet: float = 0.1
    medication: float = 0.1
    incident_factor: float = 1.6
    cap: float = 1.0
    incident_start: str = "2025-10-02"
    incident_end: str = "2025-10-21"


def risk_score(w: RiskWeights, has_glucose: Column, has_bp: Column, missing_rate: Column, diet: Column,
               medication: Column) -> Column:
    """Capped risk score of one patient-day from its features (columns tier, condition and date in scope)."""
    tier, condition = F.col("risk_tier"), F.col("condition")

    def add(pred: Column, points: float) -> Column:
        return F.when(pred, F.lit(points)).otherwise(F.lit(0.0))

    base = F.when(tier == "high", w.high).when(tier == "medium", w.medium).otherwise(w.low)
    ingestion = add((has_glucose == 0) & (condition == "diabetes"), w.no_glucose) + add(
        (has_bp == 0) & (condition == "hypertension"), w.no_bp
    )
    quality = F.least(missing_rate * w.missing_factor, F.lit(w.missing_cap))
    signals = add(diet == 1, w.diet) + add(medication == 1, w.medication)
    in_incident = F.col("date").between(F.lit(w.incident_start).cast("date"), F.lit(w.incident_end).cast("date"))
    factor = F.when(in_incident & (tier == "high") & (condition == "diabetes"), w.incident_factor).otherwise(1.0)
    return F.least((base + ingestion + quality + signals) * factor, F.lit(w.cap))


def patient_day_features(readings: DataFrame, notes: DataFrame) -> DataFrame:
    """One row per patient and day that has any reading or note; what is absent counts as 0.

    Readings and notes are stacked and grouped once: one shuffle of patient-days
    that were already combined map-side, instead of two and a full join. The
    missing rate averages readings only, since note rows are NULL there.
    """
    device, valid = F.col("device_type"), F.col("valid_flag")

    def bit(p: Column) -> Column:
        return F.when(p, 1).otherwise(0)

    none = F.lit(None)
    stacked = readings.select(
        "patient_id", "date",
        bit((device == "glucose") & valid).alias("glucose"),
        bit((device == "bp") & valid).alias("bp"),
        bit((device == "bp") & F.col("bp_missing_diastolic")).cast("double").alias("missing"),
        F.lit(0).alias("diet"), F.lit(0).alias("med"),
    ).unionByName(notes.select(
        "patient_id", "date",
        F.lit(0).alias("glucose"), F.lit(0).alias("bp"), none.cast("double").alias("missing"),
        bit(F.col("diet_non_adherence_flag")).alias("diet"),
        bit(F.col("med_adherence_flag")).alias("med"),
    ))
    return stacked.groupBy("patient_id", "date").agg(
        F.max("glucose").alias("has_valid_glucose"),
        F.max("bp").alias("has_valid_bp"),
        F.coalesce(F.avg("missing"), F.lit(0.0)).alias("bp_diastolic_missing_rate"),
        F.max("diet").alias("any_diet_non_adherence"),
        F.max("med").alias("any_med_adherence_issue"),
    )


def gold_patient_risk_daily(calendar: DataFrame, patients: DataFrame, readings: DataFrame, notes: DataFrame,
                            weights: RiskWeights = RiskWeights()) -> DataFrame:
    """Mean risk score of all active patients per date, region, tier and condition.

    The mean runs over every patient on every day, but the patient-day grid is
    never built. A patient without data that day has the score of its group
    (tier, condition, date), so the mean is that score plus the sum of the
    observed patient-days' differences from it, divided by the group's size.
    Work grows with the readings and notes, not with patients times days.
    """
    group = ["region", "risk_tier", "condition"]
    active = patients.where(F.col("active_flag"))
    zero = F.lit(0)
    idle = risk_score(weights, zero, zero, F.lit(0.0), zero, zero)
    seen = risk_score(
        weights, *[
            F.col(c)
            for c in (
                "has_valid_glucose", "has_valid_bp", "bp_diastolic_missing_rate", "any_diet_non_adherence",
                "any_med_adherence_issue",
            )
        ]
    )
    days = calendar.select("date")
    observed = patient_day_features(
        readings.join(days, "date", "left_semi"), notes.join(days, "date", "left_semi")
    ).join(active.select("patient_id", *group), "patient_id")
    extra = observed.groupBy("date", *group).agg(F.sum(seen - idle).alias("_extra"))
    sizes = active.groupBy(*group).agg(F.count(F.lit(1)).alias("patient_days"))
    dense = densify(scaffold(sizes, {"date": days_of(calendar)}), [extra], ["date", *group], {"_extra": 0.0})
    return dense.select(
        "date", *group,
        (idle + F.col("_extra") / F.col("patient_days")).alias("avg_risk_score"),
        "patient_days",
    )


def gold_patient_risk_weekly(daily: DataFrame) -> DataFrame:
    """Weekly mean of the daily means, not weighted by patients."""
    return roll_up(
        daily, "date", "WEEK", ["region", "risk_tier", "condition"],
        {"avg_risk_score": F.avg("avg_risk_score"), "patient_days": F.sum("patient_days")}, "week_start",
    )


def gold_patient_risk_weekly_weighted(daily: DataFrame) -> DataFrame:
    """Weekly mean over patient-days: the weighted variant of :func:`gold_patient_risk_weekly`."""
    days = F.sum("patient_days")
    score = ratio(F.sum(F.col("avg_risk_score") * F.col("patient_days")), days)
    return roll_up(
        daily, "date", "WEEK", ["region", "risk_tier", "condition"],
        {"avg_risk_score": score, "patient_days": days}, "week_start",
    )


def gold_care_actions_weekly(actions: DataFrame) -> DataFrame:
    total, done = F.count(F.lit(1)), count_if(F.col("executed_flag"))
    return actions.groupBy("week_start", "region", "condition", "action_type").agg(
        total.alias("actions_total"),
        done.alias("actions_executed"),
        ratio(done, total).alias("execute_rate"),
        F.avg("estimated_cost_usd").alias("avg_cost_usd"),
    )


def gold_cumulative_care_cost(actions: DataFrame) -> DataFrame:
    daily = actions.groupBy("date", "region", "condition").agg(
        sum_if(F.col("executed_flag"), "estimated_cost_usd").alias("executed_cost_usd")
    )
    return running_sum(daily, "executed_cost_usd", ["region", "condition"], ["date"], "running_total_cost_usd")


def gold_root_cause_alignment(ingestion: DataFrame, changes: DataFrame, readings: DataFrame,
                              devices: tuple[str, ...] = ("glucose", "bp"), lag_days: int = 7) -> DataFrame:
    """Ingestion shifts beside the changes and error counts of the same day, region and device.

    Two joins multiply rows by design: several changes on one day, and error
    counts per vendor that are joined without the vendor.
    """
    key = ["date", "region", "device_type"]
    wanted = F.col("device_type").isin(*devices)
    shifts = delta_vs_lag(
        ingestion.where(wanted), "valid_rate", lag_days, ["region", "device_type"], ["date"],
        "valid_rate_lag7", "delta_vs_7d",
    )
    change_cols = ["vendor", "version", "change_type", "error_codes", "notes"]
    per_region = explode_csv(
        changes.where(wanted).select("date", "device_type", *change_cols, "regions_scope"), "regions_scope", "region"
    ).drop("regions_scope")
    errors = (
        readings.where(wanted)
        .groupBy(*key, "vendor")
        .agg(count_if(F.col("error_code") != "NONE").alias("error_events"))
        .drop("vendor")
    )
    return densify(shifts, [per_region, errors], key).select(
        *key, "readings_total", "readings_valid", "valid_rate", "valid_rate_lag7", "delta_vs_7d",
        *change_cols, "error_events",
    )


def gold_cc_filters_bridge(ingestion: DataFrame, risk: DataFrame, actions_weekly: DataFrame) -> DataFrame:
    """Long list of filter values, one row per source row and field."""
    date, region = F.col("date"), F.col("region")
    return filter_bridge([
        (ingestion, {"region": (date, region, region), "device_type": (date, None, F.col("device_type"))}),
        (risk, {
            "risk_tier": (date, region, F.col("risk_tier")),
            "condition": (date, region, F.col("condition")),
        }),
        (actions_weekly, {"action_type": (F.col("week_start"), None, F.col("action_type"))}),
    ])


# ---- counters -------------------------------------------------------------


def last_date(df: DataFrame, c: str = "date") -> Column:
    """Largest date of a relation as a scalar subquery."""
    return df.agg(F.max(c)).scalar()


def counter_active_patients(patients: DataFrame, readings: DataFrame, calendar: DataFrame, days: int = 30) -> DataFrame:
    """Active patients with a reading in the trailing days of the calendar."""
    recent = in_trailing_days("date", last_date(calendar), days)
    active = patients.where(F.col("active_flag")).select("patient_id").distinct()
    return exists_in(active, readings, ["patient_id"], recent).agg(F.count(F.lit(1)).alias("active_ccm_patients"))


def counter_valid_readings_7d(readings: DataFrame, calendar: DataFrame, days: int = 7) -> DataFrame:
    recent = readings.where(in_trailing_days("date", last_date(calendar), days))
    return recent.agg(F.sum(F.when(F.col("valid_flag"), 1).otherwise(0)).alias("valid_readings_last7"))


def counter_high_risk_avg_7d(risk: DataFrame, days: int = 7) -> DataFrame:
    """Mean daily score of the high tier over the trailing days of the risk table itself.

    The last day is a scalar, so that of a table with a folder for each date only the trailing days are read.
    """
    recent = risk.where((F.col("risk_tier") == "high") & in_trailing_days("date", last_date(risk), days))
    return recent.agg(F.avg("avg_risk_score").alias("avg_daily_risk_high_last7"))


def counter_actions_executed_14d(actions: DataFrame, calendar: DataFrame, days: int = 14) -> DataFrame:
    recent = actions.where(F.col("executed_flag") & in_trailing_days("date", last_date(calendar), days))
    return recent.agg(F.count(F.lit(1)).alias("actions_executed_last14"))
