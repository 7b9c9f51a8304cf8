"""Serving queries over the chronic-care tables: period listings and per-patient reports.

The per-patient reports are computed for all patients at once; one patient is a
filter on ``patient_id`` on top, which Spark pushes below the ranking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import time_ago, us_date
from ..functions.wording import glucose_text, join_sentences, pounds_text, pressure_text
from ..operators.ranking import latest_n, lookup, sort_by
from .serving_er import Period

# Report names, targets, outlooks and sentences.
VITALS = {
    "glucose": ("Glucose", "80-130 mg/dL"),
    "bp": ("Blood Pressure", "<140/90 mmHg"),
    "weight": ("Weight", "170-175 lbs"),
}
OUTLOOKS = {  # tier: hospitalization, deterioration
    "high": ("Medium-High", "Medium"),
    "medium": ("Medium", "Low-Medium"),
    "low": ("Low", "Low"),
}
NOTE_TYPE = "Phone Follow-up"
DIET_SENTENCE = "Diet non-adherence noted"
MEDICATION_SENTENCE = "Medication adherence issues"

AUTUMN = Period("2025-09-15", "2025-11-10")
WEEKS = Period("2025-09-01", "2025-11-10")


def _listing(df: DataFrame, cols: list[str], keep: Column, order: list[str]) -> DataFrame:
    return sort_by(df.where(keep).select(*cols), [(c, True) for c in order])


def _weeks(period: Period) -> Column:
    first, last = (F.lit(d).cast("timestamp") for d in (period.first, period.last))
    return F.col("week_start").between(first, last)


def cc_valid_readings(ingestion: DataFrame, period: Period = AUTUMN) -> DataFrame:
    cols = ["date", "region", "device_type", "readings_total", "readings_valid", "valid_rate"]
    return _listing(ingestion, cols, period.holds(), cols[:3])


def cc_bp_missing(bp: DataFrame, period: Period = AUTUMN) -> DataFrame:
    cols = ["date", "region", "bp_readings", "diastolic_missing", "missing_rate_diastolic"]
    return _listing(bp, cols, period.holds(), cols[:2])


def cc_risk_weekly(weekly: DataFrame, period: Period = WEEKS) -> DataFrame:
    cols = ["week_start", "region", "risk_tier", "condition", "avg_risk_score", "patient_days"]
    return _listing(weekly, cols, _weeks(period), cols[:4])


def cc_root_cause(alignment: DataFrame, period: Period = AUTUMN) -> DataFrame:
    cols = ["date", "region", "device_type", "readings_total", "readings_valid", "valid_rate", "valid_rate_lag7",
            "delta_vs_7d", "vendor", "version", "change_type", "error_codes", "notes", "error_events"]
    return _listing(alignment, cols, period.holds(), cols[:3])


def cc_actions_weekly(weekly: DataFrame, period: Period = WEEKS) -> DataFrame:
    cols = ["week_start", "region", "condition", "action_type", "actions_total", "actions_executed",
            "execute_rate", "avg_cost_usd"]
    return _listing(weekly, cols, _weeks(period), cols[:4])


def cc_cumulative_cost(cost: DataFrame, period: Period = AUTUMN) -> DataFrame:
    cols = ["date", "region", "condition", "executed_cost_usd", "running_total_cost_usd"]
    return _listing(cost, cols, period.holds(), cols[:3])


def cc_encounter_signals(signals: DataFrame, period: Period = AUTUMN) -> DataFrame:
    cols = ["date", "region", "pct_notes_with_diet_non_adherence", "pct_notes_with_med_adherence_issues",
            "notes_count"]
    return _listing(signals, cols, period.holds(), cols[:2])


# ---- per patient ----------------------------------------------------------


def patient_info(patients: DataFrame, patient_id: str) -> DataFrame:
    """Registry row of one patient."""
    cols = ["patient_id", "region", "condition", "risk_tier", "program", "enrollment_date", "active_flag"]
    return lookup(patients.select(*cols), "patient_id", patient_id)


def latest_vitals(readings: DataFrame, as_of: str, n: int = 10, glucose_limit: float = 130.0,
                  systolic_limit: float = 140.0, diastolic_limit: float = 90.0) -> DataFrame:
    """Newest reading per device among each patient's last ``n`` readings, as report rows.

    A device that is not among the last ``n`` is absent, and so is one whose
    newest reading there lacks its value. Ties in time go to the larger reading id.
    """
    newest = [F.col("reading_time").desc(), F.col("reading_id").desc()]
    recent = latest_n(readings, ["patient_id"], newest, n, "_among")
    # latest_n's second ranking is by patient and device, so it reuses the shuffle by patient.
    last = latest_n(recent, ["patient_id", "device_type"], newest, 1, "_device")
    device = F.col("device_type")
    glucose_high = F.col("glucose_mg_dl") > glucose_limit
    bp_high = (F.col("bp_systolic_mm_hg") >= systolic_limit) | (F.col("bp_diastolic_mm_hg") >= diastolic_limit)
    high = ((device == "glucose") & glucose_high) | ((device == "bp") & bp_high)

    def by_device(glucose, bp, weight) -> Column:
        return F.when(device == "glucose", glucose).when(device == "bp", bp).when(device == "weight", weight)

    report = last.select(
        "patient_id",
        by_device(*[F.lit(name) for name, _ in VITALS.values()]).alias("type"),
        by_device(
            F.when(F.col("glucose_mg_dl").isNotNull(), glucose_text("glucose_mg_dl")),
            pressure_text("bp_systolic_mm_hg", "bp_diastolic_mm_hg"),
            F.when(F.col("weight_kg").isNotNull(), pounds_text("weight_kg")),
        ).alias("value"),
        F.when(high, "warning").otherwise("normal").alias("status"),
        F.when(high, "up").otherwise("down").alias("trend"),
        time_ago("reading_time", F.lit(as_of).cast("timestamp")).alias("last_reading"),
        by_device(*[F.lit(target) for _, target in VITALS.values()]).alias("target"),
    )
    return report.where(F.col("value").isNotNull())


def latest_risk(patients: DataFrame, risk: DataFrame, fallback: float = 0.68) -> DataFrame:
    """Last daily score of each patient's tier, condition and region, with outlook labels.

    The score is a DOUBLE between 0 and 1 throughout. A group without any score gets the
    fixed fallback score, on the same scale, and labels.
    """
    group = ["risk_tier", "condition", "region"]
    newest = risk.groupBy(*group).agg(
        F.max_by("avg_risk_score", "date").alias("score"), F.max("date").alias("score_date")
    )
    joined = patients.select("patient_id", *group).join(newest, group, "left")
    missing, tier = F.col("score_date").isNull(), F.col("risk_tier")

    def outlook(i: int) -> Column:
        high, medium, low = (OUTLOOKS[t][i] for t in ("high", "medium", "low"))
        return F.when(missing | (tier == "high"), high).when(tier == "medium", medium).otherwise(low)

    return joined.select(
        "patient_id", *group,
        F.coalesce(F.col("score"), F.lit(fallback)).alias("overall"),
        "score_date",
        outlook(0).alias("hospitalization"),
        outlook(1).alias("deterioration"),
    )


def recent_notes(notes: DataFrame, n: int = 5) -> DataFrame:
    """Summaries of the flagged notes among each patient's last ``n`` notes."""
    recent = latest_n(notes, ["patient_id"], [F.col("note_time").desc(), F.col("note_id").desc()], n)
    summary = join_sentences([
        (F.col("diet_non_adherence_flag"), DIET_SENTENCE),
        (F.col("med_adherence_flag"), MEDICATION_SENTENCE),
    ])
    return recent.select(
        "patient_id", "note_id",
        us_date("note_time").alias("date"),
        F.lit(NOTE_TYPE).alias("type"),
        summary.alias("summary"),
    ).where(F.col("summary").isNotNull())
