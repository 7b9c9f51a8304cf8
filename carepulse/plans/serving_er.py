"""Serving queries over the emergency-room gold tables.

Each takes gold tables and a reporting period and returns an ordered report.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joining import join_daily
from ..operators.ranking import sort_by, top_k
from ..operators.shaping import project


@dataclass(frozen=True)
class Period:
    """Reporting days, both ends included."""

    first: str = "2025-09-01"
    last: str = "2025-09-30"

    def holds(self, c: str = "date") -> Column:
        return F.col(c).between(F.lit(self.first).cast("date"), F.lit(self.last).cast("date"))

    def holds_half_open(self, c: str = "date") -> Column:
        """The same days written as ``>= first AND < day after last``."""
        return (F.col(c) >= F.lit(self.first).cast("date")) & (
            F.col(c) < F.date_add(F.lit(self.last).cast("date"), 1)
        )


SEPTEMBER = Period()
WAITS = ["median_triage_wait_minutes", "median_door_to_provider_minutes"]


def er_weekend_compare(quality: DataFrame, period: Period = SEPTEMBER) -> DataFrame:
    """Mean rate and waits of weekends against weekdays; the rate has four decimals and is averaged exactly."""
    rate = F.avg(F.col("lwbs_rate").cast("decimal(9,4)"))
    out = quality.where(period.holds()).groupBy("site", "is_weekend").agg(
        F.round(rate, 4).cast("double").alias("avg_lwbs_rate"),
        F.round(F.avg(WAITS[0]), 2).alias("avg_triage_wait_min"),
        F.round(F.avg(WAITS[1]), 2).alias("avg_door_to_provider_min"),
        F.sum("throughput_daily").alias("total_throughput"),
    )
    return sort_by(out, [("site", True), ("is_weekend", False)])


def er_coverage_gaps(staffing: DataFrame, period: Period = SEPTEMBER, role: str = "Nurse") -> DataFrame:
    gaps = staffing.where(
        (F.col("role") == role) & F.col("is_weekend") & period.holds() & F.col("coverage_gap_flag")
    )
    out = project(gaps, {
        "site": "site", "date": "date", "role": "role", "coverage_gap_flag": "coverage_gap_flag",
        "nurse_to_patient_ratio": "avg_nurse_to_patient_ratio", "sick_leave_rate": "sick_leave_rate",
    })
    return sort_by(out, [("site", True), ("date", True)])


def er_overtime_vs_quality(finance: DataFrame, quality: DataFrame, period: Period = SEPTEMBER) -> DataFrame:
    both = join_daily(finance.where(period.holds()), quality)
    out = both.select("site", "date", "overtime_hours_sum", "lwbs_rate", WAITS[1])
    return sort_by(out, [("site", True), ("date", True)])


def er_reimbursement_weekend(finance: DataFrame, period: Period = SEPTEMBER) -> DataFrame:
    out = finance.where(F.col("is_weekend") & period.holds()).groupBy("site").agg(
        F.sum("reimbursement_at_risk_usd").alias("weekend_reimbursement_at_risk_usd"),
        F.max("cumulative_reimbursement_at_risk_usd").alias("cumulative_reimbursement_at_risk_usd"),
    )
    return sort_by(out, [("weekend_reimbursement_at_risk_usd", False), ("site", True)])


def er_hourly_signature(hourly: DataFrame, period: Period = SEPTEMBER) -> DataFrame:
    out = hourly.where(F.col("is_weekend") & period.holds()).select(
        "site", "date", "hour_of_day", "arrivals", "queue_length_median",
        F.round("door_to_triage_median", 2).alias("door_to_triage_median_min"),
        F.round("door_to_provider_median", 2).alias("door_to_provider_median_min"),
        F.round("nurse_to_patient_ratio", 3).alias("nurse_to_patient_ratio"),
    )
    return sort_by(out, [("site", True), ("date", True), ("hour_of_day", True)])


def er_readmission_exposure(readmission: DataFrame, period: Period = SEPTEMBER) -> DataFrame:
    out = readmission.where(period.holds()).groupBy("site", "is_weekend").agg(
        F.round(F.avg("avg_readmission_probability"), 4).alias("avg_readmit_prob"),
        F.round(F.avg("high_risk_share"), 5).alias("high_risk_share_avg"),
        F.sum("realized_readmissions_30d").alias("readmissions_30d"),
    )
    return sort_by(out, [("site", True), ("is_weekend", False)])


def _listing(df: DataFrame, cols: list[str], keep: Column, order: list[str]) -> DataFrame:
    return sort_by(df.where(keep).select(*cols), [(c, True) for c in order])


def er_lwbs_daily(quality: DataFrame, period: Period = SEPTEMBER) -> DataFrame:
    cols = ["site", "date", "is_weekend", "visits_total", "lwbs_rate", *WAITS]
    return _listing(quality, cols, period.holds(), ["date", "site"])


def er_nurse_sick_leave(staffing: DataFrame, period: Period = SEPTEMBER, role: str = "Nurse") -> DataFrame:
    cols = ["site", "date", "is_weekend", "role", "effective_hours", "sick_leave_rate",
            "avg_nurse_to_patient_ratio", "coverage_gap_flag"]
    return _listing(staffing, cols, (F.col("role") == role) & period.holds(), ["date", "site"])


def er_urban_hourly(hourly: DataFrame, period: Period = SEPTEMBER, region: str = "Urban") -> DataFrame:
    rows = hourly.where((F.col("region") == region) & period.holds())
    out = project(rows, {
        **{c: c for c in ("site", "date", "hour_of_day", "is_weekend", "arrivals", "throughput",
                          "queue_length_median")},
        "triage_wait_median": "door_to_triage_median",
        **{c: c for c in ("door_to_provider_median", "effective_staffing_hours", "nurse_to_patient_ratio")},
    })
    return sort_by(out, [("site", True), ("date", True), ("hour_of_day", True)])


def er_finance_listing(finance: DataFrame, period: Period = SEPTEMBER) -> DataFrame:
    cols = ["site", "date", "is_weekend", "overtime_hours_sum", "cost_per_visit_avg",
            "reimbursement_at_risk_usd", "cumulative_reimbursement_at_risk_usd"]
    return _listing(finance, cols, period.holds(), ["date", "site"])


def er_finance_by_region(finance: DataFrame, period: Period = SEPTEMBER, unit: str = "ER") -> DataFrame:
    """The second form of the finance listing: one unit, with region."""
    cols = ["date", "site", "region", "is_weekend", "overtime_hours_sum", "reimbursement_at_risk_usd",
            "cumulative_reimbursement_at_risk_usd"]
    return _listing(finance, cols, (F.col("unit") == unit) & period.holds_half_open(), ["date", "site"])


def er_readmission_listing(readmission: DataFrame, period: Period = SEPTEMBER) -> DataFrame:
    cols = ["site", "date", "is_weekend", "avg_readmission_probability", "high_risk_share",
            "realized_readmissions_30d"]
    return _listing(readmission, cols, period.holds(), ["date", "site"])


def er_lwbs_ranking(quality: DataFrame, period: Period = SEPTEMBER, unit: str = "ER") -> DataFrame:
    out = quality.where((F.col("unit") == unit) & period.holds_half_open()).select(
        "date", "is_weekend", "site", "visits_total", "lwbs_rate", *WAITS
    )
    return sort_by(out, [("lwbs_rate", False), ("visits_total", False)])


def er_gap_vs_quality(quality: DataFrame, staffing: DataFrame, period: Period = SEPTEMBER, unit: str = "ER",
                      role: str = "Nurse") -> DataFrame:
    daily = quality.where((F.col("unit") == unit) & period.holds_half_open())
    out = join_daily(daily, staffing.where(F.col("role") == role)).select(
        "date", "site", "region", "sick_leave_rate", "avg_nurse_to_patient_ratio", "coverage_gap_flag",
        "lwbs_rate", *WAITS,
    )
    return sort_by(out, [("date", True), ("site", True)])


def er_weekend_hour_peaks(hourly: DataFrame, period: Period = SEPTEMBER, unit: str = "ER") -> DataFrame:
    names = {
        "arrivals": "avg_arrivals",
        "queue_length_median": "avg_queue_median",
        "door_to_triage_median": "avg_triage_wait_mins",
        "door_to_provider_median": "avg_dtp_mins",
        "effective_staffing_hours": "avg_effective_staffing_hours",
    }
    rows = hourly.where((F.col("unit") == unit) & F.col("is_weekend") & period.holds_half_open())
    out = rows.groupBy("site", "hour_of_day").agg(*[F.avg(c).alias(name) for c, name in names.items()])
    return sort_by(out, [("site", True), ("avg_queue_median", False), ("avg_arrivals", False)])


def er_risk_vs_access(readmission: DataFrame, quality: DataFrame, period: Period = SEPTEMBER,
                      unit: str = "ER") -> DataFrame:
    risk = readmission.where((F.col("unit") == unit) & period.holds_half_open())
    out = join_daily(risk, quality).select(
        "date", "site", "region", "is_weekend", "avg_readmission_probability", "high_risk_share", "lwbs_rate", WAITS[1]
    )
    return sort_by(out, [("avg_readmission_probability", False), ("lwbs_rate", False)])


def er_top10_lwbs(quality: DataFrame, k: int = 10, period: Period = SEPTEMBER) -> DataFrame:
    cols = ["site", "date", "is_weekend", "visits_total", "lwbs_rate", *WAITS]
    return top_k(quality.where(period.holds()), "lwbs_rate", k, ["date", "site", "unit", "is_weekend"]).select(*cols)


def er_top10_lwbs_pct(quality: DataFrame, k: int = 10, period: Period = SEPTEMBER) -> DataFrame:
    """The worst site-days with the rate in percent."""
    best = top_k(quality.where(period.holds()), "lwbs_rate", k, ["date", "site", "unit", "is_weekend"])
    return best.select(
        "site", "date", "is_weekend", "visits_total",
        F.round(F.col("lwbs_rate") * 100, 2).alias("lwbs_rate_pct"), *WAITS, "satisfaction_overall_avg",
    )
