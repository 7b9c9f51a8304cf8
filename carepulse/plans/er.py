"""Emergency-room tables. Inputs and outputs are DataFrames; nothing is run here."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import bucket_in, enum_ci, enum_exact, flag, null_default, value_if
from ..functions.measures import count_if, rate, ratio
from ..functions.temporal import decode_time, duration_minutes, is_weekend, month_start, week_start
from ..operators.selection import exact_quantiles
from ..operators.joining import densify, left_enrich
from ..operators.sets import union_distinct
from ..operators.windows import partition_medians, running_sum, with_partition_median

# The sites of each region, and the enum members of the raw feeds.
SITE_REGIONS: Mapping[str, Sequence[str]] = {
    "Urban": ["Lakeview Central", "Lakeview East"],
    "Suburban": ["North Ridge", "South Point"],
    "Rural": ["Pine Valley", "Riverbend"],
}
DISPOSITIONS = ["Discharged", "Admitted", "Transferred", "LWBS"]
ROLES = ["Nurse", "Physician", "Tech", "Registration"]
RISK_BANDS = ["Low", "Medium", "High"]
SICK_STATES = ["REPORTED", "CONFIRMED"]

SERVICE_LINE = "ER"
UNKNOWN_SITE = "Unknown Site"
UNKNOWN_REGION = "Unknown Region"


def clean_site(c: str = "site", regions: Mapping[str, Sequence[str]] = SITE_REGIONS) -> Column:
    return enum_exact(c, [s for members in regions.values() for s in members], UNKNOWN_SITE)


def region_of(c: str | Column = "site", regions: Mapping[str, Sequence[str]] = SITE_REGIONS) -> Column:
    return bucket_in(c, regions, UNKNOWN_REGION)


def clean_unit(c: str = "unit") -> Column:
    return F.coalesce(F.trim(c), F.lit("ER"))


# ---- silver ---------------------------------------------------------------


def silver_er_visits(raw: DataFrame, regions: Mapping[str, Sequence[str]] = SITE_REGIONS) -> DataFrame:
    """One row per visit: typed, normalised, with calendar columns and durations."""
    typed = raw.select(
        F.trim("visit_id").alias("visit_id"),
        F.trim("patient_id").alias("patient_id"),
        clean_site("site", regions).alias("site"),
        clean_unit().alias("unit"),
        decode_time("arrival_time").alias("arrival_time_utc"),
        decode_time("discharge_time").alias("discharge_time_utc"),
        decode_time("provider_start_time").alias("provider_start_time_utc"),
        F.col("arrival_hour").cast("int").alias("arrival_hour"),
        F.col("acuity_level").cast("int").alias("acuity_level"),
        null_default("diagnosis_group", "Other").alias("diagnosis_group"),
        enum_ci("discharge_disposition", DISPOSITIONS, "Discharged").alias("discharge_disposition"),
        null_default("readmission_30d_flag", False).alias("readmission_30d_flag"),
        F.col("cost_per_visit_usd").cast("double").alias("cost_per_visit_usd"),
    )
    arrival = "arrival_time_utc"
    return typed.select(
        "*",
        F.col(arrival).cast("date").alias("arrival_date"),
        week_start(arrival).alias("week_start"),
        month_start(arrival).alias("month_start"),
        F.dayofweek(arrival).alias("day_of_week_num"),
        is_weekend(arrival).alias("is_weekend"),
        F.col("provider_start_time_utc").isNull().alias("provider_start_time_null_flag"),
        duration_minutes(arrival, "discharge_time_utc").alias("visit_duration_minutes"),
        duration_minutes(arrival, "provider_start_time_utc").alias("door_to_provider_minutes_raw"),
        region_of("site", regions).alias("region"),
        F.lit(SERVICE_LINE).alias("service_line"),
    )


def silver_hr_shifts(raw: DataFrame, regions: Mapping[str, Sequence[str]] = SITE_REGIONS) -> DataFrame:
    """One row per shift with attendance, sick-leave flag and effective hours."""
    typed = raw.select(
        F.trim("shift_id").alias("shift_id"),
        F.trim("staff_id").alias("staff_id"),
        enum_exact("role", ROLES, "Other").alias("role"),
        clean_site("site", regions).alias("site"),
        clean_unit().alias("unit"),
        decode_time("scheduled_start").alias("scheduled_start_utc"),
        decode_time("scheduled_end").alias("scheduled_end_utc"),
        null_default("actual_attended", True).alias("attended_flag"),
        null_default("sick_leave_status", "None").alias("sick_leave_status"),
        F.col("overtime_hours").cast("double").alias("overtime_hours"),
        F.col("shift_coverage_hours").cast("double").alias("shift_coverage_hours"),
        null_default("change_log_note", "").alias("change_log_note"),
    )
    start = "scheduled_start_utc"
    return typed.select(
        "*",
        F.col(start).cast("date").alias("shift_date"),
        F.dayofweek(start).alias("day_of_week_num"),
        is_weekend(start).alias("is_weekend"),
        F.hour(start).alias("start_hour"),
        F.hour("scheduled_end_utc").alias("end_hour"),
        F.upper("sick_leave_status").isin(*SICK_STATES).alias("sick_leave_flag"),
        value_if(F.col("attended_flag"), "shift_coverage_hours").alias("effective_shift_hours"),
        region_of("site", regions).alias("region"),
        F.lit(SERVICE_LINE).alias("service_line"),
    )


def clean_patient_flow(raw: DataFrame, regions: Mapping[str, Sequence[str]] = SITE_REGIONS) -> DataFrame:
    """Telemetry rows without the smoothed queue length; enough for every gold table."""
    event = decode_time("event_time")
    return raw.select(
        F.trim("flow_id").alias("flow_id"),
        clean_site("site", regions).alias("site"),
        clean_unit().alias("unit"),
        event.alias("event_time_utc"),
        event.cast("date").alias("date"),
        F.col("hour_of_day").cast("int").alias("hour_of_day"),
        F.col("door_to_triage_minutes").cast("double").alias("triage_wait_minutes"),
        F.col("door_to_provider_minutes").cast("double").alias("door_to_provider_minutes"),
        F.col("triage_level").cast("int").alias("triage_level"),
        F.col("queue_length").cast("int").alias("queue_length"),
        null_default("telemetry_status", "OK").alias("telemetry_status"),
    )


FLOW_HOUR = ["site", "date", "hour_of_day"]
FLOW_MEDIAN = "queue_length_median_15min"


def flow_hour_medians(raw: DataFrame, regions: Mapping[str, Sequence[str]] = SITE_REGIONS) -> DataFrame:
    """Median queue length per site, date and hour; a small table worth storing first."""
    return partition_medians(clean_patient_flow(raw, regions), "queue_length", FLOW_HOUR, FLOW_MEDIAN)


def silver_patient_flow(raw: DataFrame, regions: Mapping[str, Sequence[str]] = SITE_REGIONS,
                        medians: DataFrame | None = None) -> DataFrame:
    """Telemetry rows with the median queue length of their site, date and hour."""
    smoothed = with_partition_median(clean_patient_flow(raw, regions), "queue_length", FLOW_HOUR, FLOW_MEDIAN, medians)
    event = "event_time_utc"
    return smoothed.select(
        "flow_id", "site", "unit", event, "date", "hour_of_day", "triage_wait_minutes", "door_to_provider_minutes",
        "triage_level", "queue_length", "queue_length_median_15min", "telemetry_status",
        flag(F.col("telemetry_status") == "DELAYED").alias("telemetry_delayed"),
        F.dayofweek(event).alias("day_of_week_num"),
        is_weekend(event).alias("is_weekend"),
        region_of("site", regions).alias("region"),
        F.lit(SERVICE_LINE).alias("service_line"),
    )


def silver_surveys(raw: DataFrame, visits: DataFrame, regions: Mapping[str, Sequence[str]] = SITE_REGIONS) -> DataFrame:
    """Surveys with date, weekend and region of their visit; surveys without a visit stay.

    A missing site has become 'Unknown Site' by then, so the visit's site never
    steps in for it. That is the behaviour to match.
    """
    surveys = raw.select(
        F.trim("survey_id").alias("survey_id"),
        F.trim("visit_id").alias("visit_id"),
        clean_site("site", regions).alias("site"),
        clean_unit().alias("unit"),
        F.col("survey_date").cast("date").alias("survey_date"),
        *[
            F.col(c).cast("double").alias(c)
            for c in ("overall_score", "staff_courtesy", "communication_clarity", "cleanliness")
        ],
        "comments",
    )
    joined = left_enrich(surveys, visits, ["visit_id"], ["arrival_date", "is_weekend", "region"])
    return joined.select(
        *surveys.columns, "arrival_date", "is_weekend", "region", F.lit(SERVICE_LINE).alias("service_line")
    )


def silver_readmission_risk(raw: DataFrame, visits: DataFrame) -> DataFrame:
    """Risk predictions with the attributes of their visit and the lag in days."""
    risk = raw.select(
        F.trim("visit_id").alias("visit_id"),
        F.trim("patient_id").alias("patient_id"),
        F.col("prediction_date").cast("date").alias("prediction_date"),
        F.col("readmission_probability").cast("double").alias("readmission_probability"),
        enum_ci("risk_band", RISK_BANDS, "Medium").alias("risk_band"),
    )
    attributes = ["site", "unit", "arrival_date", "is_weekend", "region"]
    return left_enrich(risk, visits, ["visit_id", "patient_id"], attributes).select(
        *risk.columns,
        *attributes,
        F.lit(SERVICE_LINE).alias("service_line"),
        F.datediff("prediction_date", "arrival_date").alias("lag_days"),
    )


# ---- gold -----------------------------------------------------------------


def er_hour_scaffold(visits: DataFrame) -> DataFrame:
    """Every site, day and hour between the first and last arrival date of all sites.

    One scan gives the sites and the bounds: at most one row per listed site is
    left when the window takes the overall bounds.
    """
    sites = visits.groupBy("site").agg(F.min("arrival_date").alias("_lo"), F.max("arrival_date").alias("_hi"))
    everywhere = Window.partitionBy(F.lit(0))
    days = F.sequence(F.min("_lo").over(everywhere), F.max("_hi").over(everywhere), F.expr("INTERVAL 1 DAY"))
    grid = sites.select("site", days.alias("_days")).select("site", F.explode("_days").alias("date"))
    hours = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("hour_of_day")
    return grid.select("site", "date", hours).select(
        "site", F.lit("ER").alias("unit"), "date", "hour_of_day", is_weekend("date").alias("is_weekend")
    )


def gold_er_operational_hourly(visits: DataFrame, flow: DataFrame, shifts: DataFrame,
                               regions: Mapping[str, Sequence[str]] = SITE_REGIONS,
                               minutes_per_arrival: float = 240.0) -> DataFrame:
    """Dense site-hour table: arrivals, throughput, medians, staffing and two ratios.

    The smoothed queue length is constant within a site-hour, so its median is
    the median of the raw queue length; ``flow`` therefore needs no smoothing
    join (:func:`clean_patient_flow` will do).
    """
    key = ["site", "date", "hour_of_day"]
    left = F.col("discharge_time_utc")

    def movement(date: Column, hour: Column, came: int) -> Column:
        return F.struct(
            date.alias("date"), hour.alias("hour_of_day"), F.lit(came).alias("came"), F.lit(1 - came).alias("went")
        )

    # one scan counts both: each visit is an arrival and, once discharged, a departure
    moves = visits.select("site", F.inline(F.array(
        movement(F.col("arrival_date"), F.col("arrival_hour"), 1), movement(left.cast("date"), F.hour(left), 0)
    ))).where(F.col("date").isNotNull())
    counts = moves.groupBy(*key).agg(F.sum("came").alias("arrivals"), F.sum("went").alias("throughput"))
    waits = exact_quantiles(flow, key, {
        "door_to_triage_median": "triage_wait_minutes",
        "door_to_provider_median": "door_to_provider_minutes",
        "queue_length_median": F.col("queue_length").cast("double"),
    })
    staffing = shifts.groupBy(
        "site", F.col("shift_date").alias("date"), F.col("start_hour").alias("hour_of_day")
    ).agg(F.sum("effective_shift_hours").alias("effective_staffing_hours"))
    dense = densify(
        er_hour_scaffold(visits),
        [counts, waits, staffing],
        key,
        {"arrivals": 0, "throughput": 0, "queue_length_median": 0.0, "effective_staffing_hours": 0.0},
    )
    staffed = F.col("effective_staffing_hours") * 60.0
    per_arrival = ratio(staffed, F.col("arrivals") * minutes_per_arrival)
    return dense.select(
        "site",
        region_of("site", regions).alias("region"),
        "unit", "date", "hour_of_day", "is_weekend", "arrivals", "throughput", "queue_length_median",
        "door_to_triage_median", "door_to_provider_median", "effective_staffing_hours",
        F.round(per_arrival, 3).alias("nurse_to_patient_ratio"),
        F.round(ratio(F.col("throughput"), F.col("arrivals")), 3).alias("occupancy_pct"),
    )


def gold_er_quality_daily(visits: DataFrame, flow: DataFrame, surveys: DataFrame,
                          regions: Mapping[str, Sequence[str]] = SITE_REGIONS) -> DataFrame:
    """Daily left-without-being-seen rate, throughput, median waits and satisfaction."""
    day = ["site", "unit", "date"]
    daily = visits.groupBy("site", "unit", F.col("arrival_date").alias("date"), "is_weekend").agg(
        F.count(F.lit(1)).alias("visits_total"),
        count_if(F.col("discharge_disposition") == "LWBS").alias("lwbs_count"),
        F.count("discharge_time_utc").alias("throughput_daily"),
    )
    waits = exact_quantiles(flow, day, {
        "median_triage_wait_minutes": "triage_wait_minutes",
        "median_door_to_provider_minutes": "door_to_provider_minutes",
    })
    scores = surveys.groupBy("site", "unit", F.col("arrival_date").alias("date")).agg(
        F.avg("overall_score").alias("satisfaction_overall_avg")
    )
    return densify(daily, [waits, scores], day).select(
        "site",
        region_of("site", regions).alias("region"),
        "unit", "date", "is_weekend", "visits_total", "throughput_daily",
        F.round(ratio(F.col("lwbs_count"), F.col("visits_total"), 0.0), 4).alias("lwbs_rate"),
        "median_triage_wait_minutes", "median_door_to_provider_minutes", "satisfaction_overall_avg",
        F.dayofweek("date").alias("day_of_week_num"),
    )


def gold_er_finance_daily(shifts: DataFrame, visits: DataFrame, quality: DataFrame,
                          regions: Mapping[str, Sequence[str]] = SITE_REGIONS, usd_per_point: float = 250.0,
                          breach_minutes: float = 35.0, breach_usd: float = 750.0) -> DataFrame:
    """Daily overtime, mean cost and reimbursement at risk, with its running sum per site."""
    day = ["site", "unit", "date"]
    overtime = shifts.groupBy("site", "unit", F.col("shift_date").alias("date"), "is_weekend").agg(
        F.sum("overtime_hours").alias("overtime_hours_sum")
    )
    costs = visits.groupBy("site", "unit", F.col("arrival_date").alias("date")).agg(
        F.avg("cost_per_visit_usd").alias("cost_per_visit_avg")
    )
    access = quality.select(*day, "lwbs_rate", F.col("median_door_to_provider_minutes").alias("_wait"))
    points = F.coalesce(F.col("lwbs_rate"), F.lit(0.0)) * 100.0
    surcharge = F.when(F.col("_wait") > breach_minutes, F.lit(breach_usd)).otherwise(F.lit(0.0))
    at_risk = densify(overtime, [costs, access], day).withColumn(
        "reimbursement_at_risk_usd", F.round(points * usd_per_point + surcharge, 2)
    )
    total = running_sum(
        at_risk, "reimbursement_at_risk_usd", ["site"], ["date", "unit"], "cumulative_reimbursement_at_risk_usd"
    )
    return total.select(
        "site",
        region_of("site", regions).alias("region"),
        "unit", "date", "is_weekend", "overtime_hours_sum", "cost_per_visit_avg", "reimbursement_at_risk_usd",
        "cumulative_reimbursement_at_risk_usd",
    )


def gold_er_staffing_daily(shifts: DataFrame, hourly: DataFrame, regions: Mapping[str, Sequence[str]] = SITE_REGIONS,
                           gap_role: str = "Nurse", gap_above: float = 0.25) -> DataFrame:
    """Daily hours and sick-leave rate by role; the gap flag marks a ratio above the limit."""
    hours = shifts.groupBy("site", "unit", F.col("shift_date").alias("date"), "is_weekend", "role").agg(
        F.sum("shift_coverage_hours").alias("scheduled_hours"),
        F.sum("effective_shift_hours").alias("effective_hours"),
        rate(F.col("sick_leave_flag")).alias("sick_leave_rate"),
    )
    ratios = hourly.groupBy("site", "date").agg(F.avg("nurse_to_patient_ratio").alias("avg_nurse_to_patient_ratio"))
    gap = flag((F.col("role") == gap_role) & (F.col("avg_nurse_to_patient_ratio") > gap_above))
    return hours.join(ratios, ["site", "date"], "left").select(
        "site",
        region_of("site", regions).alias("region"),
        "unit", "date", "is_weekend", "role", "scheduled_hours", "effective_hours", "sick_leave_rate",
        "avg_nurse_to_patient_ratio",
        gap.alias("coverage_gap_flag"),
    )


def gold_er_readmission_daily(risk: DataFrame, visits: DataFrame,
                              regions: Mapping[str, Sequence[str]] = SITE_REGIONS) -> DataFrame:
    """Daily mean readmission probability, share of high risk, and realised readmissions."""
    predicted = risk.groupBy("site", "unit", F.col("arrival_date").alias("date"), "is_weekend").agg(
        F.avg("readmission_probability").alias("avg_readmission_probability"),
        rate(F.col("risk_band") == "High").alias("high_risk_share"),
    )
    realised = visits.groupBy("site", "unit", F.col("arrival_date").alias("date")).agg(
        count_if(F.col("readmission_30d_flag")).alias("realized_readmissions_30d")
    )
    return predicted.join(realised, ["site", "unit", "date"], "left").select(
        "site",
        region_of("site", regions).alias("region"),
        "unit", "date", "is_weekend", "avg_readmission_probability", "high_risk_share", "realized_readmissions_30d",
    )


def gold_er_filters_bridge(visits: DataFrame, shifts: DataFrame) -> DataFrame:
    """Distinct filter values seen in visits or shifts."""

    def side(df: DataFrame, date: str, role: Column) -> DataFrame:
        return df.select(
            F.col(date).alias("date"),
            "site", "region", "unit", "is_weekend",
            role.alias("role"),
            F.dayofweek(date).alias("day_of_week_num"),
            F.lit(SERVICE_LINE).alias("service_line"),
        )

    return union_distinct(
        side(visits, "arrival_date", F.lit(None).cast("string")), side(shifts, "shift_date", F.col("role"))
    )
