"""Cleaning operators and scalar functions over the raw-shaped feeds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as c, measures as m, temporal as tm, wording as wd
from ..operators import shaping as sh
from ..plans import cc, er
from .core import query
from .inputs import AS_OF, Inputs
from .oracle import cc_region, members, minutes, region, site

AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"


@query("trim_keys", "SELECT trim(visit_id) AS visit_id, trim(patient_id) AS patient_id FROM raw_er_visits")
def _(t: Inputs):
    return sh.trim_cols(t.raw("raw_er_visits").select("visit_id", "patient_id"), ["visit_id", "patient_id"])


@query("enum_exact", f"SELECT visit_id, {site()} AS site FROM raw_er_visits")
def _(t: Inputs):
    return t.raw("raw_er_visits").select("visit_id", er.clean_site().alias("site"))


@query("enum_ci", f"""
SELECT visit_id, {members('discharge_disposition', er.DISPOSITIONS, "'Discharged'")} AS disposition FROM raw_er_visits""")
def _(t: Inputs):
    cleaned = c.enum_ci("discharge_disposition", er.DISPOSITIONS, "Discharged")
    return t.raw("raw_er_visits").select("visit_id", cleaned.alias("disposition"))


@query("enum_ci_keep_unknown", f"SELECT patient_id, {cc_region()} AS region FROM raw_patient_master")
def _(t: Inputs):
    return t.raw("raw_patient_master").select("patient_id", cc.clean_region().alias("region"))


@query("enum_ci_self", f"""
SELECT change_id, {members('change_type', cc.LOG_CHANGES, 'lower(trim(change_type))')} AS change_type FROM raw_device_change_log""")
def _(t: Inputs):
    return t.raw("raw_device_change_log").select("change_id", c.enum_ci_self("change_type", cc.LOG_CHANGES).alias("change_type"))


@query("enum_fallback_lookup", "SELECT action_id, condition FROM silver_care_actions")
def _(t: Inputs):
    return t.actions.select("action_id", "condition")


@query("program_map", "SELECT patient_id, program FROM silver_patient_master")
def _(t: Inputs):
    return t.patients.select("patient_id", "program")


@query("null_default", """
SELECT visit_id, coalesce(diagnosis_group, 'Other') AS diagnosis_group, coalesce(readmission_30d_flag, FALSE) AS readmission_30d_flag
FROM raw_er_visits""")
def _(t: Inputs):
    rows = t.raw("raw_er_visits").select("visit_id", "diagnosis_group", "readmission_30d_flag")
    return sh.defaults(rows, {"diagnosis_group": "Other", "readmission_30d_flag": False})


@query("typed_cast", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
  CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority, try_cast(o_orderstatus AS INT) AS status FROM orders""")
def _(t: Inputs):
    rows = t.supplied("orders").select(
        "o_orderkey", "o_orderdate", F.substring("o_orderpriority", 1, 1).alias("priority"), F.col("o_orderstatus").alias("status")
    )
    strict = sh.cast_cols(rows, {"o_orderkey": "string", "o_orderdate": "date", "priority": "int"})
    return sh.cast_cols(strict, {"status": "int"}, lenient=True)


@query("in_bucket", f"SELECT visit_id, {region()} AS region FROM silver_er_visits")
def _(t: Inputs):
    return t.visits.select("visit_id", er.region_of("site").alias("region"))


@query("bool_flag", """
SELECT flow_id, coalesce(door_to_provider_minutes > 10, FALSE) AS slow, coalesce(telemetry_status = 'DELAYED', FALSE) AS late
FROM raw_patient_flow""")
def _(t: Inputs):
    return t.raw("raw_patient_flow").select(
        "flow_id", c.flag(F.col("door_to_provider_minutes") > 10).alias("slow"),
        c.flag(F.col("telemetry_status") == "DELAYED").alias("late"),
    )


@query("cond_value", "SELECT shift_id, shift_date, effective_shift_hours FROM silver_hr_shifts")
def _(t: Inputs):
    return t.shifts.select(
        "shift_id", "shift_date", c.value_if(F.col("attended_flag"), "shift_coverage_hours").alias("effective_shift_hours")
    )


@query("const_col", "SELECT visit_id, 'ER' AS service_line FROM raw_er_visits")
def _(t: Inputs):
    return sh.with_const(t.raw("raw_er_visits").select("visit_id"), "service_line", "ER")


@query("rename_project", "SELECT note_id AS id, note_time AS happened_at FROM raw_encounter_notes")
def _(t: Inputs):
    return sh.project(t.raw("raw_encounter_notes"), {"id": "note_id", "happened_at": "note_time"})


@query("star_plus", "SELECT *, CAST(floor(l_extendedprice) * l_quantity AS DOUBLE) AS gross, l_tax = 0 AS untaxed FROM lineitem")
def _(t: Inputs):
    return t.supplied("lineitem").withColumns(
        {"gross": F.floor("l_extendedprice") * F.col("l_quantity"), "untaxed": F.col("l_tax") == 0}
    )


@query("filter_eq_in_between", """
SELECT * FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_totalprice BETWEEN 50000 AND 400000 AND o_custkey IS NOT NULL
  AND o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '2000-01-01'""")
def _(t: Inputs):
    date = F.col("o_orderdate")
    return sh.where(
        t.supplied("orders"),
        (F.col("o_orderstatus") != "P")
        & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
        & F.col("o_totalprice").between(50000, 400000)
        & F.col("o_custkey").isNotNull()
        & (date >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & (date < F.lit("2000-01-01").cast("timestamp_ntz")),
    )


# ---- scalar functions -----------------------------------------------------


@query("fn_string", """
SELECT p_partkey, upper(trim(p_name)) AS loud, lower(p_brand) AS quiet, p_type LIKE 'S%' AS starts_with_s,
  string_split(p_name, ' ')[1] AS first_word FROM part""")
def _(t: Inputs):
    return t.supplied("part").select(
        "p_partkey", F.upper(F.trim("p_name")).alias("loud"), F.lower("p_brand").alias("quiet"),
        F.col("p_type").like("S%").alias("starts_with_s"), F.split("p_name", " ")[0].alias("first_word"),
    )


@query("fn_null", """
SELECT reading_id, coalesce(glucose_mg_dl, weight_kg) AS measure, bp_diastolic_mm_hg IS NULL AS lacks_diastolic FROM raw_device_readings""")
def _(t: Inputs):
    return t.raw("raw_device_readings").select(
        "reading_id", F.coalesce("glucose_mg_dl", "weight_kg").alias("measure"),
        F.col("bp_diastolic_mm_hg").isNull().alias("lacks_diastolic"),
    )


@query("fn_date_trunc", """
SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS TIMESTAMP) AS week_start,
  CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month_start FROM orders""")
def _(t: Inputs):
    return t.supplied("orders").select(
        "o_orderkey", tm.week_start("o_orderdate").alias("week_start"), tm.month_start("o_orderdate").alias("month_start")
    )


@query("fn_dayofweek", """
SELECT o_orderkey, CAST(dayofweek(o_orderdate) + 1 AS INT) AS dow, dayofweek(o_orderdate) IN (0, 6) AS is_weekend FROM orders""")
def _(t: Inputs):
    return t.supplied("orders").select(
        "o_orderkey", F.dayofweek("o_orderdate").alias("dow"), tm.is_weekend("o_orderdate").alias("is_weekend")
    )


@query("fn_hour", "SELECT event_id, CAST(hour(ts) AS INT) AS hour_of_day FROM events")
def _(t: Inputs):
    return t.supplied("events").select("event_id", F.hour("ts").alias("hour_of_day"))


@query("fn_year_month_day", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m, CAST(day(o_orderdate) AS INT) AS d FROM orders""")
def _(t: Inputs):
    return t.supplied("orders").select(
        "o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.dayofmonth("o_orderdate").alias("d")
    )


@query("fn_datediff", """
SELECT l_orderkey, l_linenumber, CAST(date_diff('day', DATE '1998-01-01', CAST(l_shipdate AS DATE)) AS INT) AS days FROM lineitem""")
def _(t: Inputs):
    return t.supplied("lineitem").select(
        "l_orderkey", "l_linenumber", F.datediff("l_shipdate", F.lit("1998-01-01").cast("date")).alias("days")
    )


@query("fn_date_sub", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) - 29 AS window_start,
  CAST(o_orderdate AS DATE) BETWEEN DATE '2000-01-31' - 29 AND DATE '2000-01-31' AS in_window FROM orders""")
def _(t: Inputs):
    day = F.col("o_orderdate").cast("date")
    return t.supplied("orders").select(
        "o_orderkey", F.date_sub(day, 29).alias("window_start"),
        tm.in_trailing_days(day, F.lit("2000-01-31").cast("date"), 30).alias("in_window"),
    )


@query("fn_date_literal", """
SELECT event_id, ts >= TIMESTAMP '2024-01-10 12:00:00' AS late, CAST(ts AS DATE) + 1 AS next_day,
  CAST(ts AS DATE) = DATE '2024-01-10' AS on_day FROM events""")
def _(t: Inputs):
    day = F.col("ts").cast("date")
    return t.supplied("events").select(
        "event_id", (F.col("ts") >= F.lit("2024-01-10 12:00:00").cast("timestamp")).alias("late"),
        (day + F.expr("INTERVAL 1 DAY")).cast("date").alias("next_day"),
        (day == F.lit("2024-01-10").cast("date")).alias("on_day"),
    )


@query("fn_duration_minutes", f"""
SELECT visit_id, {minutes('arrival_time_utc', 'discharge_time_utc')} AS stay FROM silver_er_visits""", "stay")
def _(t: Inputs):
    return t.visits.select("visit_id", tm.duration_minutes("arrival_time_utc", "discharge_time_utc").alias("stay"))


@query("fn_round", "SELECT event_id, round(floor(value) / 7, 2) AS r2, round(floor(value) / 7, 4) AS r4 FROM events", "r2 r4")
def _(t: Inputs):
    x = F.floor("value") / 7
    return t.supplied("events").select("event_id", F.round(x, 2).alias("r2"), F.round(x, 4).alias("r4"))


@query("fn_least", "SELECT event_id, least(value, 50) AS capped FROM events")
def _(t: Inputs):
    return t.supplied("events").select("event_id", F.least("value", F.lit(50.0)).alias("capped"))


@query("fn_case", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'part' END AS state,
  CASE WHEN o_totalprice > 200000 THEN 2 ELSE 0 END + CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END AS points FROM orders""")
def _(t: Inputs):
    status = F.col("o_orderstatus")
    points = F.when(F.col("o_totalprice") > 200000, 2).otherwise(0) + F.when(F.col("o_orderpriority").like("1%"), 1).otherwise(0)
    return t.supplied("orders").select(
        "o_orderkey", c.classify([(status == "F", "done"), (status == "O", "open")], "part").alias("state"), points.alias("points")
    )


@query("fn_sequence", """
SELECT p_partkey, CAST(unnest(generate_series(1, p_size)) AS INT) AS step FROM part""")
def _(t: Inputs):
    return t.supplied("part").select("p_partkey", F.explode(F.sequence(F.lit(1), F.col("p_size"))).alias("step"))


@query("fn_arith_rate", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_tax <> 0 THEN l_quantity / l_tax END AS or_null,
  CASE WHEN l_tax <> 0 THEN l_quantity / l_tax ELSE 0 END AS or_zero FROM lineitem""", "or_null or_zero")
def _(t: Inputs):
    num, den = F.col("l_quantity"), F.col("l_tax")
    return t.supplied("lineitem").select(
        "l_orderkey", "l_linenumber", m.ratio(num, den).alias("or_null"), m.ratio(num, den, 0.0).alias("or_zero")
    )


@query("fn_concat_notes", """
SELECT note_id, CASE WHEN diet_non_adherence_flag AND med_adherence_flag THEN 'Diet. Medication.'
  WHEN diet_non_adherence_flag THEN 'Diet.' WHEN med_adherence_flag THEN 'Medication.' END AS summary FROM raw_encounter_notes""")
def _(t: Inputs):
    parts = [(F.col("diet_non_adherence_flag"), "Diet"), (F.col("med_adherence_flag"), "Medication")]
    return t.raw("raw_encounter_notes").select("note_id", wd.join_sentences(parts).alias("summary"))


@query("fn_format_date", """
SELECT visit_id, coalesce(strftime(discharge_time_utc, '%m/%d/%Y'), 'Unknown') AS left_on FROM silver_er_visits""")
def _(t: Inputs):
    return t.visits.select("visit_id", tm.us_date("discharge_time_utc").alias("left_on"))


@query("fn_time_ago", f"""
SELECT event_id, CASE WHEN age >= 86400 THEN concat(age // 86400, CASE WHEN age >= 172800 THEN ' days' ELSE ' day' END)
  WHEN age > 3600 THEN concat(age // 3600, CASE WHEN age >= 7200 THEN ' hours' ELSE ' hour' END)
  ELSE concat(age // 60, CASE WHEN age >= 120 THEN ' minutes' ELSE ' minute' END) END || ' ago' AS age_text
FROM (SELECT event_id, CAST(floor(epoch({AS_OF_SQL} - ts)) AS BIGINT) AS age FROM events) ages""")
def _(t: Inputs):
    return t.supplied("events").select("event_id", tm.time_ago(F.col("ts").cast("timestamp"), F.lit(AS_OF).cast("timestamp")).alias("age_text"))


@query("fn_unit_convert", """
SELECT reading_id, printf('%.1f lbs', weight_kg * 2.20462::DOUBLE) AS pounds, CAST(trunc(glucose_mg_dl) AS INT) || ' mg/dL' AS glucose,
  CAST(trunc(bp_systolic_mm_hg) AS INT) || '/' || CAST(trunc(bp_diastolic_mm_hg) AS INT) || ' mmHg' AS pressure
FROM silver_device_readings""")
def _(t: Inputs):
    def known(source: str, text):
        return F.when(F.col(source).isNotNull(), text)

    return t.readings.select(
        "reading_id", known("weight_kg", wd.pounds_text("weight_kg")).alias("pounds"),
        known("glucose_mg_dl", wd.glucose_text("glucose_mg_dl")).alias("glucose"),
        wd.pressure_text("bp_systolic_mm_hg", "bp_diastolic_mm_hg").alias("pressure"),
    )
