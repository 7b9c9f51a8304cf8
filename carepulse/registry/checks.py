"""Data quality, vocabulary, metric views and data preparation."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import measures as m
from ..functions.cleaning import band_probability
from ..operators import aggregates as ag, quality as dq, ranking as rk
from ..operators.metrics import MetricStore, largest_of, mean_of, metric_view, row_total
from ..operators.vocabulary import omop_person_load
from ..session import shared_dir
from .core import query
from .inputs import Inputs
from .oracle import share


def _person(t: Inputs):
    return omop_person_load(t.raw("clean_patients"), t.raw("locations"), {"zip": "zip"})


@query("dq_required_not_null", """
SELECT 'person_id' AS "column", count(*) FILTER (WHERE person_id IS NULL) AS null_count FROM person
UNION ALL SELECT 'gender_concept_id', count(*) FILTER (WHERE gender_concept_id IS NULL) FROM person
UNION ALL SELECT 'year_of_birth', count(*) FILTER (WHERE year_of_birth IS NULL) FROM person""")
def _(t: Inputs):
    return dq.dq_required_not_null(_person(t), ["person_id", "gender_concept_id", "year_of_birth"])


@query("dq_value_range", """
SELECT 'year_of_birth' AS "column", count(*) FILTER (WHERE year_of_birth < 1900 OR year_of_birth > 2000) AS invalid_count FROM person""")
def _(t: Inputs):
    return dq.dq_value_range(_person(t), "year_of_birth", 1900, 2000)


@query("dq_interval_order", """
WITH v AS (SELECT patient_id, arrival_time_utc AS s, provider_start_time_utc AS e FROM silver_er_visits),
p AS (SELECT 'P-' || CAST(c_custkey AS VARCHAR) AS patient_id, TIMESTAMP '2024-01-02 00:00:00' AS lo,
  TIMESTAMP '2024-01-02 00:00:00' + INTERVAL 1 DAY * CAST(c_custkey % 30 AS INT) AS hi FROM customer)
SELECT 'start_after_end' AS rule, count(*) FILTER (WHERE s > e) AS violations FROM v
UNION ALL SELECT 'in_future', count(*) FILTER (WHERE s > TIMESTAMP '2024-01-29' OR e > TIMESTAMP '2024-01-29') FROM v
UNION ALL SELECT 'outside_period', count(*) FROM v WHERE NOT EXISTS (
  SELECT 1 FROM p WHERE p.patient_id = v.patient_id AND v.s >= p.lo AND coalesce(v.e, v.s) <= p.hi)""")
def _(t: Inputs):
    start = F.lit("2024-01-02 00:00:00").cast("timestamp")
    periods = t.supplied("customer").select(
        F.concat(F.lit("P-"), F.col("c_custkey").cast("string")).alias("patient_id"),
        start.alias("period_start"),
        F.timestamp_add("DAY", (F.col("c_custkey") % 30).cast("int"), start).alias("period_end"),
    )
    return dq.dq_interval_order(
        t.visits, "arrival_time_utc", "provider_start_time_utc", "2024-01-29 00:00:00", periods, ["patient_id"]
    )


@query("dq_referential", """
SELECT count(DISTINCT c_custkey) AS orphan_keys, count(*) AS orphan_rows FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def _(t: Inputs):
    return dq.dq_referential(t.supplied("customer"), t.supplied("orders"), {"c_custkey": "o_custkey"})


@query("dq_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def _(t: Inputs):
    return dq.dq_unique(t.supplied("lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_dedupe", """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""")
def _(t: Inputs):
    orders = t.supplied("orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return dq.dedupe(orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey")]).drop("o_orderdate")


@query("dq_schema", """
SELECT 'location_code' AS "column", 'missing' AS problem UNION ALL SELECT 'location_id', 'unexpected'
UNION ALL SELECT 'year_of_birth', 'type int, expected string'
UNION ALL SELECT 'gender_concept_id', 'has nulls'
  WHERE EXISTS (SELECT 1 FROM person WHERE gender_concept_id IS NULL)""")
def _(t: Inputs):
    person = _person(t)
    wanted = T.StructType([f for f in person.schema.fields if f.name not in ("location_id", "gender_concept_id", "year_of_birth")])
    wanted = (
        wanted.add("gender_concept_id", T.IntegerType(), False)
        .add("year_of_birth", T.StringType())
        .add("location_code", T.IntegerType())
    )
    return dq.dq_schema(person, wanted)


@query("dq_metrics", """
SELECT count(*) AS rows_total, 100.0 * count(gender_concept_id) / count(*) AS complete_pct_gender_concept_id,
  100.0 * count(birth_datetime) / count(*) AS complete_pct_birth_datetime,
  100.0 * count(*) FILTER (WHERE gender_concept_id <> 0) / count(*) AS standard_pct_gender,
  count(*) FILTER (WHERE year_of_birth NOT BETWEEN 1940 AND 2000) AS invalid_birth,
  count(*) - count(DISTINCT (location_id, year_of_birth)) AS duplicate_rows FROM person""",
       "complete_pct_gender_concept_id complete_pct_birth_datetime standard_pct_gender")
def _(t: Inputs):
    return dq.dq_metrics(
        _person(t), ["gender_concept_id", "birth_datetime"], ["location_id", "year_of_birth"],
        {"gender": F.col("gender_concept_id") != 0}, {"birth": F.col("year_of_birth").between(1940, 2000)},
    )


@query("omop_person_load", "SELECT * FROM person")
def _(t: Inputs):
    return _person(t)


@query("metric_view", """
SELECT coalesce(CAST(gender_concept_id AS VARCHAR), 'unknown') AS gender, count(*) AS total_patients,
  avg(2024 - year_of_birth) AS average_age FROM person GROUP BY ALL""", "average_age")
def _(t: Inputs):
    return metric_view(
        _person(t),
        {"gender": F.coalesce(F.col("gender_concept_id").cast("string"), F.lit("unknown")), "location": F.col("location_id")},
        {"total_patients": F.count(F.lit(1)), "average_age": F.avg(F.lit(2024) - F.col("year_of_birth"))},
        by=["gender"],
    )


_AGE = "2024 - year_of_birth"


@query("metric_states", f"""
WITH p AS (SELECT coalesce(CAST(gender_concept_id AS VARCHAR), 'unknown') AS gender, year_of_birth // 10 * 10 AS decade, {_AGE} AS age FROM person),
g AS (SELECT 'gender' AS grouping, gender AS value, count(*) AS total_patients, avg(age) AS average_age, max(age) AS oldest FROM p GROUP BY gender
UNION ALL SELECT 'decade', CAST(decade AS VARCHAR), count(*), avg(age), max(age) FROM p GROUP BY decade
UNION ALL SELECT 'all', NULL, count(*), avg(age), max(age) FROM p)
SELECT * FROM g""", "average_age")
def _(t: Inputs):
    """Three groupings from one stored state."""
    age = F.lit(2024) - F.col("year_of_birth")
    dims = {"gender": F.coalesce(F.col("gender_concept_id").cast("string"), F.lit("unknown")), "decade": F.expr("year_of_birth DIV 10 * 10")}
    store = MetricStore(t.spark, shared_dir(t.spark, "metrics"), dims, {
        "total_patients": row_total(), "average_age": mean_of(age), "oldest": largest_of(age)})
    store.store(_person(t), ["gender", "decade"])
    answers = [store.answer(list(store.measures), by, [["gender", "decade"]]).select(
        F.lit(by[0] if by else "all").alias("grouping"), (F.col(by[0]) if by else F.lit(None)).cast("string").alias("value"), *store.measures)
        for by in (["gender"], ["decade"], [])]
    return answers[0].unionByName(answers[1]).unionByName(answers[2])


# ---- data preparation -----------------------------------------------------


@query("band_probability", """
SELECT visit_id, readmission_probability, CASE WHEN readmission_probability < 0.1 THEN 'Low'
  WHEN readmission_probability < 0.2 THEN 'Medium' ELSE 'High' END AS band FROM raw_readmission_risk""")
def _(t: Inputs):
    return t.raw("raw_readmission_risk").select(
        "visit_id", "readmission_probability",
        band_probability("readmission_probability", [(0.10, "Low"), (0.20, "Medium")], "High").alias("band"),
    )


@query("sample_fixed_n", """
SELECT visit_id, site FROM silver_er_visits WHERE discharge_disposition <> 'LWBS' AND discharge_time_utc IS NOT NULL
ORDER BY md5('42:' || visit_id), visit_id LIMIT 1500""")
def _(t: Inputs):
    eligible = t.visits.where((F.col("discharge_disposition") != "LWBS") & F.col("discharge_time_utc").isNotNull())
    return rk.sample_fixed_n(eligible.select("visit_id", "site"), 1500, ["visit_id"])


@query("trim_to_target", """
SELECT visit_id, risk_band FROM silver_readmission_risk ORDER BY md5('7:' || visit_id), visit_id LIMIT 4000""")
def _(t: Inputs):
    return rk.trim_to_target(t.risk_feed.select("visit_id", "risk_band"), 4000, ["visit_id"], seed=7)


@query("phase_compare", f"""
SELECT CASE WHEN reading_time < TIMESTAMP '2024-01-10' THEN 'before' WHEN reading_time < TIMESTAMP '2024-01-15' THEN 'during'
  WHEN reading_time < TIMESTAMP '2024-01-20' THEN 'partial_recovery' END AS phase,
  {share('valid_flag')} AS valid_rate, count(*) AS readings
FROM silver_device_readings WHERE reading_time < TIMESTAMP '2024-01-20' AND device_type = 'glucose' GROUP BY ALL""", "valid_rate")
def _(t: Inputs):
    phases = [("before", None, "2024-01-10"), ("during", "2024-01-10", "2024-01-15"), ("partial_recovery", "2024-01-15", "2024-01-20")]
    measures = {"valid_rate": m.rate(F.col("valid_flag")), "readings": F.count(F.lit(1))}
    return ag.phase_compare(t.readings.where("device_type = 'glucose'"), "reading_time", phases, measures)


@query("weekend_compare", f"""
SELECT dayofweek(scheduled_start_utc) IN (0, 6) AS is_weekend, count(*) AS shifts, {share('sick_leave_flag')} AS sick_rate,
  quantile_disc(overtime_hours, 0.5) AS overtime_median FROM silver_hr_shifts WHERE role = 'Nurse' GROUP BY ALL""", "sick_rate")
def _(t: Inputs):
    measures = {
        "shifts": F.count(F.lit(1)),
        "sick_rate": m.rate(F.col("sick_leave_flag")),
    }
    nurses = t.shifts.where("role = 'Nurse'")
    return ag.weekend_compare(nurses, "scheduled_start_utc", measures, {"overtime_median": "overtime_hours"})
