"""Row generators, joins, aggregates, windows, ranking and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import measures as m
from ..operators import aggregates as ag, joining as jo, ranking as rk, scans as sc, sets, spine, vocabulary, windows as wn
from ..plans import er, serving_er as se
from .core import query
from .inputs import FIRST_DAY, JANUARY, LAST_DAY, Inputs
from .oracle import median, share

# ---- row generators -------------------------------------------------------


@query("date_spine", f"""
SELECT CAST(d.date AS DATE) AS date, CAST(dayofweek(d.date) + 1 AS INT) AS dow, dayofweek(d.date) IN (0, 6) AS is_weekend,
  CAST(date_trunc('week', d.date) AS TIMESTAMP) AS week_start, CAST(date_trunc('month', d.date) AS TIMESTAMP) AS month,
  count(o.o_orderkey) AS orders_total
FROM (SELECT unnest(generate_series(DATE '1990-01-01', DATE '2009-12-31', INTERVAL 1 DAY)) AS date) d
LEFT JOIN orders o ON CAST(o.o_orderdate AS DATE) = CAST(d.date AS DATE) GROUP BY ALL""")
def _(t: Inputs):
    daily = ag.count_by(t.supplied("orders"), {"date": F.col("o_orderdate").cast("date")}, "orders_total")
    return jo.densify(spine.date_spine(t.spark, "1990-01-01", "2009-12-31"), [daily], ["date"], {"orders_total": 0})


@query("date_spine_from_data", """
SELECT date, CAST(dayofweek(date) + 1 AS INT) AS dow, dayofweek(date) IN (0, 6) AS is_weekend,
  CAST(date_trunc('week', date) AS TIMESTAMP) AS week_start, CAST(date_trunc('month', date) AS TIMESTAMP) AS month
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
  FROM (SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem) b) days""")
def _(t: Inputs):
    return spine.date_spine_of(t.supplied("lineitem"), "l_shipdate")


@query("hour_spine", """
SELECT CAST(h.hour_of_day AS INT) AS hour_of_day, count(e.event_id) AS events_total
FROM (SELECT unnest(generate_series(0, 23)) AS hour_of_day) h
LEFT JOIN events e ON hour(e.ts) = h.hour_of_day GROUP BY ALL""")
def _(t: Inputs):
    counts = ag.count_by(t.supplied("events"), {"hour_of_day": F.hour("ts")}, "events_total")
    return jo.densify(spine.hour_spine(t.spark), [counts], ["hour_of_day"], {"events_total": 0})


@query("literal_values", """
SELECT o_orderstatus, label, count(*) AS n FROM orders
JOIN (VALUES ('F', 'finished'), ('O', 'open'), ('P', 'partial')) v(o_orderstatus, label) USING (o_orderstatus) GROUP BY ALL""")
def _(t: Inputs):
    labels = spine.values(t.spark, [("F", "finished"), ("O", "open"), ("P", "partial")], "o_orderstatus string, label string")
    counts = ag.count_by(t.supplied("orders"), {"o_orderstatus": "o_orderstatus"})
    return counts.join(labels, "o_orderstatus").select("o_orderstatus", "label", "n")


@query("explode_csv", """
SELECT change_id, trim(unnest(string_split(regions_scope, ','))) AS region FROM raw_device_change_log""")
def _(t: Inputs):
    return spine.explode_csv(t.raw("raw_device_change_log").select("change_id", "regions_scope"), "regions_scope", "region").drop("regions_scope")


@query("expand_by_count", """
SELECT p_partkey, p_size, CAST(unnest(generate_series(1, p_size)) AS BIGINT) AS copy_no FROM part""")
def _(t: Inputs):
    return spine.repeat_rows(t.supplied("part").select("p_partkey", "p_size"), "p_size", chunk=16, spread=True)


# ---- joins ----------------------------------------------------------------


@query("left_join_one_key", "SELECT survey_id, visit_id, arrival_date, is_weekend, region FROM silver_surveys")
def _(t: Inputs):
    surveys = t.raw("raw_surveys").select("survey_id", F.trim("visit_id").alias("visit_id"))
    return jo.left_enrich(surveys, t.visits, ["visit_id"], ["arrival_date", "is_weekend", "region"]).select(
        "survey_id", "visit_id", "arrival_date", "is_weekend", "region"
    )


@query("left_join_composite", "SELECT visit_id, patient_id, site, lag_days FROM silver_readmission_risk")
def _(t: Inputs):
    return t.risk_feed.select("visit_id", "patient_id", "site", "lag_days")


@query("left_join_chain", """
SELECT site, date, hour_of_day, arrivals, throughput, door_to_triage_median FROM gold_er_operational_hourly""")
def _(t: Inputs):
    key = ["site", "date", "hour_of_day"]
    arrivals = ag.count_by(t.visits, {"site": "site", "date": "arrival_date", "hour_of_day": "arrival_hour"}, "arrivals")
    left = F.col("discharge_time_utc")
    throughput = ag.count_by(
        t.visits.where(left.isNotNull()), {"site": "site", "date": left.cast("date"), "hour_of_day": F.hour(left)}, "throughput"
    )
    waits = ag.exact_quantiles(t.flow, key, {"door_to_triage_median": "triage_wait_minutes"})
    grid = er.er_hour_scaffold(t.visits).select(*key)
    return jo.densify(grid, [arrivals, throughput, waits], key, {"arrivals": 0, "throughput": 0})


@query("left_join_three_key", """
SELECT site, unit, date, visits_total, median_triage_wait_minutes, satisfaction_overall_avg FROM gold_er_quality_daily""",
       "satisfaction_overall_avg")
def _(t: Inputs):
    return t.quality.select("site", "unit", "date", "visits_total", "median_triage_wait_minutes", "satisfaction_overall_avg")


@query("cross_join_scaffold", "SELECT site, date, hour_of_day FROM er_grid")
def _(t: Inputs):
    return er.er_hour_scaffold(t.visits).select("site", "date", "hour_of_day")


@query("cross_join_one_row", """
SELECT o_orderkey, CAST(date_diff('day', lo, CAST(o_orderdate AS DATE)) AS INT) AS days_in, hi AS last_day
FROM orders, (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders) b""")
def _(t: Inputs):
    orders = t.supplied("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    ranged = jo.with_bounds(orders, ag.bounds(orders, "day"))
    return ranged.select("o_orderkey", F.datediff("day", "lo").alias("days_in"), F.col("hi").alias("last_day"))


@query("filtered_cross_join", """
SELECT d.date, p.risk_tier, count(*) AS patients FROM gold_date_spine d CROSS JOIN silver_patient_master p
WHERE p.active_flag GROUP BY ALL""")
def _(t: Inputs):
    # every day meets every active patient, so patients are counted first and the pairs never made
    active = ag.count_by(t.patients.where("active_flag"), {"risk_tier": "risk_tier"}, "patients")
    return spine.scaffold(active, {"date": spine.days_of(t.calendar)}).select("date", "risk_tier", "patients")


@query("inner_join_distinct", """
SELECT DISTINCT c_custkey, c_name FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F'""")
def _(t: Inputs):
    orders = t.supplied("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
    return jo.exists_in(t.supplied("customer").select("c_custkey", "c_name"), orders, ["c_custkey"], F.col("o_orderstatus") == "F")


@query("inner_join_gold", """
SELECT f.site, f.unit, f.date, f.overtime_hours_sum, q.visits_total FROM gold_er_finance_daily f
JOIN gold_er_quality_daily q ON f.site = q.site AND f.unit = q.unit AND f.date = q.date""")
def _(t: Inputs):
    return jo.join_daily(t.finance, t.quality).select("site", "unit", "date", "overtime_hours_sum", "visits_total")


@query("left_join_fanout", """
SELECT p.p_partkey, s.lines FROM part p
LEFT JOIN (SELECT l_partkey, l_returnflag, count(*) AS lines FROM lineitem GROUP BY ALL) s ON s.l_partkey = p.p_partkey""")
def _(t: Inputs):
    counts = ag.count_by(t.supplied("lineitem"), {"p_partkey": "l_partkey", "flag": "l_returnflag"}, "lines")
    return jo.left_enrich(t.supplied("part").select("p_partkey"), counts, ["p_partkey"], ["lines"])


@query("vocab_map_join", """
SELECT a.concept_code AS source_code, a.concept_name AS source_name, b.concept_id AS standard_concept_id, b.concept_name AS standard_name
FROM concept a JOIN concept_relationship r ON a.concept_id = r.concept_id_1 JOIN concept b ON r.concept_id_2 = b.concept_id
WHERE a.vocabulary_id = 'ICD10CM' AND r.relationship_id = 'Maps to' AND b.standard_concept = 'S' AND b.vocabulary_id = 'RxNorm'""")
def _(t: Inputs):
    return vocabulary.map_concepts(t.raw("concept"), t.raw("concept_relationship"), "ICD10CM", "RxNorm")


# ---- aggregates -----------------------------------------------------------


@query("agg_count", "SELECT CAST(ts AS DATE) AS day, CAST(hour(ts) AS INT) AS h, count(*) AS n FROM events GROUP BY ALL")
def _(t: Inputs):
    return ag.count_by(t.supplied("events"), {"day": F.col("ts").cast("date"), "h": F.hour("ts")})


@query("agg_count_if", """
SELECT site, count(*) FILTER (WHERE discharge_disposition = 'LWBS') AS lwbs,
  count(*) FILTER (WHERE visit_duration_minutes > 30) AS long_stays FROM silver_er_visits GROUP BY ALL""")
def _(t: Inputs):
    return t.visits.groupBy("site").agg(
        m.count_if(F.col("discharge_disposition") == "LWBS").alias("lwbs"),
        m.count_if(F.col("visit_duration_minutes") > 30).alias("long_stays"),
    )


@query("agg_sum", "SELECT site, role, sum(overtime_hours) AS overtime, sum(shift_coverage_hours) AS coverage FROM silver_hr_shifts GROUP BY ALL")
def _(t: Inputs):
    return t.shifts.groupBy("site", "role").agg(
        F.sum("overtime_hours").alias("overtime"), F.sum("shift_coverage_hours").alias("coverage")
    )


@query("agg_sum_cond", """
SELECT region, coalesce(sum(estimated_cost_usd) FILTER (WHERE executed_flag), 0) AS executed FROM silver_care_actions GROUP BY ALL""")
def _(t: Inputs):
    return t.actions.groupBy("region").agg(m.sum_if(F.col("executed_flag"), "estimated_cost_usd").alias("executed"))


@query("agg_avg", "SELECT site, unit, avg(overall_score) AS score, avg(cleanliness) AS clean FROM silver_surveys GROUP BY ALL", "score clean")
def _(t: Inputs):
    return t.surveys.groupBy("site", "unit").agg(F.avg("overall_score").alias("score"), F.avg("cleanliness").alias("clean"))


@query("agg_rate", f"""
SELECT site, role, {share('sick_leave_flag')} AS sick, {share('attended_flag')} AS attended FROM silver_hr_shifts GROUP BY ALL""", "sick attended")
def _(t: Inputs):
    return t.shifts.groupBy("site", "role").agg(
        m.rate(F.col("sick_leave_flag")).alias("sick"), m.rate(F.col("attended_flag")).alias("attended")
    )


@query("agg_any", """
SELECT patient_id, date, max(CASE WHEN device_type = 'bp' AND valid_flag THEN 1 ELSE 0 END) AS has_bp FROM silver_device_readings GROUP BY ALL""")
def _(t: Inputs):
    return t.readings.groupBy("patient_id", "date").agg(
        m.any_flag((F.col("device_type") == "bp") & F.col("valid_flag")).alias("has_bp")
    )


@query("agg_median", f"""
SELECT site, date, {median('triage_wait_minutes')} AS triage, {median('queue_length')} AS queue FROM flow_rows GROUP BY ALL""")
def _(t: Inputs):
    return ag.exact_quantiles(t.flow, ["site", "date"], {"triage": "triage_wait_minutes", "queue": "queue_length"})


@query("agg_ratio", f"""
SELECT o_custkey, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0 END) AS finished,
  count(*) FILTER (WHERE o_orderstatus = 'F') / CAST(nullif(count(*) FILTER (WHERE o_orderpriority = '1-URGENT'), 0) AS DOUBLE) AS per_urgent
FROM orders GROUP BY ALL""", "finished per_urgent")
def _(t: Inputs):
    done, urgent = m.count_if(F.col("o_orderstatus") == "F"), m.count_if(F.col("o_orderpriority") == "1-URGENT")
    return t.supplied("orders").groupBy("o_custkey").agg(
        m.ratio(done, F.count(F.lit(1))).alias("finished"), m.ratio(done, urgent).alias("per_urgent")
    )


@query("agg_min_max_global", "SELECT min(l_shipdate) AS lo, max(l_shipdate) AS hi FROM lineitem")
def _(t: Inputs):
    return ag.bounds(t.supplied("lineitem"), "l_shipdate")


@query("agg_count_distinct_rows", "SELECT count(*) AS pairs FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) d")
def _(t: Inputs):
    return ag.distinct_count(t.supplied("lineitem"), ["l_partkey", "l_suppkey"], "pairs")


@query("agg_reaggregate", """
SELECT CAST(date_trunc('week', date) AS TIMESTAMP) AS week_start, site, avg(visits_total) AS mean_visits,
  CAST(sum(visits_total) AS BIGINT) AS visits FROM gold_er_quality_daily GROUP BY ALL""", "mean_visits")
def _(t: Inputs):
    aggs = {"mean_visits": F.avg("visits_total"), "visits": F.sum("visits_total")}
    return ag.roll_up(t.quality, "date", "WEEK", ["site"], aggs, "week_start")


@query("agg_max_of_running", """
SELECT site, max(cumulative_reimbursement_at_risk_usd) AS top FROM gold_er_finance_daily GROUP BY ALL""", "top")
def _(t: Inputs):
    return t.finance.groupBy("site").agg(F.max("cumulative_reimbursement_at_risk_usd").alias("top"))


# ---- windows --------------------------------------------------------------


@query("win_median_partition", "SELECT flow_id, queue_length, queue_length_median_15min AS hour_median FROM silver_patient_flow")
def _(t: Inputs):
    return wn.with_partition_median(t.flow, "queue_length", ["site", "date", "hour_of_day"], "hour_median").select(
        "flow_id", "queue_length", "hour_median"
    )


@query("win_running_sum", """
SELECT date, region, n, CAST(sum(n) OVER (PARTITION BY region ORDER BY date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS so_far
FROM (SELECT date, region, count(*) AS n FROM silver_device_readings GROUP BY ALL) daily""")
def _(t: Inputs):
    daily = ag.count_by(t.readings, {"date": "date", "region": "region"})
    return wn.running_sum(daily, "n", ["region"], ["date"], "so_far")


@query("win_lag_k", """
SELECT date, region, device_type, lag(valid_rate, 7) OVER (PARTITION BY region, device_type ORDER BY date) AS week_ago
FROM gold_device_ingestion""", "week_ago")
def _(t: Inputs):
    out = wn.lag_k(t.ingestion, "valid_rate", 7, ["region", "device_type"], ["date"], "week_ago")
    return out.select("date", "region", "device_type", "week_ago")


@query("win_delta_lag", """
SELECT date, region, device_type, valid_rate - lag(valid_rate, 7) OVER (PARTITION BY region, device_type ORDER BY date) AS delta
FROM gold_device_ingestion""", "delta")
def _(t: Inputs):
    out = wn.delta_vs_lag(t.ingestion, "valid_rate", 7, ["region", "device_type"], ["date"], "week_ago", "delta")
    return out.select("date", "region", "device_type", "delta")


_LINES = "PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"
_LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query("win_prefix_sum", f"""
SELECT l_orderkey, l_linenumber, l_returnflag, sum(l_quantity) OVER ({_LINES} ROWS UNBOUNDED PRECEDING) AS so_far FROM lineitem""", "so_far")
def _(t: Inputs):
    """Three partitions that grow with the table, each spread over blocks."""
    out = sc.prefix_sum(t.supplied("lineitem"), "l_quantity", ["l_returnflag"], _LINE_ORDER, "so_far")
    return out.select("l_orderkey", "l_linenumber", "l_returnflag", "so_far")


@query("win_lag_rows", f"""
SELECT l_orderkey, l_linenumber, l_returnflag, lag(l_extendedprice, 3) OVER ({_LINES}) AS third_before FROM lineitem""", "third_before")
def _(t: Inputs):
    out = sc.lag_rows(t.supplied("lineitem"), "l_extendedprice", 3, ["l_returnflag"], _LINE_ORDER, "third_before")
    return out.select("l_orderkey", "l_linenumber", "l_returnflag", "third_before")


_DAILY = "SELECT date, region, device_type, count(*) AS n FROM silver_device_readings GROUP BY ALL"


@query("win_lag_days", f"""
WITH daily AS ({_DAILY})
SELECT a.date AS date, a.region AS region, a.device_type AS device_type, a.n AS n, b.n AS week_ago FROM daily a
LEFT JOIN daily b ON b.region IS NOT DISTINCT FROM a.region AND b.device_type IS NOT DISTINCT FROM a.device_type AND b.date = a.date - 7""")
def _(t: Inputs):
    """A sparse table: the row 7 rows back need not be 7 days back."""
    daily = ag.count_by(t.readings, {"date": "date", "region": "region", "device_type": "device_type"})
    return sc.lag_days(daily, "n", 7, ["region", "device_type"], "date", "week_ago")


@query("win_lag_density", f"""
WITH daily AS ({_DAILY})
SELECT region, device_type, count(*) AS rows, count(*) AS days, CAST(max(date) - min(date) AS BIGINT) + 1 - count(*) AS missing_days,
  CAST(0 AS BIGINT) AS repeated_days, max(date) - min(date) + 1 = count(*) AS dense FROM daily GROUP BY ALL""")
def _(t: Inputs):
    daily = ag.count_by(t.readings, {"date": "date", "region": "region", "device_type": "device_type"})
    return sc.density(daily, ["region", "device_type"], "date")


# ---- order and top-k ------------------------------------------------------


@query("sort_multi", "SELECT p_partkey, p_type, p_retailprice FROM part ORDER BY p_type, p_retailprice DESC, p_partkey")
def _(t: Inputs):
    return rk.sort_by(
        t.supplied("part").select("p_partkey", "p_type", "p_retailprice"),
        [("p_type", True), ("p_retailprice", False), ("p_partkey", True)],
    )


@query("topk_global", f"""
SELECT site, date, is_weekend, visits_total, lwbs_rate, median_triage_wait_minutes, median_door_to_provider_minutes
FROM gold_er_quality_daily WHERE date BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}'
ORDER BY lwbs_rate DESC, date, site, unit, is_weekend LIMIT 10""", "lwbs_rate")
def _(t: Inputs):
    return se.er_top10_lwbs(t.quality, 10, JANUARY)


@query("limit_lookup", "SELECT * FROM customer WHERE c_custkey = 77 LIMIT 1")
def _(t: Inputs):
    return rk.lookup(t.supplied("customer"), "c_custkey", 77)


# ---- sets -----------------------------------------------------------------


@query("union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def _(t: Inputs):
    return sets.union_distinct(
        t.supplied("customer").select(F.col("c_nationkey").alias("nation")),
        t.supplied("supplier").select(F.col("s_nationkey").alias("nation")),
    )


@query("union_all_bridge", """
SELECT o_orderdate AS date, CAST(NULL AS VARCHAR) AS region, 'status' AS field_name, o_orderstatus AS field_value FROM orders
UNION ALL SELECT o_orderdate, o_orderstatus, 'priority', o_orderpriority FROM orders
UNION ALL SELECT CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP), NULL, 'flag', l_returnflag FROM lineitem""")
def _(t: Inputs):
    ordered, status = F.col("o_orderdate"), F.col("o_orderstatus")
    return sets.filter_bridge([
        (t.supplied("orders"), {"status": (ordered, None, status), "priority": (ordered, status, F.col("o_orderpriority"))}),
        (t.supplied("lineitem"), {"flag": (F.col("l_shipdate").cast("date"), None, F.col("l_returnflag"))}),
    ])


@query("distinct_rows", "SELECT DISTINCT site, unit FROM silver_er_visits")
def _(t: Inputs):
    return sets.distinct_on(t.visits, ["site", "unit"])
