"""Materialised runs over the supplied tables, and the shape of the plans."""

import re
import uuid

import pytest

from carepulse.registry import QUERIES
from __spark_entry__ import queries
from carepulse.plans.pipeline import Step, cc_steps, er_steps, feed_states, materialise, one_schema, schema_per_layer
from carepulse.session import passing_folders, shared_dir
from carepulse.sources.files import stored
from carepulse.registry.inputs import FIRST_DAY, LAST_DAY, WEIGHTS, Inputs
from carepulse.sources.schemas import CC_RAW, ER_RAW, read_raw
from carepulse.sources.tables import get_comment, table_versions
from helpers import plan_of, rows


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    return Inputs(spark, sf_dir)


@pytest.fixture(scope="module")
def prefix():
    return f"run_{uuid.uuid4().hex[:6]}_"


def test_er_run_equals_the_lazy_tables(spark, inputs, prefix, tmp_path_factory):
    steps = er_steps()
    feeds = ["raw_er_visits", "raw_hr_shifts", "raw_patient_flow", "raw_surveys", "raw_readmission_risk"]
    raw = {name: inputs.raw(feed) for name, feed in zip(ER_RAW, feeds)}
    out = materialise(raw, steps, one_schema(f"{prefix}er"), str(tmp_path_factory.mktemp("er")))
    assert list(out) == list(steps)
    assert rows(out["gold_er_operational_hourly"]) == rows(inputs.hourly)
    assert rows(out["gold_er_quality_daily"]) == rows(inputs.quality)
    assert rows(out["gold_er_staffing_daily"]) == rows(inputs.staffing)
    assert get_comment(spark, f"{prefix}er", "gold_er_finance_daily") == steps["gold_er_finance_daily"].comment
    # known table size: the medians are broadcast and the telemetry rows are not shuffled
    flow = steps["silver_patient_flow_metrics"].build({**out, **raw})
    assert "BroadcastHashJoin" in plan_of(flow) and "hashpartitioning" not in plan_of(flow)
    # partitioned silver: a date filter prunes directories
    assert re.search(r"PartitionFilters: \[[^\]]*arrival_date", plan_of(out["silver_emr_er_visits"].where("arrival_date = DATE '2024-01-05'")))


def test_cc_run_equals_the_lazy_tables(spark, inputs, prefix, tmp_path_factory):
    steps = cc_steps(spark, FIRST_DAY, LAST_DAY, WEIGHTS)
    out = materialise({n: inputs.raw(n) for n in CC_RAW}, steps, schema_per_layer(prefix), str(tmp_path_factory.mktemp("cc")))
    assert list(out) == list(steps)
    assert rows(out["gold_root_cause_alignment"]) == rows(inputs.alignment)
    risk = {tuple(r)[:4]: tuple(r)[4:] for r in out["gold_patient_risk_timeseries"].collect()}
    for r in inputs.patient_risk.collect():
        assert risk[tuple(r)[:4]] == (pytest.approx(r["avg_risk_score"]), r["patient_days"])
    assert out["gold_counter_active_patients"].count() == 1
    assert spark.table(f"{prefix}gold.gold_global_filters_bridge").count() > 0


def test_run_goes_on_where_it_failed_and_rebuilds_what_changed(spark, prefix, tmp_path):
    broken = {"b"}
    feeds = {n: str(tmp_path / n) for n in ("raw_x", "raw_y")}
    for n, path in feeds.items():
        spark.range(5).write.parquet(path)

    def step(name, *sources):
        def build(t):
            df = t[sources[0]].select("id")
            for s in sources[1:]:
                df = df.union(t[s].select("id"))
            return df.selectExpr("CAST(id AS STRING) || 'x' AS s", "CAST(CAST(id AS STRING) || 'x' AS INT) AS id") if name in broken else df
        return Step(build, f"table {name}")

    steps = {"a": step("a", "raw_x"), "b": step("b", "a", "raw_y"), "c": step("c", "raw_x"), "d": step("d", "b")}

    def run(release=""):
        raw = {n: spark.read.parquet(path) for n, path in feeds.items()}
        before = versions()
        out = materialise(raw, steps, one_schema(f"{prefix}go"), str(tmp_path / "out"), feed_states(spark, feeds), release)
        after = versions()
        return out, {n for n in steps if before.get(n) != after[n]}

    def versions():
        found = {n: table_versions(spark, f"{prefix}go", n, str(tmp_path / "out")).current() for n in steps}
        return {n: v.name for n, v in found.items() if v}

    with pytest.raises(Exception):
        run()
    assert set(versions()) == {"a"}
    broken.clear()
    assert run()[1] == {"b", "c", "d"}  # a was complete
    assert run()[1] == set()
    spark.range(2).write.mode("append").parquet(feeds["raw_y"])
    out, new = run()
    assert new == {"b", "d"} and out["d"].count() == 12 and out["a"].count() == 5
    assert run("next release")[1] == set(steps)
    spark.sql(f"DROP VIEW {prefix}go.c")
    assert run("next release")[1] == {"c"}


def test_intermediate_folders_go(spark, tmp_path):
    import os
    kept = shared_dir(spark, "kept")
    with pytest.raises(ZeroDivisionError), passing_folders(spark):
        inner = shared_dir(spark, "inner")
        assert stored(spark.range(3), inner).count() == 3 and os.path.exists(inner.removeprefix("file:"))
        stored(spark.range(3), kept)
        1 / 0
    assert not os.path.exists(inner.removeprefix("file:")) and spark.read.parquet(kept).count() == 3


@pytest.mark.parametrize("key", [k for k in QUERIES if not k.startswith(("st", "incremental", "full_refresh"))])
def test_no_cross_join_and_no_python_in_any_plan(spark, sf_dir, key):
    plan = plan_of(queries()[key](spark, sf_dir))
    for node in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups", "SortAggregate"):
        assert node not in plan


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(queries()["filter_eq_in_between"](spark, sf_dir))
    pushed = re.search(r"PushedFilters: \[(.*)\], ReadSchema", plan).group(1)
    for part in ("Not(EqualTo(o_orderstatus,P))", "In(o_orderpriority", "GreaterThanOrEqual(o_totalprice", "LessThan(o_orderdate"):
        assert part in pushed
    plan = plan_of(queries()["agg_count_distinct_rows"](spark, sf_dir))
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint>" in plan


def test_shuffled_joins_give_the_same_rows(spark, sf_dir):
    """Beyond the broadcast limit the same results come from shuffled joins."""
    keys = ["silver_surveys", "gold_er_operational_hourly", "gold_patient_risk_daily", "gold_root_cause_alignment", "dq_interval_order"]
    broadcast = {k: rows(queries()[k](spark, sf_dir)) for k in keys}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for k in keys:
            shuffled = queries()[k](spark, sf_dir)
            assert "NestedLoop" not in plan_of(shuffled) and "Cartesian" not in plan_of(shuffled)
            assert rows(shuffled) == broadcast[k], k
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_declared_raw_schemas_feed_every_table(spark, tmp_path):
    """Raw files written with the declared schemas run through both pipelines."""
    for name, schema in {**ER_RAW, **CC_RAW}.items():
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / "raw" / name))
    er = read_raw(spark, str(tmp_path / "raw"), ER_RAW)
    cc = read_raw(spark, str(tmp_path / "raw"), CC_RAW)
    db = f"empty_{uuid.uuid4().hex[:6]}"
    done = materialise(er, er_steps(), one_schema(db), str(tmp_path / "out"))
    done |= materialise(cc, cc_steps(spark, "2025-08-01", "2025-11-10"), schema_per_layer(f"{db}_"), str(tmp_path / "out"))
    assert {n: df.count() for n, df in done.items() if df.count()} == {
        "gold_date_spine": 102, "gold_counter_active_patients": 1, "gold_counter_valid_readings_last7": 1,
        "gold_counter_avg_daily_risk_high_last7": 1, "gold_counter_care_actions_executed_last14": 1,
    }
