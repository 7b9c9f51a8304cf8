"""Materialised runs: every table is written once and read back by the next ones.

Tables keep the names and columns that existing SQL over them uses.

Reading tables back keeps each plan short, lets later tables prune columns and
partitions, and gives the planner real table sizes to choose joins by. A lost
executor costs at most the table in progress.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from . import cc, er
from ..session import folder_state
from ..sources.tables import get_property, replace_table, scan_table, set_property, table_versions


@dataclass(frozen=True)
class Step:
    """One table: how it is built from earlier tables, and how it is stored."""

    build: Callable[[Mapping[str, DataFrame]], DataFrame]
    comment: str
    partition_by: tuple[str, ...] = ()


def er_steps() -> dict[str, Step]:
    return {
        "silver_emr_er_visits": Step(
            lambda t: er.silver_er_visits(t["raw_emr_er_visits"]),
            "Visits with typed times, calendar columns, region and durations.", ("arrival_date",)),
        "silver_hr_shifts_and_sickleave": Step(
            lambda t: er.silver_hr_shifts(t["raw_hr_shifts_and_sickleave"]),
            "Shifts with attendance, sick-leave flag and effective hours.", ("shift_date",)),
        "silver_flow_hour_medians": Step(
            lambda t: er.flow_hour_medians(t["raw_patient_flow_metrics"]), "Median queue length per site and hour."),
        "silver_patient_flow_metrics": Step(
            lambda t: er.silver_patient_flow(t["raw_patient_flow_metrics"], medians=t["silver_flow_hour_medians"]),
            "Flow telemetry with the median queue length of its hour.", ("date",)),
        "silver_patient_satisfaction_surveys": Step(
            lambda t: er.silver_surveys(t["raw_patient_satisfaction_surveys"], t["silver_emr_er_visits"]),
            "Survey scores with date, weekend and region of the visit."),
        "silver_readmission_risk_feed": Step(
            lambda t: er.silver_readmission_risk(t["raw_readmission_risk_feed"], t["silver_emr_er_visits"]),
            "Readmission predictions with the visit's attributes and lag in days."),
        "gold_er_operational_hourly": Step(
            lambda t: er.gold_er_operational_hourly(
                t["silver_emr_er_visits"], t["silver_patient_flow_metrics"], t["silver_hr_shifts_and_sickleave"]),
            "Dense site-hour operations: arrivals, throughput, waits, staffing, ratios.", ("date",)),
        "gold_er_quality_daily": Step(
            lambda t: er.gold_er_quality_daily(
                t["silver_emr_er_visits"], t["silver_patient_flow_metrics"], t["silver_patient_satisfaction_surveys"]),
            "Daily access and satisfaction measures per site.", ("date",)),
        "gold_er_finance_daily": Step(
            lambda t: er.gold_er_finance_daily(
                t["silver_hr_shifts_and_sickleave"], t["silver_emr_er_visits"], t["gold_er_quality_daily"]),
            "Daily overtime, cost and reimbursement at risk with running total.", ("date",)),
        "gold_er_staffing_daily": Step(
            lambda t: er.gold_er_staffing_daily(t["silver_hr_shifts_and_sickleave"], t["gold_er_operational_hourly"]),
            "Daily hours, sick-leave rate and coverage gap by role.", ("date",)),
        "gold_er_readmission_risk_daily": Step(
            lambda t: er.gold_er_readmission_daily(t["silver_readmission_risk_feed"], t["silver_emr_er_visits"]),
            "Daily predicted risk and realised readmissions.", ("date",)),
        "gold_global_filters_bridge": Step(
            lambda t: er.gold_er_filters_bridge(t["silver_emr_er_visits"], t["silver_hr_shifts_and_sickleave"]),
            "Distinct filter values over visits and shifts."),
    }


def cc_steps(spark: SparkSession, start: str, end: str, weights: cc.RiskWeights = cc.RiskWeights()) -> dict[str, Step]:
    return {
        "silver_patient_master": Step(
            lambda t: cc.silver_patient_master(t["raw_patient_master"]), "Patient registry with normalised enums."),
        "silver_device_readings": Step(
            lambda t: cc.silver_device_readings(t["raw_device_readings"]),
            "Device readings with calendar columns and missing-diastolic flag.", ("date",)),
        "silver_encounter_notes": Step(
            lambda t: cc.silver_encounter_notes(t["raw_encounter_notes"]), "Note flags without note text.", ("date",)),
        "silver_medication_lists": Step(
            lambda t: cc.silver_medication_lists(t["raw_medication_lists"]), "Medication snapshots by class."),
        "silver_device_change_log": Step(
            lambda t: cc.silver_device_change_log(t["raw_device_change_log"]), "Dated device changes with scope list."),
        "silver_care_actions": Step(
            lambda t: cc.silver_care_actions(t["raw_care_actions"], t["silver_patient_master"]),
            "Care actions; condition completed from the registry."),
        "gold_date_spine": Step(lambda t: cc.gold_date_spine(spark, start, end), "Daily calendar."),
        "gold_device_ingestion_timeseries": Step(
            lambda t: cc.gold_device_ingestion(
                t["silver_device_readings"], t["gold_date_spine"], t["silver_patient_master"]),
            "Dense daily readings and valid share by region and device.", ("date",)),
        "gold_bp_quality_timeseries": Step(
            lambda t: cc.gold_bp_quality(t["silver_device_readings"]), "Daily missing-diastolic rate by region.", ("date",)),
        "gold_encounter_signal_timeseries": Step(
            lambda t: cc.gold_encounter_signals(t["silver_encounter_notes"]), "Daily note-flag rates by region.", ("date",)),
        "gold_patient_risk_timeseries": Step(
            lambda t: cc.gold_patient_risk_daily(
                t["gold_date_spine"], t["silver_patient_master"], t["silver_device_readings"],
                t["silver_encounter_notes"], weights),
            "Mean patient-day risk score by region, tier and condition.", ("date",)),
        "gold_patient_risk_weekly": Step(
            lambda t: cc.gold_patient_risk_weekly(t["gold_patient_risk_timeseries"]), "Weekly mean of daily risk means."),
        "gold_care_actions_weekly": Step(
            lambda t: cc.gold_care_actions_weekly(t["silver_care_actions"]), "Weekly action mix, execution and cost."),
        "gold_cumulative_care_cost": Step(
            lambda t: cc.gold_cumulative_care_cost(t["silver_care_actions"]), "Executed cost and running total."),
        "gold_root_cause_alignment": Step(
            lambda t: cc.gold_root_cause_alignment(
                t["gold_device_ingestion_timeseries"], t["silver_device_change_log"], t["silver_device_readings"]),
            "Ingestion shifts beside device changes and error counts."),
        "gold_global_filters_bridge": Step(
            lambda t: cc.gold_cc_filters_bridge(
                t["gold_device_ingestion_timeseries"], t["gold_patient_risk_timeseries"], t["gold_care_actions_weekly"]),
            "Filter values seen in the gold tables."),
        "gold_counter_active_patients": Step(
            lambda t: cc.counter_active_patients(
                t["silver_patient_master"], t["silver_device_readings"], t["gold_date_spine"]),
            "Active patients with a reading in the trailing 30 days."),
        "gold_counter_valid_readings_last7": Step(
            lambda t: cc.counter_valid_readings_7d(t["silver_device_readings"], t["gold_date_spine"]),
            "Valid readings in the trailing 7 days."),
        "gold_counter_avg_daily_risk_high_last7": Step(
            lambda t: cc.counter_high_risk_avg_7d(t["gold_patient_risk_timeseries"]),
            "Mean high-tier score over the trailing 7 days."),
        "gold_counter_care_actions_executed_last14": Step(
            lambda t: cc.counter_actions_executed_14d(t["silver_care_actions"], t["gold_date_spine"]),
            "Executed actions in the trailing 14 days."),
    }


def one_schema(db: str) -> Callable[[str], str]:
    """All tables in one database, told apart by their name prefix."""
    return lambda name: db


def schema_per_layer(prefix: str = "") -> Callable[[str], str]:
    """One database per layer: silver and gold."""
    return lambda name: f"{prefix}{name.split('_', 1)[0]}"


#: Property of a table that says what it was built from.
BUILT_FROM = "carepulse.built_from"


class _Noted(Mapping[str, DataFrame]):
    """Tables that remember which of them were looked up."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables, self.used = tables, set()

    def __getitem__(self, name: str) -> DataFrame:
        self.used.add(name)
        return self.tables[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.tables)

    def __len__(self) -> int:
        return len(self.tables)


def feed_states(spark: SparkSession, folders: Mapping[str, str]) -> dict[str, str]:
    """For each raw feed a digest of its files' names, sizes and times (classic sessions only)."""
    return {name: folder_state(spark, path) for name, path in folders.items()}


def materialise(raw: Mapping[str, DataFrame], steps: Mapping[str, Step], db_of: Callable[[str], str],
                root: str | None = None, states: Mapping[str, str] | None = None, release: str = "") -> dict[str, DataFrame]:
    """Write the tables in order and return them for reading.

    ``db_of`` gives the database of a table; ``root`` is a shared folder for
    the files (without it the warehouse keeps them).

    With ``states``, a text for each raw feed that changes whenever its rows do
    (:func:`feed_states`), a table is left as it is if the feeds and the versions of the tables that it is built from are those of its last
    complete build: a run that failed goes on at the table it failed at, and a feed that has changed
    rebuilds its own line of tables only. Another ``release`` (of the code, the calendar, the weights: whatever
    steps hold besides tables) rebuilds all. A feed without a state is taken as changed.
    """
    tables = dict(raw)
    known = dict(states or {})
    for name, step in steps.items():
        noted = _Noted(tables)
        df = step.build(noted)
        db, spark = db_of(name), df.sparkSession
        origin = None
        if states is not None and noted.used <= known.keys():
            parts = [release, step.comment, *step.partition_by, *(f"{n}={known[n]}" for n in sorted(noted.used))]
            origin = hashlib.sha256("\n".join(parts).encode()).hexdigest()
        if origin and get_property(spark, db, name, BUILT_FROM) == origin:
            tables[name] = scan_table(spark, db, name)
        else:
            if step.partition_by:
                # one shuffle by date, so a date's rows land in few files instead of one per task;
                # AQE splits a date that is far larger than the rest
                df = df.hint("rebalance", *step.partition_by)
            tables[name] = replace_table(df, db, name, root, step.comment, step.partition_by)
            if origin:  # noted only now: a build that ended before is no build
                set_property(spark, db, name, BUILT_FROM, origin)
        if states is not None:
            known[name] = table_versions(spark, db, name, root).current().name
    return {name: tables[name] for name in steps}
