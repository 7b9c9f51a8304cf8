"""Raw, silver and gold tables over one folder of supplied tables, built lazily."""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans import cc, er
from ..plans.serving_er import Period
from ..session import apply_settings, folder_state, shared_dir
from ..sources.files import scan_parquet
from .bindings import BINDINGS

#: The days the supplied event table covers, and an incident window inside them.
FIRST_DAY, LAST_DAY = "2024-01-01", "2024-01-30"
JANUARY = Period(FIRST_DAY, LAST_DAY)
MID_MONTH = Period("2024-01-08", "2024-01-25")
WEIGHTS = cc.RiskWeights(incident_start="2024-01-10", incident_end="2024-01-20")
AS_OF = "2024-01-31 00:00:00"

_DATED = ("quality", "hourly", "finance", "staffing", "readmission", "ingestion", "patient_risk", "bp_quality", "encounter_signals")
_SERVED: dict[tuple[str, str, str, str], tuple[str, T.StructType]] = {}


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = apply_settings(spark)
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}

    def supplied(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = scan_parquet(self.spark, f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def raw(self, name: str) -> DataFrame:
        """A supplied table in the shape of a raw feed."""
        if name not in self._tables:
            text = BINDINGS[name]
            used = {t: self.supplied(t) for t in re.findall(r"{(\w+)}", text)}
            self._tables[name] = self.spark.sql(text, **used)
        return self._tables[name]

    # emergency room
    @cached_property
    def visits(self) -> DataFrame:
        return er.silver_er_visits(self.raw("raw_er_visits"))

    @cached_property
    def shifts(self) -> DataFrame:
        return er.silver_hr_shifts(self.raw("raw_hr_shifts"))

    @cached_property
    def flow(self) -> DataFrame:
        """Flow rows without the smoothing join, which no gold table needs."""
        return er.clean_patient_flow(self.raw("raw_patient_flow"))

    @cached_property
    def surveys(self) -> DataFrame:
        return er.silver_surveys(self.raw("raw_surveys"), self.visits)

    @cached_property
    def risk_feed(self) -> DataFrame:
        return er.silver_readmission_risk(self.raw("raw_readmission_risk"), self.visits)

    @cached_property
    def hourly(self) -> DataFrame:
        return er.gold_er_operational_hourly(self.visits, self.flow, self.shifts)

    @cached_property
    def quality(self) -> DataFrame:
        return er.gold_er_quality_daily(self.visits, self.flow, self.surveys)

    @cached_property
    def finance(self) -> DataFrame:
        return er.gold_er_finance_daily(self.shifts, self.visits, self.quality)

    @cached_property
    def staffing(self) -> DataFrame:
        return er.gold_er_staffing_daily(self.shifts, self.hourly)

    @cached_property
    def readmission(self) -> DataFrame:
        return er.gold_er_readmission_daily(self.risk_feed, self.visits)

    # chronic care
    @cached_property
    def patients(self) -> DataFrame:
        return cc.silver_patient_master(self.raw("raw_patient_master"))

    @cached_property
    def readings(self) -> DataFrame:
        return cc.silver_device_readings(self.raw("raw_device_readings"))

    @cached_property
    def notes(self) -> DataFrame:
        return cc.silver_encounter_notes(self.raw("raw_encounter_notes"))

    @cached_property
    def changes(self) -> DataFrame:
        return cc.silver_device_change_log(self.raw("raw_device_change_log"))

    @cached_property
    def actions(self) -> DataFrame:
        return cc.silver_care_actions(self.raw("raw_care_actions"), self.patients)

    @cached_property
    def calendar(self) -> DataFrame:
        return cc.gold_date_spine(self.spark, FIRST_DAY, LAST_DAY)

    @cached_property
    def ingestion(self) -> DataFrame:
        return cc.gold_device_ingestion(self.readings, self.calendar, self.patients)

    @cached_property
    def patient_risk(self) -> DataFrame:
        return cc.gold_patient_risk_daily(self.calendar, self.patients, self.readings, self.notes, WEIGHTS)

    @cached_property
    def actions_weekly(self) -> DataFrame:
        return cc.gold_care_actions_weekly(self.actions)

    @cached_property
    def alignment(self) -> DataFrame:
        return cc.gold_root_cause_alignment(self.ingestion, self.changes, self.readings)

    @cached_property
    def bp_quality(self) -> DataFrame:
        return cc.gold_bp_quality(self.readings)

    @cached_property
    def risk_weekly(self) -> DataFrame:
        return cc.gold_patient_risk_weekly(self.served("patient_risk"))

    @cached_property
    def cumulative_cost(self) -> DataFrame:
        return cc.gold_cumulative_care_cost(self.actions)

    @cached_property
    def encounter_signals(self) -> DataFrame:
        return cc.gold_encounter_signals(self.notes)

    @cached_property
    def state(self) -> str:
        return folder_state(self.spark, self.sf_dir)

    def served_path(self, name: str) -> str:
        self.served(name)
        return _SERVED[self.spark.sparkContext.applicationId, self.sf_dir, self.state, name][0]

    def served(self, name: str) -> DataFrame:
        """The table as reports find it: stored, gold tables with a folder for each date.

        The query store_reports stores them, or else the first report that asks; then they are read from
        there, so that a report's period is a partition filter. When a supplied file has changed they are stored anew.
        """
        key = self.spark.sparkContext.applicationId, self.sf_dir, self.state, name
        if key not in _SERVED:
            table, path = getattr(self, name), shared_dir(self.spark, f"served-{name}")
            by = ["date"] if name in _DATED else []
            (table.repartition(*by) if by else table).write.partitionBy(*by).parquet(path)
            _SERVED[key] = path, table.schema
        path, schema = _SERVED[key]
        return self.spark.read.schema(schema).parquet(path).select(*schema.names)
