"""Declared schemas and the column bundle every operator works on.

All tables are regular time series keyed by (time, country, zone). Operators
take a :class:`SeriesSpec` so that the same code serves load observations,
daily order series and XML-derived points.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

from loadlens.fixed import DEFAULT_SOURCE, ERROR_MESSAGE_MAX, RUN_STATUSES  # noqa: F401

# Default labels of this package's own pipeline (parameters, not fixed values).
PIPELINE_NAME = "load_batch_ingestion"
SOURCE_NAME = "actual_total_load"


@dataclass(frozen=True)
class SeriesSpec:
    """Column names and grain of one regular series.

    ``step`` is a Spark interval literal body such as ``"1 hour"`` or
    ``"1 day"``; ``step_seconds`` must agree with it.
    """

    time: str = "time_utc"
    keys: tuple[str, ...] = ("country_code", "bidding_zone")
    value: str = "load_mw"
    source: str = "source"
    ingested_at: str = "ingested_at"
    step: str = "1 hour"
    step_seconds: int = 3600

    def with_step(self, step: str, step_seconds: int) -> "SeriesSpec":
        return replace(self, step=step, step_seconds=step_seconds)

    @property
    def key_time(self) -> list[str]:
        return [self.time, *self.keys]


HOURLY = SeriesSpec()
DAILY = SeriesSpec(step="1 day", step_seconds=86400)


def _f(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


TS = T.TimestampNTZType()
TSZ = T.TimestampType()

RAW_SCHEMA = T.StructType([
    _f("time_utc", TS, False),
    _f("country_code", T.StringType(), False),
    _f("bidding_zone", T.StringType(), False),
    _f("load_mw", T.DoubleType(), False),
    _f("source", T.StringType()),
    _f("ingested_at", TS),
])

CLEAN_SCHEMA = RAW_SCHEMA

RUN_LEDGER_SCHEMA = T.StructType([
    _f("run_id", T.StringType(), False),
    _f("pipeline_name", T.StringType(), False),
    _f("source_name", T.StringType(), False),
    _f("country_code", T.StringType(), False),
    _f("bidding_zone", T.StringType(), False),
    _f("requested_start_utc", TS, False),
    _f("requested_end_utc", TS, False),
    _f("started_at_utc", TS, False),
    _f("finished_at_utc", TS),
    _f("status", T.StringType(), False),
    _f("rows_seen", T.IntegerType(), False),
    _f("rows_inserted", T.IntegerType(), False),
    _f("min_event_time_utc", TS),
    _f("max_event_time_utc", TS),
    _f("resolution_detected", T.StringType()),
    _f("source_timeseries_count", T.IntegerType()),
    _f("error_message", T.StringType()),
])

# Append-only ledger: one row per state change, ``event_seq`` orders them.
RUN_EVENT_SCHEMA = T.StructType([*RUN_LEDGER_SCHEMA.fields, _f("event_seq", T.IntegerType(), False)])

STATE_SCHEMA = T.StructType([
    _f("pipeline_name", T.StringType(), False),
    _f("country_code", T.StringType(), False),
    _f("bidding_zone", T.StringType(), False),
    _f("last_ingested_at_utc", TS, False),
    _f("updated_at_utc", TS, False),
])

# Market document read schema (rowTag = TimeSeries). Names are local names;
# read with ignoreNamespace so both default-namespace and prefixed documents work.
# Point values are read as text and parsed by the flatten step, which fails the
# run on a malformed number (the XML reader's number parsing is lenient: "1x0" -> 1).
POINT_SCHEMA = T.StructType([_f("position", T.StringType()), _f("quantity", T.StringType())])
PERIOD_SCHEMA = T.StructType([
    _f("timeInterval", T.StructType([_f("start", T.StringType()), _f("end", T.StringType())])),
    _f("resolution", T.StringType()),
    _f("Point", T.ArrayType(POINT_SCHEMA)),
])
TIMESERIES_SCHEMA = T.StructType([
    _f("mRID", T.StringType()),
    _f("Period", T.ArrayType(PERIOD_SCHEMA)),
])


# Published schemas (declared column order and type per object).
def _schema(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([_f(n, t) for n, t in cols])


S, D, L, I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
DATE = T.DateType()

PUBLISH_SCHEMAS: dict[str, T.StructType] = {
    "energy_load_raw": RAW_SCHEMA,
    "energy_load_clean": CLEAN_SCHEMA,
    "pipeline_runs": _schema(
        ("run_id", S), ("pipeline_name", S), ("source_name", S), ("country_code", S),
        ("bidding_zone", S), ("requested_start_utc", TS), ("requested_end_utc", TS),
        ("started_at_utc", TS), ("finished_at_utc", TS), ("status", S), ("rows_seen", L),
        ("rows_inserted", L), ("min_event_time_utc", TS), ("max_event_time_utc", TS),
        ("resolution_detected", S), ("source_timeseries_count", L), ("error_message", S)),
    "pipeline_state": _schema(
        ("pipeline_name", S), ("country_code", S), ("bidding_zone", S),
        ("last_ingested_at_utc", TS), ("updated_at_utc", TS)),
    "dq_time_gaps": _schema(
        ("country_code", S), ("bidding_zone", S), ("previous_time", TS), ("time_utc", TS),
        ("gap_interval", S)),
    "dq_missing_hours": _schema(("country_code", S), ("bidding_zone", S), ("missing_time", TS)),
    "dq_invalid_loads": _schema(
        ("country_code", S), ("bidding_zone", S), ("time_utc", TS), ("load_mw", D)),
    "dq_pipeline_status": _schema(
        ("raw_rows", L), ("clean_rows", L), ("missing_hours", L), ("time_gaps", L),
        ("invalid_loads", L), ("pipeline_status", S)),
    "dq_reconciliation_summary": _schema(
        ("expected_hours", L), ("actual_hours", L), ("missing_hours", L), ("duplicate_rows", L),
        ("last_run_id", S), ("last_run_started_at", TS), ("last_run_finished_at", TS)),
    "dq_assertions": _schema(
        ("assertion_name", S), ("status", S), ("observed_value", L), ("rule", S)),
    "daily_load_summary": _schema(
        ("country_code", S), ("bidding_zone", S), ("load_date", DATE), ("avg_load_mw", D),
        ("peak_load_mw", D), ("min_load_mw", D), ("hourly_points", L)),
    "hourly_load_anomalies": _schema(
        ("country_code", S), ("bidding_zone", S), ("time_utc", TS), ("load_date", DATE),
        ("load_mw", D), ("daily_avg_load_mw", D), ("pct_deviation", D), ("anomaly_type", S)),
    "daily_load_curve_profile": _schema(
        ("country_code", S), ("bidding_zone", S), ("hour_of_day", D),
        ("avg_hourly_load_mw", D), ("min_hourly_load_mw", D), ("max_hourly_load_mw", D),
        ("observation_count", L)),
    "mart_energy_system_metrics": _schema(
        ("avg_hourly_load_mw", D), ("max_hourly_load_mw", D), ("min_hourly_load_mw", D),
        ("peak_time_utc", TS), ("peak_load_mw", D), ("max_avg_daily_load_mw", D),
        ("min_avg_daily_load_mw", D), ("winter_peak_load_mw", D), ("summer_peak_load_mw", D),
        ("avg_midnight_load_mw", D), ("avg_morning_load_mw", D), ("avg_evening_load_mw", D)),
    "mart_energy_system_metrics_long": _schema(("metric", S), ("value", S)),
}

# Presentation order applied at publish time only (never inside operators).
PUBLISH_ORDER: dict[str, list[str]] = {
    "energy_load_raw": ["time_utc"],
    "energy_load_clean": ["time_utc"],
    "pipeline_runs": ["started_at_utc"],
    "pipeline_state": ["updated_at_utc"],
    "dq_time_gaps": ["time_utc"],
    "dq_missing_hours": ["missing_time"],
    "dq_invalid_loads": ["time_utc"],
    "dq_assertions": ["assertion_name"],
    "daily_load_summary": ["load_date"],
    "hourly_load_anomalies": ["time_utc"],
    "daily_load_curve_profile": ["hour_of_day"],
    "mart_energy_system_metrics_long": ["metric"],
}
