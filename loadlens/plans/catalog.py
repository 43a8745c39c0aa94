"""Named queries over the driver tables, one per operator of the inventory.

Each entry takes (spark, sf_dir) and returns a lazy DataFrame. Averages use
the exact-decimal mode so results hash equal to the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions.expr import floor_to
from loadlens.operators import analytics, clean as clean_ops, mart, quality, tables
from loadlens.schema import DAILY, HOURLY, PIPELINE_NAME, SOURCE_NAME
from loadlens.sources import testdata as td

EXACT = 6
Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# ------------------------------------------------------------------ inputs

def clean_obs(spark: SparkSession, sf: str) -> DataFrame:
    return clean_ops.clean_series(td.obs(spark, sf), HOURLY, "hour", exact_scale=EXACT)


def daily_obs(spark: SparkSession, sf: str) -> DataFrame:
    return clean_ops.clean_series(td.orders_obs(spark, sf), DAILY, "day", exact_scale=EXACT)


def run_ledger_events(spark: SparkSession, sf: str) -> DataFrame:
    """Open event for every run; close event for runs that ended (one scan of events)."""
    base = td.runs_events(spark, sf, PIPELINE_NAME, SOURCE_NAME)
    ended = F.col("final_status") != "running"
    both = base.withColumn("_seq", F.explode(
        F.when(ended, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    close = F.col("_seq") == 1

    def on_close(c: Column, otherwise=None) -> Column:
        return F.when(close, c) if otherwise is None else F.when(close, c).otherwise(otherwise)

    return tables.run_event(
        both, F.col("_seq"),
        status=on_close(F.col("final_status"), F.lit("running")),
        finished_at_utc=on_close(F.timestamp_add("SECOND", F.col("secs"), F.col("started_at_utc"))),
        rows_seen=on_close(F.col("n_rows"), F.lit(0)),
        rows_inserted=on_close(F.when(F.col("final_status") == "success", F.col("n_rows")).otherwise(0),
                               F.lit(0)),
        min_event_time_utc=on_close(F.col("requested_start_utc")),
        max_event_time_utc=on_close(floor_to(F.col("started_at_utc"), "hour")),
        resolution_detected=on_close(F.lit("PT60M")),
        source_timeseries_count=on_close(F.lit(1)),
        error_message=on_close(F.when(F.col("final_status") == "failed", F.col("props"))),
    )


def ledger(spark: SparkSession, sf: str) -> DataFrame:
    return tables.ledger_latest(run_ledger_events(spark, sf))


# ------------------------------------------------------------------ clean + analytics

@query("clean_hourly")
def q_clean_hourly(spark, sf):
    return clean_obs(spark, sf)


@query("clean_hourly_labelled")
def q_clean_hourly_labelled(spark, sf):
    """G1 with a real, partly null source label (from the event's properties) and null zones."""
    o = td.obs(spark, sf, with_order=True).withColumns({
        "source": F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("src"), (F.col("event_id") % 7).cast("string"))),
        "bidding_zone": F.when(F.col("event_id") % 11 != 0, F.col("bidding_zone"))}).drop("event_id")
    return clean_ops.clean_series(o, HOURLY, "hour", exact_scale=EXACT)


@query("daily_summary")
def q_daily_summary(spark, sf):
    return analytics.daily_summary(clean_obs(spark, sf), exact_scale=EXACT)


@query("fct_daily_summary")
def q_fct_daily_summary(spark, sf):
    """The dbt daily fact over the typed staging view of clean."""
    from loadlens.sources.publish import stg_clean
    return analytics.daily_summary(stg_clean(clean_obs(spark, sf)), exact_scale=EXACT)


@query("daily_baseline")
def q_daily_baseline(spark, sf):
    return analytics.daily_baseline(clean_obs(spark, sf), exact_scale=EXACT)


@query("anomalies")
def q_anomalies(spark, sf):
    return analytics.anomalies(clean_obs(spark, sf), exact_scale=EXACT)


@query("anomalies_vs_baseline")
def q_anomalies_vs_baseline(spark, sf):
    c = clean_obs(spark, sf)
    return analytics.anomalies_vs_baseline(c, analytics.daily_baseline(c, exact_scale=EXACT))


@query("curve_profile")
def q_curve_profile(spark, sf):
    return analytics.curve_profile(clean_obs(spark, sf), exact_scale=EXACT)


@query("zone_metrics")
def q_zone_metrics(spark, sf):
    return analytics.zone_metrics(clean_obs(spark, sf), exact_scale=EXACT)


# ------------------------------------------------------------------ quality

@query("time_gaps")
def q_time_gaps(spark, sf):
    return quality.time_gaps(clean_obs(spark, sf)).drop("gap_interval")


@query("time_gaps_daily")
def q_time_gaps_daily(spark, sf):
    return quality.time_gaps(daily_obs(spark, sf), DAILY).drop("gap_interval")


@query("expected_hours")
def q_expected_hours(spark, sf):
    return quality.expected_spine(clean_obs(spark, sf))


@query("missing_hours")
def q_missing_hours(spark, sf):
    return quality.missing_times(clean_obs(spark, sf))


@query("missing_days")
def q_missing_days(spark, sf):
    return quality.missing_times(daily_obs(spark, sf), DAILY)


@query("invalid_values")
def q_invalid_values(spark, sf):
    return quality.invalid_loads(td.invalid_source(spark, sf))


@query("duplicate_keys")
def q_duplicate_keys(spark, sf):
    return quality.duplicate_key_groups(td.obs_hour(spark, sf))


@query("latest_success")
def q_latest_success(spark, sf):
    return quality.latest_success(ledger(spark, sf))


@query("reconciliation")
def q_reconciliation(spark, sf):
    return quality.reconciliation(clean_obs(spark, sf), td.obs_hour(spark, sf), ledger(spark, sf))


@query("pipeline_status")
def q_pipeline_status(spark, sf):
    return quality.pipeline_status(td.obs(spark, sf), clean_obs(spark, sf))


def _assertions(spark, sf, profile):
    recon = quality.reconciliation(clean_obs(spark, sf), td.obs_hour(spark, sf), ledger(spark, sf))
    return quality.assertions(recon, profile)


@query("assertions_strict")
def q_assertions_strict(spark, sf):
    return _assertions(spark, sf, quality.STRICT)


@query("assertions")
def q_assertions(spark, sf):
    """The assertions the flow builds and gates on (tolerant profile, D2)."""
    return _assertions(spark, sf, quality.TOLERANT)


@query("assertions_tolerant")
def q_assertions_tolerant(spark, sf):
    return _assertions(spark, sf, quality.TOLERANT)


@query("dq_gate")
def q_dq_gate(spark, sf):
    return quality.failing_count(_assertions(spark, sf, quality.TOLERANT))


@query("not_null_checks")
def q_not_null_checks(spark, sf):
    from loadlens.session import stage
    from loadlens.sources.publish import stg_assertions, stg_clean
    clean = stage(clean_obs(spark, sf), "clean")  # read by all four models, computed once
    recon = quality.reconciliation(clean, td.obs_hour(spark, sf), ledger(spark, sf))
    c = quality.not_null_checks(stg_clean(clean),
                                ["time_utc", "country_code", "bidding_zone", "load_mw"],
                                "stg_energy_load_clean")
    a = quality.not_null_checks(stg_assertions(quality.assertions(recon, quality.TOLERANT)),
                                ["assertion_name", "status"], "stg_dq_assertions")
    d = quality.not_null_checks(analytics.daily_summary(clean, exact_scale=EXACT),
                                ["load_date"], "fct_energy_daily_summary")
    h = quality.not_null_checks(analytics.curve_profile(clean, exact_scale=EXACT),
                                ["hour_of_day"], "fct_energy_hourly_profile")
    return c.unionByName(a).unionByName(d).unionByName(h)


# ------------------------------------------------------------------ mart

@query("peak_hour")
def q_peak_hour(spark, sf):
    return mart.peak_hour(clean_obs(spark, sf))


@query("daily_extremes")
def q_daily_extremes(spark, sf):
    return mart.daily_extremes(clean_obs(spark, sf), exact_scale=EXACT)


@query("seasonal_peaks")
def q_seasonal_peaks(spark, sf):
    return mart.seasonal_peaks(td.orders_obs(spark, sf))


@query("curve_shape")
def q_curve_shape(spark, sf):
    return mart.curve_shape(clean_obs(spark, sf), exact_scale=EXACT)


@query("system_metrics")
def q_system_metrics(spark, sf):
    return mart.system_metrics(clean_obs(spark, sf), exact_scale=EXACT)


@query("system_metrics_by_zone")
def q_system_metrics_by_zone(spark, sf):
    return mart.system_metrics(clean_obs(spark, sf), by=list(HOURLY.keys), exact_scale=EXACT)


@query("metrics_long")
def q_metrics_long(spark, sf):
    wide = mart.system_metrics(clean_obs(spark, sf), exact_scale=EXACT)
    return mart.metrics_long(wide, text_scale=EXACT)


# ------------------------------------------------------------------ tables

def _hour_halves(spark, sf):
    oh = td.obs_hour(spark, sf, with_order=True)
    return td.split_half(oh, spark, sf, True), td.split_half(oh, spark, sf, False)


@query("append_ignore")
def q_append_ignore(spark, sf):
    first, second = _hour_halves(spark, sf)
    keys = HOURLY.key_time
    existing = tables.first_per_key(first, keys, "event_id")
    return tables.append_ignore(existing, second, keys, order_col="event_id").drop("event_id")


@query("upsert_clean")
def q_upsert_clean(spark, sf):
    ev = td.obs(spark, sf, with_order=True)
    first = td.split_half(ev, spark, sf, True).drop("event_id")
    second = td.split_half(ev, spark, sf, False).drop("event_id")
    old = clean_ops.clean_series(first, exact_scale=EXACT)
    new = clean_ops.clean_series(second, exact_scale=EXACT)
    return tables.upsert(old, new, HOURLY.key_time)


def marks_from(series: DataFrame, now_literal: str = "2025-01-01 00:00:00") -> DataFrame:
    """High-water marks as the ingestion would leave them after loading ``series``."""
    return (series.groupBy("country_code", "bidding_zone")
            .agg(F.max("time_utc").alias("last_ingested_at_utc"))
            .select(F.lit(PIPELINE_NAME).alias("pipeline_name"), "country_code", "bidding_zone",
                    "last_ingested_at_utc",
                    F.lit(now_literal).cast("timestamp_ntz").alias("updated_at_utc")))


def zone_requests(series: DataFrame) -> DataFrame:
    """One ingestion request per zone covering the dates the zone has data for."""
    return (series.groupBy("country_code", "bidding_zone")
            .agg(F.date_format(F.min("time_utc"), "yyyy-MM-dd").alias("start_date"),
                 F.date_format(F.max("time_utc"), "yyyy-MM-dd").alias("end_date"))
            .withColumn("pipeline_name", F.lit(PIPELINE_NAME)))


@query("state_lookup")
def q_state_lookup(spark, sf):
    first, _ = _hour_halves(spark, sf)
    reqs = zone_requests(td.obs_hour(spark, sf)).select(*tables.MARK_KEYS)
    return tables.state_lookup(reqs, marks_from(first))


@query("state_upsert")
def q_state_upsert(spark, sf):
    first, second = _hour_halves(spark, sf)
    new = marks_from(second).select(*tables.MARK_KEYS, "last_ingested_at_utc")
    return tables.state_upsert(marks_from(first), new,
                               now=F.lit("2025-06-01 00:00:00").cast("timestamp_ntz"))


@query("run_ledger_latest")
def q_run_ledger_latest(spark, sf):
    return ledger(spark, sf)


def all_queries() -> dict[str, Query]:
    # Import modules whose queries register themselves.
    from loadlens.plans import catalog_ingest, catalog_stream  # noqa: F401
    return dict(REGISTRY)
