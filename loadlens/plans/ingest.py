"""Incremental ingestion planned as a table: one row per (pipeline, zone) request.

The reference plans one zone per process in driver code; here the windows,
marks, quarter chunks, no-op runs and run statistics are columns of Spark
frames, so thousands of zones are planned and loaded by one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.functions.expr import floor_to
from loadlens.operators import tables
from loadlens.operators.combine import zip_rows
from loadlens.schema import PIPELINE_NAME, SOURCE_NAME

ZONE = ["country_code", "bidding_zone"]
COMPACT = "yyyyMMddHHmm"


def request_window(requests: DataFrame) -> DataFrame:
    """``start_date``/``end_date`` text → [start 00:00, end 23:00] (wall clock UTC).

    An end before the start fails the query, as the reference raises.
    """
    start = F.to_timestamp_ntz(F.col("start_date"), F.lit("yyyy-MM-dd"))
    end = F.timestamp_add("HOUR", F.lit(23), F.to_timestamp_ntz(F.col("end_date"), F.lit("yyyy-MM-dd")))
    checked_end = F.when(end >= start, end).otherwise(F.raise_error(F.concat(
        F.lit("end-date must be greater than or equal to start-date: "),
        F.col("start_date"), F.lit(" > "), F.col("end_date"))).cast("timestamp_ntz"))
    return requests.withColumn("requested_start_utc", start).withColumn("requested_end_utc", checked_end)


def effective_window(windows: DataFrame, marks: DataFrame, step: Column | None = None) -> DataFrame:
    """I2 (+S5): effective start = max(requested start, mark + step); no mark → requested start.

    ``step`` defaults to one hour; pass the series' resolution to resume right
    after the last point (D8). ``greatest`` skips a null mark.
    """
    step = step if step is not None else F.expr("INTERVAL 1 HOUR")
    looked = tables.state_lookup(windows, marks)
    resume = F.col("last_ingested_at_utc") + step
    return (looked.withColumn("effective_start_utc", F.greatest(F.col("requested_start_utc"), resume))
            .withColumn("effective_end_utc", F.col("requested_end_utc")))


def quarter_chunks(windows: DataFrame) -> DataFrame:
    """I3 + I7: split each effective window at calendar quarters.

    A chunk ends on the quarter's last day at 23:00 (capped at the window end);
    the next starts one hour later. ``period_start``/``period_end`` are the
    compact request texts, the end made exclusive by adding one hour. Windows
    with nothing new (start after end) yield no chunks.
    """
    s, e = F.col("effective_start_utc"), F.col("effective_end_utc")
    live = windows.filter(s <= e)
    q = live.withColumn("quarter_start", F.explode(
        F.sequence(floor_to(s, "quarter"), e, F.expr("INTERVAL 3 MONTH"))))
    q_end = F.timestamp_add("HOUR", F.lit(-1), F.timestamp_add("MONTH", F.lit(3), F.col("quarter_start")))
    chunk_start = F.greatest(F.col("quarter_start"), s)
    chunk_end = F.least(q_end, e)
    return (q.withColumn("chunk_start_utc", chunk_start).withColumn("chunk_end_utc", chunk_end)
            .withColumn("period_start", F.date_format("chunk_start_utc", COMPACT))
            .withColumn("period_end", F.date_format(
                F.timestamp_add("HOUR", F.lit(1), F.col("chunk_end_utc")), COMPACT))
            .drop("quarter_start"))


def noop_runs(windows: DataFrame, run_id: Column, now: Column,
              source_name: str = SOURCE_NAME) -> DataFrame:
    """I4: windows with nothing new become successful runs with zero rows.

    The "requested" columns hold the effective window (D15).
    """
    idle = windows.filter(F.col("effective_start_utc") > F.col("effective_end_utc"))
    return tables.run_event(
        idle, 1, run_id=run_id, source_name=F.lit(source_name),
        requested_start_utc=F.col("effective_start_utc"),
        requested_end_utc=F.col("effective_end_utc"),
        started_at_utc=now, finished_at_utc=now, status=F.lit("success"),
        source_timeseries_count=F.lit(0))


def run_stats(points: DataFrame, series: DataFrame, observe_name: str | None = None) -> DataFrame:
    """Per zone rows seen, source series count and event-time bounds.

    The series count comes from the pre-explode frame. With ``observe_name``
    the totals are also published as observed metrics (no extra action).
    """
    if observe_name:
        points = points.observe(observe_name, F.count(F.lit(1)).alias("rows_seen"),
                                F.min("time_utc").alias("min_event_time_utc"),
                                F.max("time_utc").alias("max_event_time_utc"))
    pstats = points.groupBy(*ZONE).agg(F.count(F.lit(1)).alias("rows_seen"),
                                       F.min("time_utc").alias("min_event_time_utc"),
                                       F.max("time_utc").alias("max_event_time_utc"))
    sstats = series.groupBy(*ZONE).agg(F.count(F.lit(1)).alias("source_timeseries_count"))
    out = zip_rows(pstats, sstats, by=ZONE)
    return out.withColumn("rows_seen", F.coalesce("rows_seen", F.lit(0)))


def resolutions_seen(period_rows: DataFrame) -> DataFrame:
    """Distinct resolutions per zone, sorted and comma-joined; null when none."""
    return period_rows.groupBy(*ZONE).agg(
        F.nullif(F.array_join(F.sort_array(F.collect_set("resolution")), ","), F.lit(""))
        .alias("resolution_detected"))


def resume_steps(ledger: DataFrame) -> DataFrame:
    """Per (pipeline, zone) the step to resume by: the finest resolution of the
    zone's latest successful run (15 minutes when it saw PT15M, else one hour)."""
    last = (ledger.filter(F.col("status") == "success")
            .groupBy("pipeline_name", *ZONE)
            .agg(F.max_by("resolution_detected", F.struct("started_at_utc", "run_id")).alias("_res")))
    step = (F.when(F.coalesce(F.col("_res"), F.lit("")).contains("PT15M"), F.expr("INTERVAL 15 MINUTES"))
            .otherwise(F.expr("INTERVAL 1 HOUR")))
    return last.select("pipeline_name", *ZONE, step.alias("resume_step"))


def run_id_for(*cols: str) -> Column:
    """A deterministic run id from the request (for reproducible runs and tests)."""
    return F.sha2(F.concat_ws("|", *[F.col(c).cast("string") for c in cols]), 256)


def default_requests(series: DataFrame, pipeline_name: str = PIPELINE_NAME) -> DataFrame:
    """One request per zone covering the dates that zone has data for."""
    return (series.groupBy(*ZONE)
            .agg(F.date_format(F.min("time_utc"), "yyyy-MM-dd").alias("start_date"),
                 F.date_format(F.max("time_utc"), "yyyy-MM-dd").alias("end_date"))
            .withColumn("pipeline_name", F.lit(pipeline_name)))
