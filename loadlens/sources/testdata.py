"""Map the driver's generated tables onto the load-series data model.

The mapping (kept identical in the SQL oracle):

* ``obs``       events: time = ts, country = event_type, zone = 'Z' || user_id % 3,
                load = value, ingested_at = ts, source null, ingest order = event_id.
* ``obs_hour``  obs with time truncated to the hour, not aggregated (real duplicate keys).
* ``orders_obs`` orders: time = o_orderdate, country = o_orderpriority,
                zone = o_orderstatus, load = o_totalprice (single orders).
* ``daily_obs`` orders_obs averaged per day: a multi-year daily series.
* ``invalid``   customer: country = c_mktsegment, zone = 'N' || c_nationkey,
                time = 2024-01-01 + c_custkey hours, load = c_acctbal (has negatives).
* ``runs``      events as run ledger: run id = event_id, started = ts,
                purchase -> success, error -> failed, anything else -> running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions.expr import floor_to


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def obs(spark: SparkSession, sf_dir: str, with_order: bool = False) -> DataFrame:
    ev = table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    cols = [
        F.col("ts").alias("time_utc"),
        F.col("event_type").alias("country_code"),
        F.concat(F.lit("Z"), (F.col("user_id") % 3).cast("string")).alias("bidding_zone"),
        F.col("value").alias("load_mw"),
        F.lit(None).cast("string").alias("source"),
        F.col("ts").alias("ingested_at"),
    ]
    if with_order:
        cols.append(F.col("event_id"))
    return ev.select(*cols)


def obs_hour(spark: SparkSession, sf_dir: str, with_order: bool = False) -> DataFrame:
    return obs(spark, sf_dir, with_order).withColumn("time_utc", floor_to(F.col("time_utc"), "hour"))


def event_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-row frame holding the events row count (for first/second half splits)."""
    return table(spark, sf_dir, "events", ["event_id"]).agg(F.count(F.lit(1)).alias("n"))


def split_half(df: DataFrame, spark: SparkSession, sf_dir: str, first: bool) -> DataFrame:
    """First half (event_id < n/2) or second half of an event-derived frame."""
    n = event_count(spark, sf_dir).scalar()
    cond = (F.col("event_id") * 2) < n
    return df.filter(cond if first else ~cond)


def orders_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", ["o_orderdate", "o_orderpriority", "o_orderstatus", "o_totalprice"])
    return o.select(
        F.col("o_orderdate").alias("time_utc"),
        F.col("o_orderpriority").alias("country_code"),
        F.col("o_orderstatus").alias("bidding_zone"),
        F.col("o_totalprice").alias("load_mw"),
        F.lit(None).cast("string").alias("source"),
        F.col("o_orderdate").alias("ingested_at"),
    )


def invalid_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    return c.select(
        F.timestamp_add("HOUR", F.col("c_custkey"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
        .alias("time_utc"),
        F.col("c_mktsegment").alias("country_code"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("bidding_zone"),
        F.col("c_acctbal").alias("load_mw"),
    )


def runs_events(spark: SparkSession, sf_dir: str, pipeline_name: str, source_name: str) -> DataFrame:
    """Run-ledger events: an open event per run plus a close event unless running."""
    ev = table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    status = (F.when(F.col("event_type") == "purchase", "success")
              .when(F.col("event_type") == "error", "failed").otherwise("running"))
    base = ev.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.lit(pipeline_name).alias("pipeline_name"),
        F.lit(source_name).alias("source_name"),
        F.col("event_type").alias("country_code"),
        F.concat(F.lit("Z"), (F.col("user_id") % 3).cast("string")).alias("bidding_zone"),
        floor_to(F.col("ts"), "day").alias("requested_start_utc"),
        F.timestamp_add("HOUR", F.lit(23), floor_to(F.col("ts"), "day")).alias("requested_end_utc"),
        F.col("ts").alias("started_at_utc"),
        status.alias("final_status"),
        F.floor(F.col("value")).cast("bigint").alias("secs"),
        F.col("user_id").cast("int").alias("n_rows"),
        F.col("props"),
    )
    return base
