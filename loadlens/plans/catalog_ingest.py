"""Ingestion and publish queries (registered into the catalog).

The landing XML is derived from ``events`` by Spark and written under the
shared checkpoint folder, so the scan, flatten and statistics grow with the
table. Zone Z0 publishes hourly (PT60M) documents, Z1 quarter-hourly (PT15M),
and Z2 alternates: hourly on odd days, quarter-hourly on even days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions.expr import mean
from loadlens.operators import analytics, cells, clean as clean_ops, presence, quality, tables
from loadlens.plans import ingest
from loadlens.schema import HOURLY, STATE_SCHEMA
from loadlens.plans.catalog import EXACT, _hour_halves, clean_obs, marks_from, query, _assertions
from loadlens.session import read_version, scratch_path, version_path
from loadlens.sources import market_xml as mx
from loadlens.sources import publish as pub
from loadlens.sources import testdata as td
from loadlens.sources import warehouse as wh

# ------------------------------------------------------------------ landing documents


def landing_points(spark: SparkSession, sf: str) -> DataFrame:
    """Grid points to publish as XML: hourly or 15-minute averages per zone-day rule."""
    valid = clean_ops.valid_rows(td.obs(spark, sf))
    q15 = (valid.groupBy(mx.floor_minutes(F.col("time_utc"), 15).alias("time_utc"),
                         "country_code", "bidding_zone")
           .agg(mean("load_mw", EXACT).alias("load_mw")))
    hourly = clean_obs(spark, sf).select("time_utc", "country_code", "bidding_zone", "load_mw")
    zone, t = F.col("bidding_zone"), F.col("time_utc")
    rule = (F.when(zone == "Z0", "PT60M").when(zone == "Z1", "PT15M")
            .when(F.dayofmonth(t) % 2 == 1, "PT60M").otherwise("PT15M"))
    return (hourly.withColumn("resolution", rule).filter(F.col("resolution") == "PT60M")
            .unionByName(q15.withColumn("resolution", rule).filter(F.col("resolution") == "PT15M")))


def landing(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "landing")
    mx.write_documents(mx.to_documents(landing_points(spark, sf)), path)
    return path


def landed_series(spark: SparkSession, sf: str) -> DataFrame:
    return mx.read_documents(spark, landing(spark, sf))


@query("ingest_xml_points")
def q_ingest_xml_points(spark, sf):
    return mx.flatten_points(landed_series(spark, sf))


@query("ingest_xml_split")
def q_ingest_xml_split(spark, sf):
    """One document for each zone and quarter, read by byte ranges."""
    path = scratch_path(spark, "landing")
    mx.write_documents(mx.to_documents(landing_points(spark, sf)).repartition(*mx.ZONE_KEYS), path)
    return mx.flatten_points(mx.read_documents_split(spark, path)).drop("doc_order")


@query("resolution_step")
def q_resolution_step(spark, sf):
    return mx.periods(landed_series(spark, sf)).select(
        "country_code", "bidding_zone", "period_start", "resolution", "step_minutes")


@query("resolutions_seen")
def q_resolutions_seen(spark, sf):
    return ingest.resolutions_seen(mx.periods(landed_series(spark, sf)))


@query("run_stats")
def q_run_stats(spark, sf):
    series = landed_series(spark, sf)
    return ingest.run_stats(mx.flatten_points(series), series, observe_name="ingest_stats")


# ------------------------------------------------------------------ planning

def _requests(spark, sf):
    return ingest.request_window(ingest.default_requests(td.obs_hour(spark, sf)))


@query("request_window")
def q_request_window(spark, sf):
    return _requests(spark, sf)


@query("effective_window")
def q_effective_window(spark, sf):
    first, _ = _hour_halves(spark, sf)
    return ingest.effective_window(_requests(spark, sf), marks_from(first))


@query("noop_runs")
def q_noop_runs(spark, sf):
    windows = ingest.effective_window(_requests(spark, sf), marks_from(td.obs_hour(spark, sf)))
    return ingest.noop_runs(
        windows,
        run_id=ingest.run_id_for("pipeline_name", "country_code", "bidding_zone", "effective_start_utc"),
        now=F.lit("2025-06-01 00:00:00").cast("timestamp_ntz"))


def orders_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Multi-year daily requests per zone, resumed from marks of the first half of orders."""
    o = td.table(spark, sf, "orders", ["o_orderkey"])
    n = o.agg(F.count(F.lit(1))).scalar()
    series = td.orders_obs(spark, sf)
    first = (td.table(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus"])
             .filter(F.col("o_orderkey") * 2 < n)
             .select(F.col("o_orderdate").alias("time_utc"), F.col("o_orderpriority").alias("country_code"),
                     F.col("o_orderstatus").alias("bidding_zone")))
    windows = ingest.request_window(ingest.default_requests(series))
    return ingest.effective_window(windows, marks_from(first), step=F.expr("INTERVAL 1 DAY"))


@query("quarter_chunks")
def q_quarter_chunks(spark, sf):
    return ingest.quarter_chunks(orders_windows(spark, sf)).select(
        "pipeline_name", "country_code", "bidding_zone", "effective_start_utc", "effective_end_utc",
        "chunk_start_utc", "chunk_end_utc", "period_start", "period_end")


@query("quarter_chunks_full")
def q_quarter_chunks_full(spark, sf):
    """I3 over the whole, unresumed range of every zone: many quarters each."""
    windows = ingest.effective_window(ingest.request_window(ingest.default_requests(td.orders_obs(spark, sf))),
                                      spark.createDataFrame([], STATE_SCHEMA))
    return ingest.quarter_chunks(windows).select(
        "country_code", "bidding_zone", "chunk_start_utc", "chunk_end_utc", "period_start", "period_end")


# ------------------------------------------------------------------ publish

@query("publish_select")
def q_publish_select(spark, sf):
    return pub.declared_select(clean_obs(spark, sf), "energy_load_clean", order=True)


@query("publish_roundtrip")
def q_publish_roundtrip(spark, sf):
    path = scratch_path(spark, "publish")
    daily = analytics.daily_summary(clean_obs(spark, sf), exact_scale=EXACT)
    pub.publish(daily, "daily_load_summary", path, sort_within=["country_code", "bidding_zone", "load_date"])
    return pub.read_published(spark, path, "daily_load_summary")


@query("export_ndjson")
def q_export_ndjson(spark, sf):
    path = scratch_path(spark, "ndjson")
    pub.export_ndjson(pub.declared_select(analytics.anomalies(clean_obs(spark, sf), exact_scale=EXACT),
                                          "hourly_load_anomalies"), path)
    return spark.read.text(path)


@query("export_ndjson_roundtrip")
def q_export_ndjson_roundtrip(spark, sf):
    """S11 values: the exported lines parsed back with the declared schema."""
    path = scratch_path(spark, "ndjson")
    pub.export_ndjson(pub.declared_select(analytics.anomalies(clean_obs(spark, sf), exact_scale=EXACT),
                                          "hourly_load_anomalies"), path)
    return pub.read_ndjson(spark, path, "hourly_load_anomalies")


@query("time_gaps_published")
def q_time_gaps_published(spark, sf):
    """The published gaps object (interval as text) over the multi-year daily series."""
    from loadlens.functions.expr import interval_text
    from loadlens.plans.catalog import daily_obs
    from loadlens.schema import DAILY
    gaps = quality.time_gaps(daily_obs(spark, sf), DAILY)
    return pub.declared_select(gaps.withColumn("gap_interval", interval_text(F.col("gap_seconds"))),
                               "dq_time_gaps")


@query("stg_clean")
def q_stg_clean(spark, sf):
    return pub.stg_clean(pub.declared_select(clean_obs(spark, sf), "energy_load_clean"))


@query("stg_assertions")
def q_stg_assertions(spark, sf):
    return pub.stg_assertions(pub.declared_select(_assertions(spark, sf, quality.TOLERANT), "dq_assertions"))



@query("zone_metrics_published")
def q_zone_metrics_published(spark, sf):
    """The zone-metrics job reading the published clean table through the connector path."""
    src, out = scratch_path(spark, "clean-pub"), scratch_path(spark, "zone-metrics")
    pub.publish(clean_obs(spark, sf), "energy_load_clean", src)
    pub.zone_metrics_job(spark, version_path(spark, src), out, exact_scale=EXACT)
    return pub.read_table(spark, out)


@query("reconciliation_by_zone")
def q_reconciliation_by_zone(spark, sf):
    from loadlens.plans.catalog import ledger
    return quality.reconciliation(clean_obs(spark, sf), td.obs_hour(spark, sf), ledger(spark, sf),
                                  by_zone=True)


def three_runs(spark: SparkSession, sf: str):
    """The incremental ingest job run three times over landed XML: the first week per zone,
    two weeks, then the whole range, each resuming by the marks and resolutions before."""
    from loadlens.plans.pipeline import IngestPaths, ingest as ingest_job
    root = scratch_path(spark, "ingest")
    paths = IngestPaths(landing(spark, sf), f"{root}/raw", f"{root}/marks", f"{root}/ledger")
    full = ingest.default_requests(td.obs(spark, sf)).drop("pipeline_name")
    for day, days in enumerate((6, 13, None), start=1):
        part = full if days is None else full.withColumn("end_date", F.date_format(F.date_add(F.to_date("start_date"), days), "yyyy-MM-dd"))
        ingest_job(spark, part, paths, now=F.lit(f"2025-01-0{day} 00:00:00").cast("timestamp_ntz"))
    return paths


@query("ingest_incremental")
def q_ingest_incremental(spark, sf):
    """The incremental ingest job run twice over landed XML: first two weeks per zone,
    then the whole range resuming from the marks. Returns the raw table."""
    from loadlens.plans.pipeline import IngestPaths, ingest as ingest_job
    root = scratch_path(spark, "ingest")
    paths = IngestPaths(landing(spark, sf), f"{root}/raw", f"{root}/marks", f"{root}/ledger")
    full = ingest.default_requests(td.obs(spark, sf)).drop("pipeline_name")
    first = full.withColumn("end_date", F.date_format(F.date_add(F.to_date("start_date"), 14), "yyyy-MM-dd"))
    step = F.expr("INTERVAL 15 MINUTES")
    ingest_job(spark, first, paths, now=F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"), step=step)
    ingest_job(spark, full, paths, now=F.lit("2025-01-02 00:00:00").cast("timestamp_ntz"), step=step)
    return spark.read.parquet(paths.raw).drop("month")


@query("ingest_ledger")
def q_ingest_ledger(spark, sf):
    """The ledger of three incremental ingest runs: windows, counts and resolutions of each."""
    from loadlens.schema import RUN_EVENT_SCHEMA
    events = spark.read.schema(RUN_EVENT_SCHEMA).parquet(three_runs(spark, sf).ledger)
    return tables.ledger_latest(events).select(
        "country_code", "bidding_zone", "started_at_utc", "status", "requested_start_utc", "requested_end_utc", "rows_seen",
        "rows_inserted", "min_event_time_utc", "max_event_time_utc", "resolution_detected", "source_timeseries_count")


@query("ingest_marks")
def q_ingest_marks(spark, sf):
    """The marks that three incremental ingest runs leave."""
    return read_version(spark, three_runs(spark, sf).marks, STATE_SCHEMA)


@query("ingest_first_writer")
def q_ingest_first_writer(spark, sf):
    """S3 in the job: two documents of each zone-day with other values; the first in order wins."""
    from loadlens.plans.pipeline import IngestPaths, ingest as ingest_job
    root = scratch_path(spark, "first-writer")
    hourly = clean_obs(spark, sf).select("time_utc", "country_code", "bidding_zone", "load_mw").withColumn("resolution", F.lit("PT60M"))
    for copy in (0, 1):  # the folder's name, hence the file's, gives the order
        docs = mx.to_documents(hourly.withColumn("load_mw", F.col("load_mw") + 1000 * copy))
        (docs.withColumn("copy", F.lit(copy)).write.mode("append").partitionBy(*mx.ZONE_KEYS, "copy").format("xml")
         .option("rowTag", "TimeSeries").option("rootTag", mx.DOCUMENT_ROOT).save(f"{root}/landing"))
    paths = IngestPaths(f"{root}/landing", f"{root}/raw", f"{root}/marks", f"{root}/ledger")
    ingest_job(spark, ingest.default_requests(td.obs(spark, sf)).drop("pipeline_name"), paths,
               now=F.lit("2025-01-01 00:00:00").cast("timestamp_ntz"))
    return spark.read.parquet(paths.raw).select("time_utc", "country_code", "bidding_zone", "load_mw")


@query("upsert_table_persisted")
def q_upsert_table_persisted(spark, sf):
    """S4 on files: both halves of the observations upserted by hour, keys repeated inside each batch."""
    path = scratch_path(spark, "upsert")
    rows = td.obs_hour(spark, sf, with_order=True)
    for first in (True, False):
        tables.upsert_table(spark, td.split_half(rows, spark, sf, first), path, HOURLY.key_time, order_col="event_id")
    return spark.read.parquet(path).select(*HOURLY.key_time, "load_mw", "event_id")


@query("published_objects")
def q_published_objects(spark, sf):
    """S14 + S10: build every layer from the mapped tables, publish all 15 objects with
    their declared schemas, read them back and count rows per object."""
    from functools import reduce

    from loadlens.plans.catalog import ledger
    from loadlens.plans.pipeline import build_layers, publish_all
    from loadlens.schema import PUBLISH_SCHEMAS
    root = scratch_path(spark, "published")
    layers = build_layers(td.obs(spark, sf), ledger(spark, sf), exact_scale=EXACT, marks=marks_from(td.obs_hour(spark, sf)))
    publish_all(layers, root)
    counts = [pub.read_published(spark, f"{root}/{name}", name).agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("object_name"), "row_count") for name in PUBLISH_SCHEMAS]
    for df in layers.values():
        df.unpersist()
    return reduce(lambda a, b: a.unionByName(b), counts)


@query("materialised_fact")
def q_materialised_fact(spark, sf):
    """The daily fact as a table in a folder, behind a view of its name."""
    daily = analytics.daily_summary(clean_obs(spark, sf), exact_scale=EXACT)
    return pub.materialise(spark, daily, "loadlens_daily_fact", "table", path=scratch_path(spark, "fact"))


@query("bootstrap_raw")
def q_bootstrap_raw(spark, sf):
    """The typed empty raw table, then all observations appended with the table's defaults."""
    now = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    rows = tables.with_ingest_default(td.obs(spark, sf).drop("ingested_at", "source"), now)
    return tables.bootstrap(spark)["energy_load_raw"].unionByName(rows)


# ------------------------------------------------------------------ catalog tables

def _database(spark: SparkSession) -> tuple[str, str]:
    """A database of its own for one query: name and shared folder."""
    path = scratch_path(spark, "warehouse")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    wh.create_database(spark, name, path)
    return name, path


@query("catalog_fact")
def q_catalog_fact(spark, sf):
    """The daily fact saved as a table of the catalog and read by its name."""
    database, path = _database(spark)
    wh.save_table(analytics.daily_summary(clean_obs(spark, sf), exact_scale=EXACT), f"{database}.daily_fact", f"{path}/daily_fact")
    return spark.sql(f"SELECT * FROM {database}.daily_fact")


@query("catalog_defaults")
def q_catalog_defaults(spark, sf):
    """The raw table by DDL, all observations inserted without the columns that have defaults or may be null."""
    database, path = _database(spark)
    raw = wh.create_tables(spark, database, path)["energy_load_raw"]
    wh.insert_rows(spark, raw, td.obs(spark, sf).drop("ingested_at", "source"), wh.TABLES["energy_load_raw"])
    return spark.table(raw).withColumn("ingested_at", F.col("ingested_at").isNotNull()).withColumnRenamed("ingested_at", "has_ingest_time")


@query("bucketed_append")
def q_bucketed_append(spark, sf):
    """Both halves appended to a bucketed table, conflicts ignored; the stored side is not shuffled."""
    database, path = _database(spark)
    spec = wh.TABLES["energy_load_raw"]
    raw = wh.create_tables(spark, database, path, buckets=8)["energy_load_raw"]
    for half in _hour_halves(spark, sf):
        wh.append_new(spark, raw, half, spec, "event_id")
    return spark.table(raw)


# ------------------------------------------------------------------ presence bitmaps

def _stored_presence(spark: SparkSession, sf: str) -> DataFrame:
    """Bitmaps of clean written in two updates; the second folds in later rows and some that are stored already."""
    clean, path = clean_obs(spark, sf), scratch_path(spark, "presence")
    hour = F.hour("time_utc")
    presence.update_presence(path, clean.where(hour < 14))
    return presence.update_presence(path, clean.where(hour >= 10))


@query("missing_hours_bitmaps")
def q_missing_hours_bitmaps(spark, sf):
    return presence.missing_from_presence(_stored_presence(spark, sf))


@query("step_counts_bitmaps")
def q_step_counts_bitmaps(spark, sf):
    return presence.presence_counts(_stored_presence(spark, sf))


@query("step_counts_bitmaps_by_zone")
def q_step_counts_bitmaps_by_zone(spark, sf):
    return presence.presence_counts(_stored_presence(spark, sf), by_zone=True)


# ------------------------------------------------------------------ incremental layers

def _updated_cells(spark: SparkSession, sf: str) -> tuple[DataFrame, cells.Cells]:
    """Clean in two upserts; the second corrects and adds rows of some months, and only their cells are made again."""
    clean, path, stored = clean_obs(spark, sf), scratch_path(spark, "clean"), scratch_path(spark, "cells")
    late = F.dayofmonth("time_utc") > 20
    first = clean.where(~late | (F.hour("time_utc") < 6)).withColumn(
        "load_mw", F.when(late, F.col("load_mw") * 3 + 1).otherwise(F.col("load_mw")))
    table = tables.upsert_table(spark, first, path, HOURLY.key_time, zone_parts=4)
    cells.update_cells(table, stored, exact_scale=EXACT)
    second = clean.where(late)
    table = tables.upsert_table(spark, second, path, HOURLY.key_time, zone_parts=4)
    return table, cells.update_cells(table, stored, cells.touched_months(second), exact_scale=EXACT)


@query("incremental_daily_summary")
def q_incremental_daily_summary(spark, sf):
    return cells.daily_summary(_updated_cells(spark, sf)[1])


@query("incremental_curve_profile")
def q_incremental_curve_profile(spark, sf):
    return cells.curve_profile(_updated_cells(spark, sf)[1])


@query("incremental_zone_metrics")
def q_incremental_zone_metrics(spark, sf):
    return cells.zone_metrics(_updated_cells(spark, sf)[1])


@query("incremental_anomalies")
def q_incremental_anomalies(spark, sf):
    clean, made = _updated_cells(spark, sf)
    return analytics.anomalies_vs_baseline(clean, cells.daily_baseline(made))


@query("incremental_system_metrics")
def q_incremental_system_metrics(spark, sf):
    return cells.system_metrics(_updated_cells(spark, sf)[1])


@query("incremental_system_metrics_by_zone")
def q_incremental_system_metrics_by_zone(spark, sf):
    return cells.system_metrics(_updated_cells(spark, sf)[1], by=["country_code", "bidding_zone"])
