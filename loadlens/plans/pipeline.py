"""Layer build in dependency order, the DQ gate, and the incremental ingest job.

``build_layers`` returns lazy DataFrames for every derived object (the
reference's views); actions happen only at the clean write, the gate and
publish. Objects read by several consumers (clean, missing steps) are
persisted once instead of being re-evaluated per consumer.
"""

from __future__ import annotations

import logging
from contextlib import ExitStack
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions.expr import interval_text, utc_now
from loadlens.operators.quality import gap_micros
from loadlens.operators import analytics, clean as clean_ops, mart, quality, tables
from loadlens.plans import ingest as plan
from loadlens.schema import (HOURLY, PIPELINE_NAME, RAW_SCHEMA, RUN_EVENT_SCHEMA, SOURCE_NAME,
                             STATE_SCHEMA, SeriesSpec)
from loadlens.sources import market_xml as mx
from loadlens.session import read_or_empty, read_version, stage, staged, write_version
from loadlens.sources import publish as pub

log = logging.getLogger(__name__)


def build_layers(raw: DataFrame, ledger: DataFrame, clean: DataFrame | None = None,
                 spec: SeriesSpec = HOURLY, exact_scale: int | None = None,
                 profile: quality.AssertionProfile = quality.TOLERANT, persist: bool = True,
                 register: bool = False, marks: DataFrame | None = None) -> dict[str, DataFrame]:
    """Clean → DQ → analytics → mart, named as the published objects."""
    if marks is None:
        marks = raw.sparkSession.createDataFrame([], STATE_SCHEMA)
    if clean is None:
        clean = clean_ops.clean_series(raw, spec, exact_scale=exact_scale)
    if persist:
        clean = clean.persist()
    missing = quality.missing_times(clean, spec)
    gaps = quality.time_gaps(clean, spec)
    invalid = quality.invalid_loads(clean, spec)
    recon = quality.reconciliation(clean, raw, ledger, spec)
    wide = mart.system_metrics(clean, spec, exact_scale=exact_scale)
    if persist:  # one-row frames that several objects read
        recon, wide = stage(recon, "recon"), stage(wide, "wide")
    layers = {
        "energy_load_raw": raw,
        "energy_load_clean": clean,
        "pipeline_runs": ledger,
        "pipeline_state": marks,
        "dq_time_gaps": gaps.withColumn("gap_interval", interval_text(
            F.col("gap_seconds"), gap_micros(F.col("previous_time"), F.col(spec.time)) % 1_000_000)),
        "dq_missing_hours": missing,
        "dq_invalid_loads": invalid,
        "dq_pipeline_status": quality.pipeline_status(raw, clean, spec, gaps=gaps),
        "dq_reconciliation_summary": recon,
        "dq_assertions": quality.assertions(recon, profile),
        "daily_load_summary": analytics.daily_summary(clean, spec, exact_scale),
        "hourly_load_anomalies": analytics.anomalies(clean, spec, exact_scale=exact_scale),
        "daily_load_curve_profile": analytics.curve_profile(clean, spec, exact_scale),
        "mart_energy_system_metrics": wide,
        "mart_energy_system_metrics_long": mart.metrics_long(wide),
    }
    if register:
        pub.register_views(layers)
    return layers


# Staging models are views, mart models are tables.
DBT_MATERIALISATION = {"stg_energy_load_clean": "view", "stg_dq_assertions": "view",
                       "fct_energy_daily_summary": "table", "fct_energy_hourly_profile": "table"}


def build_dbt_models(spark: SparkSession, clean: DataFrame, assertions: DataFrame, root: str,
                     exact_scale: int | None = None) -> dict[str, DataFrame]:
    """S13 + S15 + G2/G4 (D11): typed staging views over the synced objects and
    the two fact models built on them, materialised as tables under ``root``."""
    stg = pub.materialise(spark, pub.stg_clean(clean), "stg_energy_load_clean",
                          DBT_MATERIALISATION["stg_energy_load_clean"])
    out = {
        "stg_energy_load_clean": stg,
        "stg_dq_assertions": pub.materialise(spark, pub.stg_assertions(assertions), "stg_dq_assertions",
                                             DBT_MATERIALISATION["stg_dq_assertions"]),
    }
    facts = {"fct_energy_daily_summary": analytics.daily_summary(stg, exact_scale=exact_scale),
             "fct_energy_hourly_profile": analytics.curve_profile(stg, exact_scale=exact_scale)}
    for name, df in facts.items():
        out[name] = pub.materialise(spark, df, name, DBT_MATERIALISATION[name], path=f"{root.rstrip('/')}/{name}")
    return out


def publish_all(layers: dict[str, DataFrame], root: str, fmt: str = "parquet",
                concurrency: int = 4) -> None:
    """S10 for every object (not atomic across objects, as in the reference).

    The objects are independent jobs, so up to ``concurrency`` are submitted
    at once from driver threads; shared persisted inputs are computed once
    (a cached block is built by one task while others wait for it).
    """
    from concurrent.futures import ThreadPoolExecutor

    names = [n for n in layers if n in pub.PUBLISH_SCHEMAS]
    with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
        for f in [pool.submit(pub.publish, layers[n], n, f"{root.rstrip('/')}/{n}", fmt) for n in names]:
            f.result()


def run_pipeline(spark: SparkSession, raw_path: str, ledger_path: str, clean_path: str,
                 publish_root: str | None = None, spec: SeriesSpec = HOURLY,
                 profile: quality.AssertionProfile = quality.TOLERANT,
                 marks_path: str | None = None, months: list[str] | None = None,
                 zone_parts: int = 16) -> dict[str, DataFrame]:
    """The flow: upsert clean from raw, build DQ/analytics/mart, gate, publish.

    ``months`` (yyyy-MM), if given, are those that the ingest run touched: only they
    are cleaned again and rewritten; all layers are built over the whole of clean.
    """
    raw = spark.read.schema(RAW_SCHEMA).parquet(raw_path)
    marks = read_version(spark, marks_path, STATE_SCHEMA) if marks_path else None
    ledger = tables.ledger_latest(spark.read.schema(RUN_EVENT_SCHEMA).parquet(ledger_path))
    changed = raw if months is None else raw.filter(F.date_format(spec.time, "yyyy-MM").isin(months))
    fresh = clean_ops.clean_series(changed, spec)
    clean = tables.upsert_table(spark, fresh, clean_path, spec.key_time, zone_parts=zone_parts).drop("month", tables.ZONE_PART)
    # clean is a table by now: nothing needs to be kept on the executors
    layers = build_layers(raw, ledger, clean=clean, spec=spec, profile=profile, persist=False, marks=marks)
    quality.dq_gate(layers["dq_assertions"])
    if publish_root:
        publish_all(layers, publish_root)
    return layers


# ---------------------------------------------------------------- ingestion job

@dataclass
class IngestPaths:
    landing: str
    raw: str
    marks: str
    ledger: str


def ingest(spark: SparkSession, requests: DataFrame, paths: IngestPaths,
           now: Column | None = None, step: Column | None = None,
           pipeline_name: str = PIPELINE_NAME, source_name: str = SOURCE_NAME) -> DataFrame:
    """Incremental load of landed market XML for many zones at once.

    Without ``step``, a zone resumes one resolution after its mark, the
    resolution being the one its last successful run saw (D8; one hour when
    unknown). Order as in the reference: open runs, close no-op runs, scan the
    folders of the requested quarters (I3) and flatten, append with conflicts
    ignored (the first point in document order wins), move marks from rows
    *parsed* (D18), close runs. Series, resolutions and rows count what the run's
    own window asks for.

    Zones fail one by one: a zone with a malformed document, an unknown resolution
    or a bad number is closed as failed, with the rows that could be read, and the
    others are stored; only if none is left the call raises. Any other error
    closes all as failed, with the rows stored so far, and is raised (D17).
    Returns the closed ledger events.
    """
    now = now if now is not None else utc_now()
    marks = read_version(spark, paths.marks, STATE_SCHEMA)
    requested = plan.request_window(requests.withColumn("pipeline_name", F.lit(pipeline_name)))
    if step is None:  # D8: resume by the resolution the zone's last successful run saw
        ledger_now = tables.ledger_latest(read_or_empty(spark, paths.ledger, RUN_EVENT_SCHEMA))
        requested = requested.join(plan.resume_steps(ledger_now), ["pipeline_name", *plan.ZONE], "left")
        step = F.coalesce(F.col("resume_step"), F.expr("INTERVAL 1 HOUR"))
    # frozen before the marks move; the run id is a hash of (request, start time),
    # stable under recomputation. The request covers [start, end + 1 hour).
    windows = stage(plan.effective_window(requested, marks, step).withColumn("started_at_utc", now)
                    .withColumn("run_id", plan.run_id_for("pipeline_name", *plan.ZONE, "effective_start_utc",
                                                          "effective_end_utc", "started_at_utc"))
                    .withColumn("window_start", F.col("effective_start_utc"))
                    .withColumn("window_end", F.timestamp_add("HOUR", F.lit(1), F.col("effective_end_utc"))),
                    "ingest-windows")
    asked = {"source_name": F.lit(source_name), "requested_start_utc": F.col("effective_start_utc"),
             "requested_end_utc": F.col("effective_end_utc")}
    tables.run_event(windows, 0, **asked, status=F.lit("running")).write.mode("append").parquet(paths.ledger)
    noop = plan.noop_runs(windows, run_id=F.col("run_id"), now=now, source_name=source_name)
    live = windows.filter(F.col("effective_start_utc") <= F.col("effective_end_utc"))
    done = _IngestRun(spark, paths, live, now, pipeline_name)
    try:
        with ExitStack() as files:
            done.load(files)
            outcome = live.join(done.counts, plan.ZONE, "left").join(done.faults, plan.ZONE, "left")
            failed = F.col("error_message").isNotNull()
            closed = tables.run_event(
                outcome, 1, **asked, finished_at_utc=now, status=F.when(failed, "failed").otherwise("success"),
                **{c: F.coalesce(F.col(c), F.lit(0)) for c in ("rows_seen", "rows_inserted", "source_timeseries_count")})
            closed.unionByName(noop).write.mode("append").parquet(paths.ledger)
    except Exception as exc:
        outcome = live if done.counts is None else live.join(done.counts, plan.ZONE, "left")
        known = set(outcome.columns)
        tables.run_event(
            outcome, 1, **asked, finished_at_utc=now, status=F.lit("failed"), error_message=F.lit(str(exc)),
            **{c: F.coalesce(F.col(c), F.lit(0)) for c in ("rows_seen", "rows_inserted") if c in known},
        ).unionByName(noop).write.mode("append").parquet(paths.ledger)
        log.error("ingestion failed: %s", exc)
        raise
    events = spark.read.schema(RUN_EVENT_SCHEMA).parquet(paths.ledger).filter("event_seq = 1").join(
        windows.select("run_id"), "run_id", "left_semi").select(*RUN_EVENT_SCHEMA.fieldNames())
    states = {r["status"]: r["error_message"] for r in events.groupBy("status").agg(F.min("error_message").alias("error_message")).collect()}
    if set(states) == {"failed"}:
        raise IngestError(states["failed"])
    return events


class IngestError(RuntimeError):
    """Raised when every zone of an ingest run failed."""


class _IngestRun:
    """What an ingest run has done so far: ``faults`` and ``counts`` per zone."""

    def __init__(self, spark: SparkSession, paths: IngestPaths, live: DataFrame, now: Column, pipeline_name: str):
        self.spark, self.paths, self.live, self.now, self.pipeline_name = spark, paths, live, now, pipeline_name
        self.faults = self.counts = None

    def load(self, files: ExitStack) -> None:
        spark, zone = self.spark, plan.ZONE
        folders = mx.requested_folders(spark, self.paths.landing, plan.quarter_chunks(self.live))
        documents = mx.read_documents(spark, folders, strict=False, base_path=self.paths.landing) if folders else mx.no_documents(spark)
        # parsed once: faults, statistics, resolutions and points all read these files
        series = files.enter_context(staged(documents.join(self.live.select(*zone), zone, "left_semi"), "ingest-series"))
        self.faults = stage(mx.faults(series, self.live), "ingest-faults")
        sound = series.join(self.faults, zone, "left_anti")
        wanted = mx.requested_series(series.filter(F.col(mx.BAD).isNull()), self.live)
        resolutions = plan.resolutions_seen(mx.overlapping(mx.periods(series, strict=False), self.live))
        t = F.col("time_utc")
        window = self.live.select(*zone, "window_start", "window_end")
        inside = (t >= F.col("window_start")) & (t < F.col("window_end"))
        seen = mx.flatten_points(series, strict=False).join(window, zone).filter(inside)
        stats = stage(plan.run_stats(seen, wanted), "ingest-stats")
        self.counts = stats.join(resolutions, zone, "left")
        points = mx.flatten_points(sound).join(window, zone).filter(inside).drop("window_start", "window_end")
        stored = read_or_empty(spark, self.paths.raw, RAW_SCHEMA)
        fresh = tables.append_ignore(tables.rows_in_range(stored, points), points, ["time_utc", *zone], "doc_order")
        inserted = files.enter_context(staged(tables.with_ingest_default(fresh, self.now), "ingest-inserted"))
        (inserted.withColumn("month", F.date_format("time_utc", "yyyy-MM"))
         .sortWithinPartitions(*zone, "time_utc")
         .write.mode("append").partitionBy("month").parquet(self.paths.raw))
        rows = inserted.groupBy(*zone).agg(F.count(F.lit(1)).alias("rows_inserted"))
        self.counts = stage(self.counts.join(rows, zone, "left"), "ingest-counts")
        moved = stats.join(self.faults, zone, "left_anti").select(
            F.lit(self.pipeline_name).alias("pipeline_name"), *zone, F.col("max_event_time_utc").alias("last_ingested_at_utc"))
        marks = read_version(spark, self.paths.marks, STATE_SCHEMA)
        write_version(tables.state_upsert(marks, moved, self.now), self.paths.marks)
