"""Structured Streaming re-aims of the incremental batch semantics.

The reference has no streaming code; these give the same results as the batch
operators when data arrives in time order within the watermark:

* X1 ``xml_landing_stream``: landing folder → TimeSeries rows, incremental.
* X2 ``hourly_downsample``: watermark + 1-hour tumbling window per zone.
* X3 ``dedupe_keys`` (built-in) and ``dedupe_sink`` (hot-key safe): first row per
  (time, zone) within the watermark.
* X4 ``upsert_sink``: ``foreachBatch`` writer that upserts each micro-batch.
* X5 ``gap_detector_sink``: per-zone last-time state table, gaps per micro-batch.

Event time is wall-clock NTZ in the tables; watermarks need TIMESTAMP, so the
stream converts at the source (``ntz_to_instant``) and back at the sink,
independent of the session time zone.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions.expr import instant_to_ntz, mean, ntz_to_instant
from loadlens.operators import tables
from loadlens.schema import DEFAULT_SOURCE, HOURLY, TIMESERIES_SCHEMA, SeriesSpec
from loadlens.session import path_exists, read_or_empty
from loadlens.sources.market_xml import ZONE_KEYS

EVENT_TIME = "event_time"


def xml_landing_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """TimeSeries rows of documents arriving in a zone-partitioned landing folder."""
    schema = T.StructType([*TIMESERIES_SCHEMA.fields,
                           *[T.StructField(k, T.StringType()) for k in ZONE_KEYS]])
    reader = (spark.readStream.format("xml").schema(schema)
              .option("rowTag", "TimeSeries").option("ignoreNamespace", "true")
              .option("mode", "FAILFAST"))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def with_event_time(df: DataFrame, spec: SeriesSpec = HOURLY) -> DataFrame:
    return df.withColumn(EVENT_TIME, ntz_to_instant(F.col(spec.time)))


def hourly_downsample(obs: DataFrame, spec: SeriesSpec = HOURLY, watermark: str = "2 hours",
                      exact_scale: int | None = None, default_source: str = DEFAULT_SOURCE) -> DataFrame:
    """The G1 hourly average as a streaming aggregate with a late-data bound.

    Run it in ``update`` mode into :func:`upsert_sink`: each trigger re-emits
    the full current value of every hour it touched.
    """
    v = F.col(spec.value)
    valid = obs.filter(v.isNotNull() & (v >= 0))
    timed = with_event_time(valid, spec).withWatermark(EVENT_TIME, watermark)
    agg = timed.groupBy(F.window(EVENT_TIME, "1 hour").alias("w"), *spec.keys).agg(
        mean(spec.value, exact_scale).alias(spec.value),
        F.coalesce(F.max(spec.source), F.lit(default_source)).alias(spec.source),
        F.max(spec.ingested_at).alias(spec.ingested_at))
    return agg.select(instant_to_ntz(F.col("w.start")).alias(spec.time), *spec.keys,
                      spec.value, spec.source, spec.ingested_at)


def dedupe_keys(obs: DataFrame, spec: SeriesSpec = HOURLY, watermark: str = "1 day") -> DataFrame:
    """Keep the first row seen per (time, keys) within the watermark."""
    timed = with_event_time(obs, spec).withWatermark(EVENT_TIME, watermark)
    return timed.dropDuplicatesWithinWatermark(spec.key_time).drop(EVENT_TIME)


def dedupe_sink(spark: SparkSession, state_path: str, out_path: str, spec: SeriesSpec = HOURLY,
                watermark_seconds: int = 86400, order_col: str | None = None
                ) -> Callable[[DataFrame, int], None]:
    """X3 for hot keys: ``foreachBatch`` keeping the first row per (time, keys).

    ``dropDuplicatesWithinWatermark`` shuffles every copy of a key to that
    key's state partition, so a key with a third of the rows is one task.
    Here each micro-batch is first de-duplicated by a partial aggregate
    (copies collapse map-side), then anti-joined with the keys already seen
    within the watermark (a state table versioned by batch id, like X5).
    """
    keys = spec.key_time

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            first = (tables.first_per_key(rows, keys, order_col) if order_col
                     else rows.dropDuplicates(keys))
            seen = _latest_state(spark, state_path, batch_id, spec)
            fresh = first if seen is None else first.join(seen.distinct(), keys, "left_anti")
            fresh = fresh.persist()
            (fresh.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out_path))
            known = fresh.select(*spec.keys, spec.time)
            if seen is not None:
                known = known.unionByName(seen)
            horizon = known.agg(F.max(spec.time)).first()[0]
            if horizon is not None:
                cut = F.lit((horizon - _dt.timedelta(seconds=watermark_seconds)).isoformat(sep=" "))
                known = known.filter(F.col(spec.time) >= cut.cast("timestamp_ntz"))
            _write_state(known, state_path, batch_id)
            fresh.unpersist()
        finally:
            rows.unpersist()

    return write


def upsert_sink(spark: SparkSession, path: str, keys: list[str], zone_parts: int = 16) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that upserts every micro-batch into a table.

    The table is partitioned by (month, zone part), so a batch rewrites only the parts it touches.
    """
    def write(batch: DataFrame, batch_id: int) -> None:  # noqa: ARG001
        # the upsert reads the batch more than once; keep one evaluation of it
        rows = batch.persist()
        try:
            if not rows.isEmpty():  # watermark-only (no-data) batches change nothing
                tables.upsert_table(spark, rows, path, keys, zone_parts=zone_parts)
        finally:
            rows.unpersist()
    return write


GAP_SCHEMA = T.StructType([
    T.StructField("country_code", T.StringType()),
    T.StructField("bidding_zone", T.StringType()),
    T.StructField("previous_time", T.TimestampNTZType()),
    T.StructField("time_utc", T.TimestampNTZType()),
    T.StructField("gap_seconds", T.LongType()),
])


def _latest_state(spark: SparkSession, state_path: str, batch_id: int, spec: SeriesSpec) -> DataFrame | None:
    """State left by micro-batch ``batch_id - 1`` (None before the first batch).

    State lives in two alternating slots (``batch_id % 2``) tagged with the
    batch id that wrote them: storage stays bounded, and a retried batch still
    finds its predecessor's slot intact.
    """
    if batch_id == 0 or not path_exists(spark, state_path):
        return None  # any other failure to read the state is raised
    slots = spark.read.schema(_state_schema(spec)).parquet(state_path)
    return (slots.filter((F.col("slot") == (batch_id - 1) % 2) & (F.col("v") == batch_id - 1))
            .select(*spec.keys, spec.time))


def _state_schema(spec: SeriesSpec) -> T.StructType:
    return T.StructType([*[T.StructField(k, T.StringType()) for k in spec.keys], T.StructField(spec.time, T.TimestampNTZType()),
                         T.StructField("v", T.IntegerType()), T.StructField("slot", T.IntegerType())])


def _write_state(state: DataFrame, state_path: str, batch_id: int) -> None:
    (state.withColumn("v", F.lit(batch_id)).withColumn("slot", F.lit(batch_id % 2))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("slot").parquet(state_path))


def gap_detector_sink(spark: SparkSession, state_path: str, out_path: str,
                      spec: SeriesSpec = HOURLY, late_path: str | None = None
                      ) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function emitting gaps between consecutive points per zone.

    Each micro-batch is seeded with the previous batch's last time per zone
    (a small state table, one row per zone), then the batch operator's
    day-bucketed lag finds the gaps, so a hot zone is spread over many tasks.
    Output is written under the batch id and state into an alternating slot
    (dynamic overwrite), so a retried batch replaces its own results:
    exactly-once for the sink, with at most two state versions kept.
    Gaps are emitted as data arrives. A row older than its zone's state is late:
    it cannot be placed by the state alone, so it is kept and counted under
    ``late_path`` (``<out_path>-late`` if not given), and :func:`settled_gaps`
    cuts the gaps already emitted by it.
    """
    from loadlens.operators.quality import gap_micros, previous_time

    step_us = spec.step_seconds * 1_000_000
    late_path = late_path or late_rows_path(out_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        pts = batch_pts = batch.select(*spec.keys, spec.time).withColumn("_seed", F.lit(False)).persist()
        prev = _latest_state(spark, state_path, batch_id, spec)
        if prev is not None:
            # one state row per zone: adaptive execution broadcasts it by its size in
            # bytes, and splits a hot zone's partition of the points where it does not
            last = prev.withColumnRenamed(spec.time, "_last")
            marked = pts.join(last, list(spec.keys), "left").withColumn(
                "_late", F.coalesce(F.col(spec.time) < F.col("_last"), F.lit(False)))
            (marked.filter("_late").select(*spec.keys, spec.time).withColumn("batch_id", F.lit(batch_id))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(late_path))
            pts = marked.filter(~F.col("_late")).select(*spec.keys, spec.time, "_seed")
        seeded = pts if prev is None else pts.unionByName(prev.withColumn("_seed", F.lit(True)))
        lagged = previous_time(seeded, spec)
        cur, p = F.col(spec.time), F.col("previous_time")
        diff = gap_micros(p, cur)
        gaps = (lagged.filter(~F.col("_seed") & p.isNotNull() & (diff > F.lit(step_us)))
                .select(*spec.keys, "previous_time", spec.time,
                        F.floor(diff / F.lit(1_000_000)).cast("bigint").alias("gap_seconds"))
                .withColumn("batch_id", F.lit(batch_id)))
        gaps.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("batch_id").parquet(out_path)
        _write_state(seeded.groupBy(*spec.keys).agg(F.max(spec.time).alias(spec.time)), state_path, batch_id)
        batch_pts.unpersist()

    return write


def late_rows_path(out_path: str) -> str:
    return f"{out_path.rstrip('/')}-late"


def late_rows(spark: SparkSession, out_path: str, spec: SeriesSpec = HOURLY, late_path: str | None = None) -> DataFrame:
    """Rows that came after later ones of their zone (keys and time); count them to see how many."""
    schema = T.StructType([f for f in _state_schema(spec).fields if f.name not in ("v", "slot")])
    return read_or_empty(spark, late_path or late_rows_path(out_path), schema).select(*spec.keys, spec.time)


def settled_gaps(spark: SparkSession, out_path: str, spec: SeriesSpec = HOURLY, late_path: str | None = None) -> DataFrame:
    """X5 output in the light of late rows: a gap with late points inside is cut by them.

    Equal to the batch gaps over all rows that have arrived, in whatever order. Late
    points meet the gaps of their zone by day (a gap covers the days it spans), so no
    zone is joined as a whole; points that hit no gap change nothing.
    """
    from loadlens.functions.expr import floor_to
    from loadlens.operators.quality import gap_micros, previous_time

    keys, t, prev = list(spec.keys), F.col(spec.time), F.col("previous_time")
    gaps = read_or_empty(spark, out_path, GAP_SCHEMA).select(*GAP_SCHEMA.fieldNames())
    late = late_rows(spark, out_path, spec, late_path).distinct().select(
        *[F.col(k).alias(f"_{k}") for k in keys], t.alias("_late"), floor_to(t, "day").alias("_late_day"))
    days = gaps.withColumn("_day", F.explode(F.sequence(floor_to(prev, "day"), floor_to(t, "day"), F.expr("INTERVAL 1 DAY"))))
    hit = days.join(late, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("_day") == F.col("_late_day")]).filter(
        (F.col("_late") > prev) & (F.col("_late") < t)).select(*keys, "previous_time", spec.time, F.col("_late").alias("_at"))
    same = [F.col(f"g.{c}").eqNullSafe(F.col(f"h.{c}")) for c in (*keys, "previous_time", spec.time)]
    whole = gaps.alias("g").join(hit.select(*keys, "previous_time", spec.time).distinct().alias("h"), same, "left_anti")
    ends = hit.select(*keys, F.explode(F.array("previous_time", "_at", spec.time)).alias("_t"), prev.alias("_from"))
    points = ends.select(*keys, F.col("_from"), F.col("_t").alias(spec.time)).distinct()
    inner = SeriesSpec(spec.time, (*spec.keys, "_from"), spec.value, spec.source, spec.ingested_at, spec.step, spec.step_seconds)
    lagged = previous_time(points, inner)
    diff = gap_micros(prev, t)
    cut = lagged.filter(prev.isNotNull() & (diff > F.lit(spec.step_seconds * 1_000_000))).select(
        *keys, "previous_time", spec.time, F.floor(diff / F.lit(1_000_000)).cast("bigint").alias("gap_seconds"))
    return whole.unionByName(cut)


def run_available_now(df: DataFrame, checkpoint: str, sink: str | None = None,
                      foreach_batch: Callable | None = None, mode: str = "append",
                      state_partitions: int | None = None) -> dict[str, int]:
    """Process everything that has arrived, then stop (one incremental run).

    Returns ``rows`` read and ``late_rows``, those that a watermark left out
    (``streaming.late`` brings them in). The other parameters are those of :func:`run_progress`.
    """
    progress = run_progress(df, checkpoint, sink, foreach_batch, mode, state_partitions)
    return {"rows": sum(p["numInputRows"] for p in progress), "late_rows": late_count(progress)}


def late_count(progress: list) -> int:
    """Rows that a watermark left out."""
    return sum(o["numRowsDroppedByWatermark"] for p in progress for o in p["stateOperators"])


def run_progress(df: DataFrame, checkpoint: str, sink: str | None = None, foreach_batch: Callable | None = None,
                 mode: str = "append", state_partitions: int | None = None) -> list:
    """One incremental run; the progress reports of its micro-batches.

    ``state_partitions`` fixes the shuffle/state-store partition count a new
    query starts with (it is then kept in the checkpoint); size it to the
    state, since adaptive execution does not resize stateful streaming stages.
    """
    spark = df.sparkSession
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    if state_partitions:
        spark.conf.set(key, str(state_partitions))
    try:  # held until the run ends: the first batch is planned after start() returns
        w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
        if foreach_batch is not None:
            q = w.foreachBatch(foreach_batch).start()
        else:
            q = w.format("parquet").option("path", sink).start()
        q.awaitTermination()
        return q.recentProgress
    finally:
        spark.conf.set(key, before)
