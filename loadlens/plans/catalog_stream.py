"""Streaming queries (X1–X5), each checked against its batch equivalent.

The events table is replayed as a stream in time order: it is cut into four
consecutive time slices; each slice is appended to a source folder and picked
up by one ``availableNow`` run of the same query (same checkpoint), so state
is carried across several micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.functions.expr import floor_to
from loadlens.plans.catalog import EXACT, query
from loadlens.schema import HOURLY
from loadlens.session import scratch_path
from loadlens.sources import market_xml as mx
from loadlens.sources import testdata as td
from loadlens.streaming import late
from loadlens.streaming import stream as st

N_SLICES = 4


def _slice_edges(spark: SparkSession, df: DataFrame, by: str) -> list:
    """Day-aligned edges cutting the data's time range into N_SLICES pieces."""
    lo, hi = df.agg(F.min(floor_to(F.col(by), "day")), F.max(by)).first()
    if lo is None:
        return []
    days = (hi - lo).days + 1
    width = max(1, -(-days // N_SLICES))
    import datetime as dt
    return [lo + dt.timedelta(days=width * k) for k in range(N_SLICES + 1)]


def _replay(spark: SparkSession, source: DataFrame, name: str,
            write_slice: Callable[[DataFrame, str], None],
            start_query: Callable[[str, str], None], by: str = "time_utc") -> str:
    """Append each slice of the times ``by`` to a source folder and run the stream once per slice."""
    src = scratch_path(spark, f"{name}-src")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    edges = _slice_edges(spark, source, by)
    for a, b in zip(edges, edges[1:]):
        t = F.col(by)
        lo, hi = (F.lit(x.isoformat(sep=" ")).cast("timestamp_ntz") for x in (a, b))  # zone-free literals
        piece = source.filter((t >= lo) & (t < hi))
        write_slice(piece, src)
        start_query(src, ckpt)
    return src


def _state_partitions(spark: SparkSession) -> int:
    """State-store partitions for the replay: the session's parallelism (small state)."""
    return spark.sparkContext.defaultParallelism


def _parquet_slice(piece: DataFrame, src: str) -> None:
    piece.write.mode("append").parquet(src)


@query("stream_clean_hourly")
def q_stream_clean_hourly(spark, sf):
    """X2 + X4: streaming hourly downsample, upserted per micro-batch."""
    obs = td.obs(spark, sf)
    table = scratch_path(spark, "stream-clean")

    def run(src: str, ckpt: str) -> None:
        stream = spark.readStream.schema(obs.schema).parquet(src)
        st.run_available_now(st.hourly_downsample(stream, exact_scale=EXACT), ckpt,
                             foreach_batch=st.upsert_sink(spark, table, HOURLY.key_time), mode="update",
                             state_partitions=_state_partitions(spark))

    _replay(spark, obs, "clean", _parquet_slice, run)
    return spark.read.parquet(table).drop("month", "zone_part")


@query("stream_late_hours")
def q_stream_late_hours(spark, sf):
    """X2 with late rows: every fifth observation arrives three days after its time, far behind the watermark."""
    obs = td.obs(spark, sf, with_order=True)
    wait = F.when(F.col("event_id") % 5 == 0, F.lit(3)).otherwise(F.lit(0))
    arriving = obs.withColumn("arrival_time", F.timestamp_add("DAY", wait, F.col("time_utc")))
    root = scratch_path(spark, "stream-late")
    schema = obs.drop("event_id").schema

    def run(src: str, ckpt: str) -> None:  # noqa: ARG001 - the checkpoints lie under the root
        late.downsample_run(spark.readStream.schema(schema).parquet(src), root, exact_scale=EXACT, zone_parts=1,
                            state_partitions=_state_partitions(spark))

    _replay(spark, arriving, "late", lambda piece, src: _parquet_slice(piece.drop("event_id", "arrival_time"), src), run, by="arrival_time")
    return spark.read.parquet(f"{root}/clean").drop("month", "zone_part")


@query("stream_time_gaps")
def q_stream_time_gaps(spark, sf):
    """Online gap detection over raw observations."""
    obs = td.obs(spark, sf)
    sink = scratch_path(spark, "stream-gaps")
    state = scratch_path(spark, "stream-gaps-state")

    def run(src: str, ckpt: str) -> None:
        stream = spark.readStream.schema(obs.schema).parquet(src)
        st.run_available_now(stream, ckpt, foreach_batch=st.gap_detector_sink(spark, state, sink))

    _replay(spark, obs, "gaps", _parquet_slice, run)
    return st.settled_gaps(spark, sink)


@query("stream_dedupe_keys")
def q_stream_dedupe_keys(spark, sf):
    """First row per (hour, zone) within the watermark, by event id."""
    oh = td.obs_hour(spark, sf, with_order=True)
    sink = scratch_path(spark, "stream-dedupe")
    state = scratch_path(spark, "stream-dedupe-state")

    def run(src: str, ckpt: str) -> None:
        stream = spark.readStream.schema(oh.schema).parquet(src)
        st.run_available_now(stream, ckpt, foreach_batch=st.dedupe_sink(spark, state, sink, order_col="event_id"))

    _replay(spark, oh, "dedupe", _parquet_slice, run)
    return spark.read.parquet(sink).select(*HOURLY.key_time, "load_mw", "event_id")


@query("stream_xml_points")
def q_stream_xml_points(spark, sf):
    """Landing documents arriving slice by slice, flattened incrementally."""
    from loadlens.plans.catalog_ingest import landing_points
    pts = landing_points(spark, sf)
    sink = scratch_path(spark, "stream-xml")

    def write(piece: DataFrame, src: str) -> None:
        docs = mx.to_documents(piece)
        (docs.write.mode("append").partitionBy(*mx.ZONE_KEYS).format("xml")
         .option("rowTag", "TimeSeries").option("rootTag", mx.DOCUMENT_ROOT).save(src))

    def run(src: str, ckpt: str) -> None:
        st.run_available_now(mx.flatten_points(st.xml_landing_stream(spark, src)), ckpt, sink=sink)

    _replay(spark, pts, "xml", write, run)
    return spark.read.parquet(sink)
