"""X2 with nothing lost: the watermarked downsample, and the hours of rows that came behind the watermark.

One run (:func:`downsample_run`) does three things in turn:

1. ``land``: what has arrived goes to a raw table by (arrival, month). An arrival is
   a micro-batch; a retried one replaces its own files.
2. ``downsample``: the streaming aggregate over the raw table, upserted hour by hour.
   Rows behind its watermark are dropped by Spark, which says how many in its progress.
3. ``repair``: if some were dropped, the run's rows behind the watermark go to a side
   table, and their hours are computed again from raw (the touched months only) and
   upserted. An hour behind the watermark is never emitted again by the aggregate, so
   the repaired value stays until the next late row of that hour.

A mark says up to which arrival all is settled and whether a run is under way. A run
that ended between 2 and 3 leaves it open; the next run then repairs every hour of
the arrivals that are not settled, whatever the watermark was.

Cases: rows without time or key are landed and belong to no hour; invalid rows (P1)
are landed only; no new rows, or an empty folder, change nothing; equal rows count
each, as in the batch operator.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.functions.expr import floor_to
from loadlens.operators import tables
from loadlens.operators.clean import clean_series, valid_rows
from loadlens.schema import HOURLY, SeriesSpec
from loadlens.session import child_names, path_exists, read_or_empty, read_version, write_version
from loadlens.streaming import stream as st

ARRIVAL, MONTH = "arrival", "month"
MARK_SCHEMA = T.StructType([T.StructField("settled", T.LongType()), T.StructField("running", T.BooleanType())])
#: Spark keeps this many progress reports of a query; a run with as many batches may have lost some.
PROGRESS_KEY = "spark.sql.streaming.numRecentProgressUpdates"


def stored_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(ARRIVAL, T.LongType()), T.StructField(MONTH, T.StringType())])


def landing_sink(path: str, spec: SeriesSpec = HOURLY) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer of the raw table: a micro-batch is one arrival."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn(ARRIVAL, F.lit(batch_id).cast("long")).withColumn(MONTH, F.date_format(spec.time, "yyyy-MM"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(ARRIVAL, MONTH).parquet(path))
    return write


def behind(progress: list, limit: int) -> tuple[bool, _dt.datetime | None]:
    """Whether a run dropped rows, and the watermark behind which they were (None: not known)."""
    marks = [_dt.datetime.fromisoformat(p["eventTime"]["watermark"]).replace(tzinfo=None)
             for p in progress if any(o["numRowsDroppedByWatermark"] for o in p["stateOperators"])]
    if len(progress) >= limit:
        return True, None
    return bool(marks), max(marks, default=None)


def hours_again(raw: DataFrame, late: DataFrame, spec: SeriesSpec = HOURLY, exact_scale: int | None = None) -> DataFrame:
    """The clean rows of all hours that ``late`` touches, from the raw rows of these hours.

    The touched months, as many as the late rows' time span has at most, prune the scan of raw as literals.
    """
    months = [r[0] for r in late.select(MONTH).distinct().collect()]
    hour = floor_to(F.col(spec.time), "hour")
    touched = late.select(MONTH, *spec.keys, hour.alias("_hour")).distinct()
    whole = raw.where(F.col(MONTH).isin(months)).withColumn("_hour", hour).join(touched, [MONTH, *spec.keys, "_hour"], "left_semi")
    return clean_series(whole, spec, exact_scale=exact_scale)


def repair(spark: SparkSession, root: str, schema: T.StructType, arrived: Column, watermark: _dt.datetime | None,
           spec: SeriesSpec = HOURLY, exact_scale: int | None = None, zone_parts: int = 16) -> None:
    """Step 3 for the raw rows of the condition ``arrived`` whose hour ends behind ``watermark`` (None: all of them)."""
    raw = valid_rows(spark.read.schema(stored_schema(schema)).parquet(f"{root}/raw"), spec).where(F.col(spec.time).isNotNull())
    late = raw.where(arrived)
    if watermark is not None:
        bound = F.lit(watermark.isoformat(sep=" ")).cast("timestamp_ntz")
        late = late.where(F.timestamp_add("HOUR", F.lit(1), floor_to(F.col(spec.time), "hour")) <= bound)
    (late.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(ARRIVAL, MONTH).parquet(f"{root}/late"))
    kept = read_or_empty(spark, f"{root}/late", stored_schema(schema)).where(arrived)
    tables.upsert_table(spark, hours_again(raw, kept, spec, exact_scale), f"{root}/clean", spec.key_time, zone_parts=zone_parts)


def downsample_run(stream: DataFrame, root: str, spec: SeriesSpec = HOURLY, watermark: str = "2 hours",
                   exact_scale: int | None = None, zone_parts: int = 16, state_partitions: int | None = None) -> dict:
    """Process all that has arrived: ``<root>/clean`` then equals the batch downsample of every row so far.

    Returns ``late_rows``, the number that the watermark dropped (after partial aggregation,
    so copies within an hour may count once), and ``repaired``, whether hours were computed again.
    """
    spark, raw = stream.sparkSession, f"{root}/raw"
    st.run_available_now(stream, f"{root}/landing-checkpoint", foreach_batch=landing_sink(raw, spec))
    landed = [int(n.split("=")[1]) for n in child_names(spark, raw) if n.startswith(f"{ARRIVAL}=")] if path_exists(spark, raw) else []
    if not landed:
        return {"late_rows": 0, "repaired": False}
    mark = read_version(spark, f"{root}/mark", MARK_SCHEMA).first() or (-1, False)
    settled, broken = mark[0], mark[1]

    def set_mark(upto: int, running: bool) -> None:
        write_version(spark.createDataFrame([(upto, running)], MARK_SCHEMA).coalesce(1), f"{root}/mark")

    set_mark(settled, True)
    # only the raw columns are read: the aggregate knows nothing of arrivals
    rows = spark.readStream.schema(stored_schema(stream.schema)).parquet(raw).drop(ARRIVAL, MONTH)
    progress = st.run_progress(st.hourly_downsample(rows, spec, watermark, exact_scale), f"{root}/downsample-checkpoint",
                               foreach_batch=st.upsert_sink(spark, f"{root}/clean", spec.key_time, zone_parts), mode="update",
                               state_partitions=state_partitions)
    dropped, bound = behind(progress, int(spark.conf.get(PROGRESS_KEY, "100")))
    if broken or dropped:
        arrived = F.col(ARRIVAL).between(settled + 1, max(landed))
        repair(spark, root, stream.schema, arrived, None if broken else bound, spec, exact_scale, zone_parts)
    set_mark(max(landed), False)
    return {"late_rows": st.late_count(progress), "repaired": broken or dropped}
