"""Analytics and mart layers from stored partial aggregates, month by month.

Two small tables hold what the layers need of clean: one row for each (keys, date)
and one for each (keys, month, hour of day), with sum, counts, extremes and the time
of the peak. They are partitioned by month. After an upsert only the months it touched
are aggregated again (``update_cells`` reads just their partitions of clean and
overwrites just their cells); every layer is then a merge of cells, whose number grows
with zones and days and not with observations.

Sums are DECIMAL with ``exact_scale``, so merged averages equal those of a full build
bit for bit; without it they are doubles that may differ in the last bits. A month's
cells are recomputed from its whole partition, so running an update again, or after a
crash, gives the same tables. One writer per table, as for ``upsert_table``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlens.fixed import SHAPE_HOURS, SUMMER_MONTHS, WINTER_MONTHS
from loadlens.functions.expr import exact_value
from loadlens.operators.combine import zip_rows
from loadlens.operators.mart import WIDE_COLUMNS
from loadlens.schema import HOURLY, SeriesSpec
from loadlens.session import read_or_empty

MONTH = "month"
#: Write tasks of one month's cells.
ZONE_PARTS = 16


@dataclass(frozen=True)
class Cells:
    """The two stored tables: ``day`` (keys, load_date) and ``hour`` (keys, month, hour_of_day)."""

    day: DataFrame
    hour: DataFrame


def _value(spec: SeriesSpec, exact_scale: int | None) -> Column:
    v = F.col(spec.value)
    return v if exact_scale is None else exact_value(v, exact_scale)


def _schema(spec: SeriesSpec, grain: list[T.StructField], exact_scale: int | None, peak: bool) -> T.StructType:
    total = T.DoubleType() if exact_scale is None else T.DecimalType(28, exact_scale)
    return T.StructType([
        *[T.StructField(k, T.StringType()) for k in spec.keys], *grain, T.StructField("s", total), T.StructField("n", T.LongType()),
        T.StructField("n_rows", T.LongType()), T.StructField("mx", T.DoubleType()), T.StructField("mn", T.DoubleType()),
        *([T.StructField("peak_time", T.TimestampNTZType())] if peak else []), T.StructField(MONTH, T.StringType())])


def _schemas(spec: SeriesSpec, exact_scale: int | None) -> tuple[T.StructType, T.StructType]:
    return (_schema(spec, [T.StructField("load_date", T.DateType())], exact_scale, True),
            _schema(spec, [T.StructField("hour_of_day", T.IntegerType())], exact_scale, False))


def _measures(spec: SeriesSpec, exact_scale: int | None) -> list[Column]:
    v = F.col(spec.value)
    return [F.sum(_value(spec, exact_scale)).alias("s"), F.count(v).alias("n"), F.count(F.lit(1)).alias("n_rows"),
            F.max(v).alias("mx"), F.min(v).alias("mn")]


def day_cells(clean: DataFrame, spec: SeriesSpec = HOURLY, exact_scale: int | None = None) -> DataFrame:
    """Per (keys, date); ``peak_time`` is the earliest time of the day's maximum."""
    v, t = F.col(spec.value), F.col(spec.time)
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), t)
    peak = F.max(F.when(v.isNotNull(), F.struct(v.alias("v"), (-micros).alias("m"), t.alias("t"))))
    return clean.groupBy(*spec.keys, F.to_date(t).alias("load_date")).agg(
        *_measures(spec, exact_scale), peak.alias("_peak")).withColumns({
            "peak_time": F.col("_peak.t"), MONTH: F.date_format("load_date", "yyyy-MM")}).drop("_peak")


def hour_cells(clean: DataFrame, spec: SeriesSpec = HOURLY, exact_scale: int | None = None) -> DataFrame:
    """Per (keys, month, hour of day)."""
    t = F.col(spec.time)
    return clean.groupBy(*spec.keys, F.date_format(t, "yyyy-MM").alias(MONTH), F.hour(t).alias("hour_of_day")).agg(
        *_measures(spec, exact_scale))


def read_cells(spark: SparkSession, path: str, spec: SeriesSpec = HOURLY, exact_scale: int | None = None) -> Cells:
    """The stored cells (empty before the first update)."""
    day, hour = _schemas(spec, exact_scale)
    return Cells(read_or_empty(spark, f"{path}/day", day), read_or_empty(spark, f"{path}/hour", hour))


def touched_months(rows: DataFrame, spec: SeriesSpec = HOURLY) -> list[str]:
    """Months that a batch of rows touches (a value for each month, so a short list)."""
    found = rows.where(F.col(spec.time).isNotNull()).select(F.date_format(spec.time, "yyyy-MM").alias(MONTH)).distinct()
    return sorted(r[0] for r in found.collect())


def months_of(clean: DataFrame, months: list[str], spec: SeriesSpec = HOURLY) -> DataFrame:
    """The rows of some months; a table partitioned by ``month`` is read in their partitions alone."""
    by_time = F.date_format(spec.time, "yyyy-MM").isin(months)
    return clean.where(F.col(MONTH).isin(months)) if MONTH in clean.columns else clean.where(by_time)


def update_cells(clean: DataFrame, path: str, months: list[str] | None = None, spec: SeriesSpec = HOURLY,
                 exact_scale: int | None = None) -> Cells:
    """Aggregate the given months of clean again (all without ``months``) and overwrite their cells.

    ``clean`` as ``upsert_table`` returns it, with its ``month`` partitions. Rows
    without a time belong to no month and are left out.
    """
    spark = clean.sparkSession
    rows = clean.where(F.col(spec.time).isNotNull())
    if months is not None:
        rows = months_of(rows, months, spec)
    if months != []:
        rows = rows.select(*spec.keys, spec.time, spec.value)
        for name, make, schema in zip(("day", "hour"), (day_cells, hour_cells), _schemas(spec, exact_scale), strict=True):
            cells = make(rows, spec, exact_scale).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
            part = F.pmod(F.xxhash64(*spec.keys), F.lit(ZONE_PARTS))
            (cells.repartition(MONTH, part).sortWithinPartitions(MONTH, *spec.keys)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(f"{path}/{name}"))
    return read_cells(spark, path, spec, exact_scale)


# ---------------------------------------------------------------- layers

def _avg(s: Column, n: Column) -> Column:
    return s.cast("double") / n


def daily_summary(cells: Cells, spec: SeriesSpec = HOURLY) -> DataFrame:
    """G2 as ``analytics.daily_summary``."""
    return cells.day.select(*spec.keys, "load_date", _avg(F.col("s"), F.col("n")).alias("avg_load_mw"),
                            F.col("mx").alias("peak_load_mw"), F.col("mn").alias("min_load_mw"), F.col("n_rows").alias("hourly_points"))


def daily_baseline(cells: Cells, spec: SeriesSpec = HOURLY) -> DataFrame:
    """What ``analytics.anomalies_vs_baseline`` compares with."""
    return cells.day.select(*spec.keys, "load_date", _avg(F.col("s"), F.col("n")).alias("daily_avg_load_mw"))


def curve_profile(cells: Cells, spec: SeriesSpec = HOURLY) -> DataFrame:
    """G4 as ``analytics.curve_profile``."""
    return cells.hour.groupBy(*spec.keys, "hour_of_day").agg(
        _avg(F.sum("s"), F.sum("n")).alias("avg_hourly_load_mw"), F.min("mn").alias("min_hourly_load_mw"),
        F.max("mx").alias("max_hourly_load_mw"), F.sum("n_rows").alias("observation_count"))


def zone_metrics(cells: Cells, spec: SeriesSpec = HOURLY) -> DataFrame:
    """G14 as ``analytics.zone_metrics``."""
    return cells.day.groupBy(*spec.keys).agg(_avg(F.sum("s"), F.sum("n")).alias("avg_load"),
                                             F.max("mx").alias("max_load"), F.min("mn").alias("min_load"))


def peak_hour(cells: Cells, spec: SeriesSpec = HOURLY, by: list[str] | None = None) -> DataFrame:
    """T1 as ``mart.peak_hour``: ties go to the earliest time, then country, then zone."""
    found = cells.day.where("mx IS NOT NULL").select(*spec.keys, F.col("peak_time").alias("peak_time_utc"), F.col("mx").alias("peak_load_mw"))
    if not by:
        order = [F.col("peak_load_mw").desc(), F.col("peak_time_utc"), *[F.col(k) for k in spec.keys]]
        return found.orderBy(*order).limit(1).select("peak_time_utc", "peak_load_mw")
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("peak_time_utc"))
    best = found.groupBy(*by).agg(F.max(F.struct("peak_load_mw", (-micros).alias("m"), "peak_time_utc")).alias("p"))
    return best.select(*by, "p.peak_time_utc", "p.peak_load_mw")


def system_metrics(cells: Cells, spec: SeriesSpec = HOURLY, by: list[str] | None = None) -> DataFrame:
    """Q6 as ``mart.system_metrics``; no row when there are no cells."""
    by = by or []
    m = F.month("load_date")
    total = cells.day.groupBy(*by).agg(
        _avg(F.sum("s"), F.sum("n")).alias("avg_hourly_load_mw"), F.max("mx").alias("max_hourly_load_mw"),
        F.min("mn").alias("min_hourly_load_mw"), F.max(F.when(m.isin(*WINTER_MONTHS), F.col("mx"))).alias("winter_peak_load_mw"),
        F.max(F.when(m.isin(*SUMMER_MONTHS), F.col("mx"))).alias("summer_peak_load_mw"), F.sum("n").alias("_rows"))
    daily = cells.day.groupBy(*by, "load_date").agg(_avg(F.sum("s"), F.sum("n")).alias("a"))
    extremes = daily.groupBy(*by).agg(F.max("a").alias("max_avg_daily_load_mw"), F.min("a").alias("min_avg_daily_load_mw"))
    hourly = cells.hour.groupBy(*by, "hour_of_day").agg(_avg(F.sum("s"), F.sum("n")).alias("a"))
    shape = hourly.groupBy(*by).agg(*[F.max(F.when(F.col("hour_of_day") == h, F.col("a"))).alias(name) for name, h in SHAPE_HOURS.items()])
    every = zip_rows(total, extremes, shape, peak_hour(cells, spec, by), by=by)
    return every.where("_rows > 0").select(*by, *WIDE_COLUMNS)
