"""Mart layer: one wide row of system metrics and its metric/value long form.

Every metric is derived from one small pre-aggregate of clean per
(date, hour-of-day): at most 24 rows per day, whatever the data volume. The
exact mode sums DECIMAL values, which are associative, so two-level sums give
the same result as a direct average.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.fixed import SHAPE_HOURS, SUMMER_MONTHS, WINTER_MONTHS
from loadlens.functions.expr import exact_value
from loadlens.operators.combine import zip_rows
from loadlens.schema import HOURLY, SeriesSpec

WIDE_COLUMNS = [
    "avg_hourly_load_mw", "max_hourly_load_mw", "min_hourly_load_mw", "peak_time_utc",
    "peak_load_mw", "max_avg_daily_load_mw", "min_avg_daily_load_mw", "winter_peak_load_mw",
    "summer_peak_load_mw", "avg_midnight_load_mw", "avg_morning_load_mw", "avg_evening_load_mw",
]


def hour_cells(clean: DataFrame, spec: SeriesSpec = HOURLY, by: list[str] | None = None,
               exact_scale: int | None = None) -> DataFrame:
    """Partial aggregate per (by, date, hour): sum, count, max and min, all numeric,
    so every level above clean is a hash aggregate."""
    by = by or []
    v = F.col(spec.value)
    s = exact_value(v, exact_scale) if exact_scale is not None else v
    return clean.groupBy(*by, F.to_date(spec.time).alias("_d"), F.hour(spec.time).alias("_h")).agg(
        F.sum(s).alias("_s"), F.count(v).alias("_n"), F.max(v).alias("_mx"), F.min(v).alias("_mn"))


def _avg(s: Column, n: Column) -> Column:
    return s.cast("double") / n


def daily_extremes_from(cells: DataFrame, by: list[str]) -> DataFrame:
    """Daily average, then its maximum and minimum."""
    daily = cells.groupBy(*by, "_d").agg(_avg(F.sum("_s"), F.sum("_n")).alias("_davg"))
    return daily.groupBy(*by).agg(F.max("_davg").alias("max_avg_daily_load_mw"),
                                  F.min("_davg").alias("min_avg_daily_load_mw"))


def seasonal_peaks_from(cells: DataFrame, by: list[str]) -> DataFrame:
    """G7 + P10: conditional maxima over winter and summer months."""
    m = F.month("_d")
    return cells.groupBy(*by).agg(
        F.max(F.when(m.isin(*WINTER_MONTHS), F.col("_mx"))).alias("winter_peak_load_mw"),
        F.max(F.when(m.isin(*SUMMER_MONTHS), F.col("_mx"))).alias("summer_peak_load_mw"))


def curve_shape_from(cells: DataFrame, by: list[str]) -> DataFrame:
    """Hour-of-day average pivoted on the fixed shape hours."""
    hourly = cells.groupBy(*by, "_h").agg(_avg(F.sum("_s"), F.sum("_n")).alias("_havg"))
    return hourly.groupBy(*by).agg(*[
        F.max(F.when(F.col("_h") == h, F.col("_havg"))).alias(name) for name, h in SHAPE_HOURS.items()])


def peak_hour(clean: DataFrame, spec: SeriesSpec = HOURLY, by: list[str] | None = None) -> DataFrame:
    """The single highest-load point (0 rows on empty input, D16).

    Ties go to the earliest time, then country, then zone (D7); NaN is the highest
    load, as it is for the maximum. Without ``by`` every task keeps one row; per
    group the points at the group's maximum are picked first.
    """
    by = by or []
    v, found = F.col(spec.value), clean.filter(F.col(spec.value).isNotNull())
    order = [F.col(spec.time), *[F.col(k) for k in spec.keys]]
    if not by:
        top = found.orderBy(v.desc(), *order).limit(1)
        return top.select(F.col(spec.time).alias("peak_time_utc"), v.alias("peak_load_mw"))
    highest = found.groupBy(*by).agg(F.max(v).alias("peak_load_mw")).withColumnsRenamed({c: f"_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    at = found.join(highest, [*same, v == F.col("peak_load_mw")])
    return at.groupBy(*by, "peak_load_mw").agg(F.min(spec.time).alias("peak_time_utc")).select(*by, "peak_time_utc", "peak_load_mw")


def daily_extremes(clean: DataFrame, spec: SeriesSpec = HOURLY, by: list[str] | None = None,
                   exact_scale: int | None = None) -> DataFrame:
    by = by or []
    return daily_extremes_from(hour_cells(clean, spec, by, exact_scale), by)


def seasonal_peaks(clean: DataFrame, spec: SeriesSpec = HOURLY, by: list[str] | None = None) -> DataFrame:
    by = by or []
    return seasonal_peaks_from(hour_cells(clean, spec, by), by)


def curve_shape(clean: DataFrame, spec: SeriesSpec = HOURLY, by: list[str] | None = None,
                exact_scale: int | None = None) -> DataFrame:
    by = by or []
    return curve_shape_from(hour_cells(clean, spec, by, exact_scale), by)


def system_metrics(clean: DataFrame, spec: SeriesSpec = HOURLY, by: list[str] | None = None,
                   exact_scale: int | None = None) -> DataFrame:
    """Q6: the wide metric row; zero rows when clean is empty.

    Clean → (date, hour) cells → one grouping-sets aggregate giving the per-day,
    per-hour and overall levels together → one final row per ``by`` group, with
    the peak from a scan of its own (a top-1, no struct in the large aggregate). ``by=[]`` mixes all zones as the reference does; pass the
    zone keys for one row per zone.
    """
    by = by or []
    cells = hour_cells(clean, spec, by, exact_scale)
    m = F.month("_d")
    levels = cells.groupingSets([[*by, "_d"], [*by, "_h"], [*by]], *by, "_d", "_h").agg(
        F.sum("_s").alias("s"), F.sum("_n").alias("n"), F.max("_mx").alias("mx"),
        F.min("_mn").alias("mn"),
        F.max(F.when(m.isin(*WINTER_MONTHS), F.col("_mx"))).alias("wmx"),
        F.max(F.when(m.isin(*SUMMER_MONTHS), F.col("_mx"))).alias("smx"),
        F.grouping("_d").alias("gd"), F.grouping("_h").alias("gh"))
    day = (F.col("gd") == 0) & (F.col("gh") == 1)
    hour = (F.col("gd") == 1) & (F.col("gh") == 0)
    total = (F.col("gd") == 1) & (F.col("gh") == 1)
    avg = _avg(F.col("s"), F.col("n"))

    def at(level: Column, c: Column) -> Column:
        return F.when(level, c)

    wide = levels.groupBy(*by).agg(
        F.max(at(total, avg)).alias("avg_hourly_load_mw"),
        F.max(at(total, F.col("mx"))).alias("max_hourly_load_mw"),
        F.max(at(total, F.col("mn"))).alias("min_hourly_load_mw"),
        F.max(at(day, avg)).alias("max_avg_daily_load_mw"),
        F.min(at(day, avg)).alias("min_avg_daily_load_mw"),
        F.max(at(total, F.col("wmx"))).alias("winter_peak_load_mw"),
        F.max(at(total, F.col("smx"))).alias("summer_peak_load_mw"),
        *[F.max(at(hour & (F.col("_h") == h), avg)).alias(name) for name, h in SHAPE_HOURS.items()],
        F.max(at(total, F.col("n"))).alias("_rows"),
    )
    # one row per group on either side: a union and a maximum instead of a join
    both = zip_rows(wide.filter(F.col("_rows") > 0), peak_hour(clean, spec, by), by=by)
    return both.filter(F.col("_rows") > 0).select(*by, *WIDE_COLUMNS)


def _text(c: Column, dtype: str, text_scale: int | None) -> Column:
    if text_scale is not None and dtype == "double":
        return c.cast(f"decimal(38,{text_scale})").cast("string")
    return c.cast("string")


def metrics_long(wide: DataFrame, by: list[str] | None = None, text_scale: int | None = None) -> DataFrame:
    """Wide metrics to (metric, value) text rows; null values are kept.

    ``text_scale`` renders doubles as fixed-point decimals (engine-neutral text);
    by default Spark's own double text is used.
    """
    by = by or []
    types = dict(wide.dtypes)
    metrics = [c for c in wide.columns if c not in by]
    texted = wide.select(*by, *[_text(F.col(c), types[c], text_scale).alias(c) for c in metrics])
    return texted.unpivot(by, metrics, "metric", "value")
