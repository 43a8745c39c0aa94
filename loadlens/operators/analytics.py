"""Analytics layer: daily summary, baseline anomalies, hour-of-day profile, zone metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlens.functions.expr import exact_sum, mean, pct_deviation
from loadlens.fixed import ANOMALY_HIGH_FACTOR, ANOMALY_LOW_FACTOR, HIGH_ANOMALY, LOW_ANOMALY
from loadlens.schema import HOURLY, SeriesSpec

HIGH, LOW = HIGH_ANOMALY, LOW_ANOMALY


def daily_summary(clean: DataFrame, spec: SeriesSpec = HOURLY, exact_scale: int | None = None) -> DataFrame:
    """Per (keys, date) average, peak, minimum and point count."""
    v = F.col(spec.value)
    return clean.groupBy(*spec.keys, F.to_date(spec.time).alias("load_date")).agg(
        mean(v, exact_scale).alias("avg_load_mw"),
        F.max(v).alias("peak_load_mw"),
        F.min(v).alias("min_load_mw"),
        F.count(F.lit(1)).alias("hourly_points"),
    )


def daily_baseline(clean: DataFrame, spec: SeriesSpec = HOURLY, exact_scale: int | None = None) -> DataFrame:
    """Per (keys, date) average load."""
    return clean.groupBy(*spec.keys, F.to_date(spec.time).alias("load_date")).agg(
        mean(spec.value, exact_scale).alias("daily_avg_load_mw"))


def _classify(load, base, high: float, low: float) -> DataFrame:
    return F.when(load > base * F.lit(high), F.lit(HIGH)).when(load < base * F.lit(low), F.lit(LOW))


def _anomaly_rows(df: DataFrame, spec: SeriesSpec, high: float, low: float) -> DataFrame:
    load, base = F.col(spec.value), F.col("daily_avg_load_mw")
    return (df.filter((load > base * F.lit(high)) | (load < base * F.lit(low)))
            .select(*spec.keys, spec.time, "load_date", spec.value, "daily_avg_load_mw",
                    pct_deviation(load, base).alias("pct_deviation"),
                    _classify(load, base, high, low).alias("anomaly_type")))


def anomalies(clean: DataFrame, spec: SeriesSpec = HOURLY, high: float = ANOMALY_HIGH_FACTOR,
              low: float = ANOMALY_LOW_FACTOR,
              exact_scale: int | None = None, form: str = "window") -> DataFrame:
    """Compare each point with its (keys, day) average.

    ``form="window"``: one scan and one shuffle on (keys, date); a window
    partition is one zone-day, bounded by the grain because clean is unique
    per (time, keys). ``form="join"``: a partially aggregated baseline joined
    back (AQE splits skewed partitions); use it for inputs with copies of a key.
    """
    if form == "join":
        return anomalies_vs_baseline(clean, daily_baseline(clean, spec, exact_scale), spec, high, low)
    dated = clean.withColumn("load_date", F.to_date(spec.time))
    w = Window.partitionBy(*spec.keys, "load_date")
    if exact_scale is None:
        base = F.avg(spec.value).over(w)
    else:
        v = F.col(spec.value)
        base = exact_sum(v, exact_scale).over(w).cast("double") / F.count(v).over(w)
    return _anomaly_rows(dated.withColumn("daily_avg_load_mw", base), spec, high, low)


def anomalies_vs_baseline(clean: DataFrame, baseline: DataFrame, spec: SeriesSpec = HOURLY,
                          high: float = ANOMALY_HIGH_FACTOR, low: float = ANOMALY_LOW_FACTOR) -> DataFrame:
    """J1 join form, for a precomputed (keys, load_date, daily_avg_load_mw) baseline."""
    dated = clean.withColumn("load_date", F.to_date(spec.time))
    joined = dated.join(baseline, [*spec.keys, "load_date"], "inner")
    return _anomaly_rows(joined, spec, high, low)


def curve_profile(clean: DataFrame, spec: SeriesSpec = HOURLY, exact_scale: int | None = None) -> DataFrame:
    """Hour-of-day profile per keys (also the daily-fact hourly profile model)."""
    v = F.col(spec.value)
    return clean.groupBy(*spec.keys, F.hour(spec.time).alias("hour_of_day")).agg(
        mean(v, exact_scale).alias("avg_hourly_load_mw"),
        F.min(v).alias("min_hourly_load_mw"),
        F.max(v).alias("max_hourly_load_mw"),
        F.count(F.lit(1)).alias("observation_count"),
    )


def zone_metrics(clean: DataFrame, spec: SeriesSpec = HOURLY, exact_scale: int | None = None) -> DataFrame:
    """Per-zone average, maximum, minimum."""
    v = F.col(spec.value)
    return clean.groupBy(*spec.keys).agg(
        mean(v, exact_scale).alias("avg_load"), F.max(v).alias("max_load"), F.min(v).alias("min_load"))
