"""Clean layer: validity filter, source default, downsample to a fixed grain."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.functions.expr import exact_sum, floor_to
from loadlens.schema import DEFAULT_SOURCE, HOURLY, SeriesSpec


def valid_condition(spec: SeriesSpec = HOURLY, reject_nan: bool = False) -> Column:
    v = F.col(spec.value)
    cond = v.isNotNull() & (v >= 0)
    if reject_nan:
        cond = cond & ~F.isnan(v)
    return cond


def valid_rows(df: DataFrame, spec: SeriesSpec = HOURLY, reject_nan: bool = False) -> DataFrame:
    """Load present and not negative (NaN passes unless ``reject_nan``)."""
    return df.filter(valid_condition(spec, reject_nan))


def invalid_rows(df: DataFrame, spec: SeriesSpec = HOURLY) -> DataFrame:
    """Rows whose load is null or negative, as (keys, time, load)."""
    v = F.col(spec.value)
    return df.filter(v.isNull() | (v < 0)).select(*spec.keys, spec.time, spec.value)


def clean_series(raw: DataFrame, spec: SeriesSpec = HOURLY, grain: str | None = "hour",
                 default_source: str = DEFAULT_SOURCE, exact_scale: int | None = None,
                 reject_nan: bool = False) -> DataFrame:
    """G1 (+P1, P3): valid rows averaged per (grain bucket, keys).

    ``grain=None`` keeps rows one-to-one (only filter and source default).
    The aggregate is a plain groupBy, so Spark combines map-side first and a
    hot zone never lands whole in one task.
    """
    valid = valid_rows(raw, spec, reject_nan)
    if grain is None:
        return valid.select(
            spec.time, *spec.keys, spec.value,
            F.coalesce(F.col(spec.source), F.lit(default_source)).alias(spec.source),
            spec.ingested_at,
        )
    bucket = floor_to(F.col(spec.time), grain).alias(spec.time)
    key = [spec.time, *spec.keys]
    # One scan, two hash aggregates. A string max would turn the large aggregate
    # into a sort aggregate, so the label is a grouping key there (one label for
    # a bucket as a rule) and its maximum is taken over the few rows that leave it.
    # Sums and counts of the labels add up to those of the bucket.
    value = F.col(spec.value)
    total = F.sum(value) if exact_scale is None else exact_sum(value, exact_scale)
    by_label = valid.groupBy(bucket, *spec.keys, F.col(spec.source).alias("_label")).agg(
        total.alias("_sum"), F.count(value).alias("_n"), F.max(spec.ingested_at).alias(spec.ingested_at))
    merged = by_label.groupBy(*key).agg(
        F.sum("_sum").alias("_sum"), F.sum("_n").alias("_n"), F.max(spec.ingested_at).alias(spec.ingested_at),
        F.max("_label").alias("_label"))
    return merged.select(
        *key, (F.col("_sum").cast("double") / F.col("_n")).alias(spec.value),
        F.coalesce(F.col("_label"), F.lit(default_source)).alias(spec.source),
        spec.ingested_at,
    )
