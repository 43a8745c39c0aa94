"""A zone holding a third of all rows must not land in one task.

Rows per partition are read with ``spark_partition_id()`` right after the
stage under test (adaptive coalescing off, so partitions are the shuffle's).
"""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loadlens.operators import quality
from loadlens.schema import RAW_SCHEMA

HOT_DAYS = 200


@pytest.fixture
def skewed(spark):
    base = dt.datetime(2024, 1, 1)
    hot = [(base + dt.timedelta(hours=h), "XX", "HOT", 1.0, None, None) for h in range(24 * HOT_DAYS)]
    cold = [(base + dt.timedelta(hours=h * 7 % (24 * HOT_DAYS)), f"C{z}", "Z", 1.0, None, None)
            for z in range(30) for h in range(len(hot) * 2 // 30)]
    df = spark.createDataFrame(hot + cold, RAW_SCHEMA)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield df
    spark.conf.set(key, before)


def _max_share(df, used: str) -> float:
    """Largest share of rows in one partition; ``used`` is aggregated so the
    stage computing it is not pruned away."""
    counts = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("pid"))
              .agg(F.count(F.lit(1)).alias("n"), F.max(used).alias("m")).collect()]
    return max(counts) / sum(counts)


def test_bucketed_lag_spreads_hot_zone(skewed):
    pts = skewed.select("country_code", "bidding_zone", "time_utc")
    plain = pts.withColumn("p", F.lag("time_utc").over(
        Window.partitionBy("country_code", "bidding_zone").orderBy("time_utc")))
    assert _max_share(plain, "p") >= 1 / 3  # the naive plan: the hot zone is one task
    assert _max_share(quality.previous_time(pts), "previous_time") < 0.25


def test_spine_spreads_hot_zone(spark, skewed):
    spine = quality.expected_spine(skewed, chunk_steps=256)
    assert spine.filter(F.col("bidding_zone") == "HOT").count() == 24 * HOT_DAYS
    assert _max_share(spine, "expected_time") < 0.25
    # also with adaptive coalescing on: the chunk rows are tiny before the explode
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "true")
    assert _max_share(quality.expected_spine(skewed, chunk_steps=256), "expected_time") < 0.25
