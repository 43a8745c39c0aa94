from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadlens.functions import expr as X


def _one(spark, col, value="2024-05-17 13:47:21.5", dtype="timestamp_ntz"):
    df = spark.createDataFrame([(value,)], "s string").select(F.col("s").cast(dtype).alias("t"))
    return df.select(col).first()[0]


@pytest.mark.parametrize("unit,expected", [
    ("hour", dt.datetime(2024, 5, 17, 13)), ("day", dt.datetime(2024, 5, 17)),
    ("month", dt.datetime(2024, 5, 1)), ("quarter", dt.datetime(2024, 4, 1)), ("year", dt.datetime(2024, 1, 1)),
])
def test_floor_to_units(spark, unit, expected):
    assert _one(spark, X.floor_to(F.col("t"), unit)) == expected


def test_floor_to_ignores_session_zone(spark):
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, "Asia/Kolkata")
    try:
        assert _one(spark, X.floor_to(F.col("t"), "hour")) == dt.datetime(2024, 5, 17, 13)
        back = _one(spark, X.instant_to_ntz(X.ntz_to_instant(F.col("t"))))
        assert back == dt.datetime(2024, 5, 17, 13, 47, 21, 500000)
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("secs,text", [(7200, "02:00:00"), (3661, "01:01:01"), (86400 + 3600, "1 day 01:00:00"),
                                       (3 * 86400 + 59, "3 days 00:00:59")])
def test_interval_text(spark, secs, text):
    assert spark.range(1).select(X.interval_text(F.lit(secs).cast("bigint"))).first()[0] == text


def test_resolution_minutes_and_failure(spark):
    df = spark.createDataFrame([("PT60M",), ("PT15M",), (None,)], "r string")
    assert [r[0] for r in df.select(X.resolution_minutes(F.col("r"))).collect()] == [60, 15, None]
    with pytest.raises(Exception):
        spark.createDataFrame([("PT5M",)], "r string").select(X.resolution_minutes(F.col("r"))).collect()


def test_pct_deviation_and_zero_base(spark):
    row = spark.range(1).select(X.pct_deviation(F.lit(11.0), F.lit(8.0)).alias("a"),
                                X.pct_deviation(F.lit(1.0), F.lit(0.0)).alias("b")).first()
    assert (row["a"], row["b"]) == (37.5, None)


def test_exact_mean_is_order_independent(spark):
    vals = [0.1, 0.2, 0.3, 1e6 + 0.000001, 7.7]
    a = spark.createDataFrame([(v,) for v in vals], "v double").repartition(3)
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "v double").coalesce(1)
    assert a.select(X.mean("v", 6)).first()[0] == b.select(X.mean("v", 6)).first()[0]


def test_epoch_span_steps(spark):
    got = spark.range(1).select(X.epoch_span_steps(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
                                                   F.lit("2024-01-02 00:00:00").cast("timestamp_ntz"), 3600)).first()[0]
    assert got == 25
