from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from loadlens.operators import clean, mart, quality
from loadlens.operators.combine import count_row, zip_rows


def test_zip_rows_fills_missing_with_nulls(spark):
    a = spark.range(3).agg(F.count(F.lit(1)).alias("n"))
    empty = spark.range(0).select(F.col("id").alias("last_id"))
    row = zip_rows(a, empty).collect()
    assert len(row) == 1 and (row[0]["n"], row[0]["last_id"]) == (3, None)
    with pytest.raises(ValueError):
        zip_rows(a, count_row(spark.range(1), "n"))


def test_zip_rows_by_group(spark):
    x = spark.createDataFrame([("a", 1), ("b", 2)], "k string, x int")
    y = spark.createDataFrame([("a", 10)], "k string, y int")
    out = sorted(tuple(r) for r in zip_rows(x, y, by=["k"]).collect())
    assert out == [("a", 1, 10), ("b", 2, None)]


def test_approx_distinct_option(spark, make_obs):
    raw = make_obs([(f"2024-01-{d:02d} {h:02d}:00:00", "SE", "Z1", 1.0) for d in range(1, 11) for h in range(24)])
    c = clean.clean_series(raw)
    exact = quality.actual_steps(c).first()["actual_hours"]
    approx = quality.actual_steps(c, approx=True).first()["actual_hours"]
    assert exact == 240 and abs(approx - exact) / exact < 0.1


def test_metrics_long_text_forms(spark, make_obs):
    raw = make_obs([("2024-01-01 00:00:00", "SE", "Z1", 10567.0)])
    wide = mart.system_metrics(clean.clean_series(raw))
    plain = {r["metric"]: r["value"] for r in mart.metrics_long(wide).collect()}
    fixed = {r["metric"]: r["value"] for r in mart.metrics_long(wide, text_scale=6).collect()}
    assert plain["peak_load_mw"] == "10567.0" and fixed["peak_load_mw"] == "10567.000000"
    assert plain["peak_time_utc"] == fixed["peak_time_utc"] == "2024-01-01 00:00:00"
