"""Layers from stored cells against the layers built from all of clean."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import ts
from pyspark.sql import functions as F

from loadlens.operators import analytics, cells, clean as clean_ops, mart, tables
from loadlens.schema import HOURLY
from loadlens.session import scratch_path

ZONES = ["country_code", "bidding_zone"]


@pytest.fixture(scope="module")
def points():
    """Five months over a change of year, three zones, equal peaks, holes, and null keys."""
    rnd = random.Random(11)
    out = []
    for zone in ("Z0", "Z1", None):
        for i in range(0, 24 * 140, 5):
            out.append((ts("2023-11-03T00:00:00") + dt.timedelta(hours=i), "SE", zone, float(rnd.choice([5, 7, 90, 90.25, 1e6]))))
    return out


def same(found, expected):
    cols = sorted(expected.columns)
    key = lambda df: sorted(map(str, df.select(cols).collect()))
    assert key(found) == key(expected)


def check_layers(made, clean):
    same(cells.daily_summary(made), analytics.daily_summary(clean, exact_scale=6))
    same(cells.daily_baseline(made), analytics.daily_baseline(clean, exact_scale=6))
    same(cells.curve_profile(made), analytics.curve_profile(clean, exact_scale=6))
    same(cells.zone_metrics(made), analytics.zone_metrics(clean, exact_scale=6))
    for by in ([], ["bidding_zone"], ZONES):
        same(cells.system_metrics(made, by=by), mart.system_metrics(clean, by=by, exact_scale=6))
        same(cells.peak_hour(made, by=by), mart.peak_hour(clean, by=by))


def test_layers_of_a_table_equal_a_full_build_after_every_update(spark, make_obs, points):
    path, stored = scratch_path(spark, "clean"), scratch_path(spark, "cells")
    batches = [points[::2], points[1::4], [(t, c, z, v + 3) for t, c, z, v in points[:60]],
               [(ts("2024-06-01T00:00:00"), "SE", "Z0", 2e6), (ts("2024-06-01T01:00:00"), "SE", "Z0", 2e6)]]
    for batch in batches:
        fresh = clean_ops.clean_series(make_obs(batch), exact_scale=6)
        clean = tables.upsert_table(spark, fresh, path, HOURLY.key_time, zone_parts=3)
        made = cells.update_cells(clean, stored, cells.touched_months(fresh), exact_scale=6)
        check_layers(made, clean)
    again = cells.update_cells(clean, stored, cells.touched_months(fresh), exact_scale=6)
    check_layers(again, clean)


def test_an_update_reads_and_writes_the_touched_months_only(spark, make_obs, points):
    path, stored = scratch_path(spark, "clean"), scratch_path(spark, "cells")
    clean = tables.upsert_table(spark, clean_ops.clean_series(make_obs(points), exact_scale=6), path, HOURLY.key_time)
    cells.update_cells(clean, stored, exact_scale=6)
    months = sorted(r[0] for r in clean.select("month").distinct().collect())
    files = {r[0] for r in spark.read.parquet(f"{stored}/day").select(F.input_file_name()).distinct().collect()}
    cells.update_cells(clean, stored, months[1:2], exact_scale=6)
    later = {r[0] for r in spark.read.parquet(f"{stored}/day").select(F.input_file_name()).distinct().collect()}
    assert {f for f in files if f"month={months[1]}" not in f} == {f for f in later if f"month={months[1]}" not in f}
    assert not {f for f in files if f"month={months[1]}" in f} & later
    rows = cells.months_of(clean, months[1:2])
    assert {r[0] for r in rows.select(F.regexp_extract(F.input_file_name(), "month=([^/]*)", 1)).distinct().collect()} == {months[1]}
    scan = next(x for x in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "PartitionFilters" in x)
    assert "month#" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_odd_values_and_empty_tables(spark, make_obs):
    rows = make_obs([(ts("2024-01-01T00:00:00"), "SE", "Z0", None), (ts("2024-01-01T01:00:00"), "SE", "Z0", float("nan")),
                     (ts("2024-01-02T00:00:00"), "SE", "Z1", None), (None, "SE", "Z0", 5.0), (ts("2024-02-01T00:00:00"), "SE", "Z0", 4.0)])
    made = cells.update_cells(rows, scratch_path(spark, "cells"))
    dated = rows.where("time_utc IS NOT NULL")
    same(cells.daily_summary(made), analytics.daily_summary(dated))
    same(cells.curve_profile(made), analytics.curve_profile(dated))
    same(cells.peak_hour(made), mart.peak_hour(dated))
    empty = scratch_path(spark, "cells")
    for made in (cells.update_cells(make_obs([]), empty), cells.update_cells(rows, empty, [])):
        assert cells.daily_summary(made).count() == 0 and cells.system_metrics(made).count() == 0


def test_doubles_agree_within_rounding(spark, make_obs, points):
    clean = clean_ops.clean_series(make_obs(points))
    made = cells.update_cells(clean, scratch_path(spark, "cells"))
    a, b = cells.system_metrics(made).first(), mart.system_metrics(clean).first()
    assert a["peak_time_utc"] == b["peak_time_utc"] and a["avg_hourly_load_mw"] == pytest.approx(b["avg_hourly_load_mw"])
