"""Presence bitmaps against the spine and the one-pass counts."""

from __future__ import annotations

import datetime as dt
import random

from conftest import rows, ts
from pyspark.sql import functions as F

from loadlens.operators import presence, quality
from loadlens.schema import DAILY
from loadlens.session import scratch_path


def series(make_obs, extra=()):
    rnd = random.Random(5)
    out = []
    for zone, start, n, keep in [("Z0", "2024-01-01T00:00:00", 300, 0.7), ("Z1", "1969-12-25T03:00:00", 400, 0.9),
                                 ("Z2", "2024-01-01T00:30:00", 50, 0.5), ("Z3", "2020-01-01T00:00:00", 1, 1)]:
        times = [ts(start) + dt.timedelta(hours=i) for i in range(n)]
        out += [(t, "SE", zone, 1.0) for i, t in enumerate(times) if i in (0, n - 1) or rnd.random() < keep]
    out += [(ts("2001-01-01T00:00:00"), "SE", "Z4", 1.0), (ts("2009-06-01T05:00:00"), "SE", "Z4", 1.0)]  # whole bitmaps are absent
    out += [(ts("2024-01-01T00:00:00"), None, "Z5", 1.0), (ts("2024-01-01T04:00:00"), None, "Z5", 1.0)]
    out += [(ts("2024-01-02T00:17:00"), "SE", "Z0", 1.0), (None, "SE", "Z0", 1.0)]  # off the zone's grid; without time
    return make_obs([*out, *extra])


def same(found, expected):
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_missing_steps_and_counts_equal_the_spine(make_obs):
    df = series(make_obs).repartition(5)
    table = presence.presence(df)
    spine = quality.missing_times(df.where("time_utc IS NOT NULL AND country_code IS NOT NULL"))
    assert spine.count() > 70_000
    same(presence.missing_from_presence(table).where("country_code IS NOT NULL").select("country_code", "bidding_zone", "missing_time"),
         spine.select("country_code", "bidding_zone", "missing_time"))
    assert presence.missing_from_presence(table).where("country_code IS NULL").count() == 3
    same(presence.presence_counts(table), quality.step_counts(df))
    cols = ["country_code", "bidding_zone", "expected_hours", "actual_hours", "missing_hours"]
    same(presence.presence_counts(table, by_zone=True).select(cols), quality.step_counts(df, by_zone=True).select(cols))


def test_daily_grain(make_obs):
    df = make_obs([(ts("2024-01-01T00:00:00") + dt.timedelta(days=d), "SE", "Z1", 1.0) for d in (0, 1, 5, 9)])
    table = presence.presence(df, DAILY)
    assert rows(presence.missing_from_presence(table, DAILY), "missing_time") == [
        (ts("2024-01-01T00:00:00") + dt.timedelta(days=d),) for d in (2, 3, 4, 6, 7, 8)]


def test_updates_in_any_cut_give_the_same_table(spark, make_obs):
    df = series(make_obs)
    path, whole = scratch_path(spark, "presence"), presence.presence(df)
    cut = F.pmod(F.xxhash64("time_utc", "bidding_zone"), F.lit(3))
    for part in (0, 2, 1, 1, 0):  # out of order, and again
        table = presence.update_presence(path, df.where(cut == part))
    order = ["country_code", "bidding_zone", "phase", "bucket"]
    same(table.orderBy(order), whole.select(table.columns).orderBy(order))


def test_update_reads_the_stored_bitmaps_and_the_new_rows_only(spark, make_obs):
    path = scratch_path(spark, "presence")
    df = series(make_obs)
    presence.update_presence(path, df)
    stored = presence.read_presence(spark, path)
    assert stored.count() < 20 and df.count() > 500
    plan = presence.missing_from_presence(stored)._jdf.queryExecution().optimizedPlan().toString()
    assert "Distinct" not in plan and "min_time" not in plan


def test_empty_tables(make_obs):
    table = presence.presence(make_obs([]))
    assert table.count() == 0 and presence.missing_from_presence(table).count() == 0
    same(presence.presence_counts(table), quality.step_counts(make_obs([])))
    assert presence.merged(table, table).count() == 0


def test_one_zone_with_most_rows_leaves_the_first_aggregate_as_few_rows(spark):
    df = spark.range(200_000).select(
        F.timestamp_add("HOUR", F.col("id") % 50_000, F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")).alias("time_utc"),
        F.lit("SE").alias("country_code"), F.when(F.col("id") % 3 == 0, "Z1").otherwise("Z0").alias("bidding_zone"),
        F.lit(1.0).alias("load_mw"))
    assert presence.presence(df).count() == 2 * 2  # hours 262,968 to 312,967 lie in two bitmaps
