"""Persisted paths: no failure of a read may lose data; versions; exact sums; plans."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from loadlens.functions.expr import interval_text, mean
from loadlens.operators import clean, mart, quality, tables
from loadlens.schema import HOURLY, RAW_SCHEMA
from loadlens.session import (delete_path, ensure_checkpoint_dir, read_or_empty, read_version, scratch_path, staged, version_path,
                              write_version)

KEYS = HOURLY.key_time


def _parquet_files(path):
    return sorted(os.path.join(d, f) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def test_damaged_month_fails_the_upsert_and_nothing_is_lost(spark, make_obs, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert_table(spark, make_obs([("2024-01-01 00:00:00", "SE", "Z1", 1.0)]), path, KEYS)
    tables.upsert_table(spark, make_obs([(f"2024-02-01 {h:02d}:00:00", "SE", "Z1", float(h)) for h in range(10)]), path, KEYS)
    [january] = _parquet_files(f"{path}/month=2024-01")
    [february] = _parquet_files(f"{path}/month=2024-02")
    kept = open(february, "rb").read()
    with open(january, "wb") as fh:
        fh.write(b"broken")
    batch = make_obs([("2024-01-05 00:00:00", "SE", "Z1", 5.0), ("2024-02-05 00:00:00", "SE", "Z1", 5.0)])
    with pytest.raises(Exception):
        tables.upsert_table(spark, batch, path, KEYS)
    assert _parquet_files(f"{path}/month=2024-02") == [february] and open(february, "rb").read() == kept


def test_untouched_months_are_neither_read_nor_rewritten(spark, make_obs, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert_table(spark, make_obs([(f"2024-0{m}-01 00:00:00", "SE", "Z1", 1.0) for m in (1, 2, 3)]), path, KEYS)
    [february] = _parquet_files(f"{path}/month=2024-02")
    with open(february, "wb") as fh:
        fh.write(b"broken")
    tables.upsert_table(spark, make_obs([("2024-01-02 00:00:00", "SE", "Z1", 2.0), ("2024-03-02 00:00:00", "SE", "Z1", 2.0)]), path, KEYS)
    assert open(february, "rb").read() == b"broken"
    assert spark.read.parquet(f"{path}/month=2024-01").count() == 2 and spark.read.parquet(f"{path}/month=2024-03").count() == 2


def test_only_touched_zone_parts_are_rewritten(spark, make_obs, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert_table(spark, make_obs([("2024-01-01 00:00:00", "SE", f"Z{i}", 1.0) for i in range(40)]), path, KEYS, zone_parts=8)
    before = set(_parquet_files(path))
    out = tables.upsert_table(spark, make_obs([("2024-01-01 00:00:00", "SE", "Z7", 9.0), ("2024-01-02 00:00:00", "SE", "Z7", 2.0)]), path, KEYS, zone_parts=8)
    kept = before & set(_parquet_files(path))
    assert len({f.split("/zone_part=")[1].split("/")[0] for f in before - kept}) == 1 and kept
    assert out.count() == 41 and out.where("bidding_zone = 'Z7'").agg(F.sum("load_mw")).first()[0] == 11.0


def test_first_write_and_batch_keep_one_row_per_key(spark, make_obs, tmp_path):
    path = str(tmp_path / "t")
    same = [("2024-01-01 00:00:00", "SE", "Z1", v) for v in (1.0, 3.0, 2.0)]
    assert rows(tables.upsert_table(spark, make_obs(same), path, KEYS), "load_mw") == [(3.0,)]
    assert rows(tables.upsert_table(spark, make_obs([same[0], same[2]]), path, KEYS), "load_mw") == [(2.0,)]
    assert tables.upsert_table(spark, make_obs([]), path, KEYS).count() == 1
    assert tables.upsert_table(spark, make_obs([]), str(tmp_path / "none"), KEYS).count() == 0


def test_upsert_leaves_no_scratch(spark, make_obs, tmp_path):
    base = ensure_checkpoint_dir(spark).replace("file:", "")
    before = set(os.listdir(base))
    tables.upsert_table(spark, make_obs([("2024-01-01 00:00:00", "SE", "Z1", 1.0)]), str(tmp_path / "t"), KEYS)
    assert set(os.listdir(base)) == before


def test_versions_switch_when_complete(spark, make_obs, tmp_path):
    path = str(tmp_path / "v")
    assert read_version(spark, path, RAW_SCHEMA).count() == 0 and version_path(spark, path) is None
    for n in (1, 2, 3, 4):
        write_version(make_obs([("2024-01-01 00:00:00", "SE", "Z1", float(n))]), path)
    assert rows(read_version(spark, path, RAW_SCHEMA), "load_mw") == [(4.0,)]
    assert sorted(os.listdir(path)) == ["v=3", "v=4"]
    failing = make_obs([("2024-01-01 00:00:00", "SE", "Z1", 9.0)]).withColumn("load_mw", F.raise_error(F.lit("no")).cast("double"))
    with pytest.raises(Exception):
        write_version(failing, path)
    assert rows(read_version(spark, path, RAW_SCHEMA), "load_mw") == [(4.0,)]


def test_only_absence_counts_as_empty(spark, make_obs, tmp_path):
    path = str(tmp_path / "r")
    assert read_or_empty(spark, path, RAW_SCHEMA).count() == 0
    os.makedirs(path)
    with open(f"{path}/part-0.parquet", "wb") as fh:
        fh.write(b"broken")
    with pytest.raises(Exception):
        read_or_empty(spark, path, RAW_SCHEMA).count()


def test_staged_files_go(spark):
    with staged(spark.range(3), "x") as df:
        assert df.count() == 3
        folder = df.inputFiles()[0].replace("file://", "").rsplit("/", 1)[0]
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
    path = scratch_path(spark, "y")
    spark.range(1).write.parquet(path)
    delete_path(spark, path)
    assert read_or_empty(spark, path, spark.range(1).schema).count() == 0


def test_released_scratch_is_gone(spark):
    from loadlens import session
    path = scratch_path(spark, "z")
    spark.range(1).write.parquet(path)
    others = session._SCRATCH[:-1]
    session._SCRATCH[:] = [path]
    session.release_scratch(spark)
    session._SCRATCH[:] = others
    assert not session.path_exists(spark, path)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_large_loads_fail_instead_of_vanishing(spark, ansi):
    df = spark.createDataFrame([(1e13,), (2.0,)], "v double")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="does not fit"):
            df.agg(mean("v", 6)).collect()
        assert df.agg(mean("v")).first()[0] == pytest.approx(5.000000000001e12)
        assert spark.createDataFrame([(9e11,), (None,)], "v double").agg(mean("v", 6)).first()[0] == 9e11
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_interval_text_shows_parts_of_a_second(spark):
    got = spark.range(1).select(interval_text(F.lit(1), F.lit(500_000)), interval_text(F.lit(0), F.lit(1)), interval_text(F.lit(86400), F.lit(0))).first()
    assert tuple(got) == ("00:00:01.5", "00:00:00.000001", "1 day 00:00:00")


def test_label_of_null_zones_and_one_scan(spark, make_obs, tmp_path):
    raw = make_obs([("2024-01-01 00:10:00", "SE", None, 1.0, "s"), ("2024-01-01 00:20:00", "SE", None, 3.0),
                    ("2024-01-01 00:00:00", "SE", "Z1", 5.0), ("2024-01-01 00:30:00", "SE", "Z1", 7.0, "b"), ("2024-01-01 00:40:00", "SE", "Z1", 9.0, "a")])
    c = clean.clean_series(raw, exact_scale=6)
    assert {(r["bidding_zone"], r["load_mw"], r["source"]) for r in c.collect()} == {(None, 2.0, "s"), ("Z1", 7.0, "b")}
    path = str(tmp_path / "raw")
    raw.write.parquet(path)
    df = clean.clean_series(spark.read.parquet(path), exact_scale=6)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 2 and "SortAggregate" not in plan.split("== Initial Plan ==")[0].split("Exchange hashpartitioning")[-1]
    assert len({line for line in plan.split("== Initial Plan ==")[0].splitlines() if "FileScan" in line}) == 1


def test_peak_is_the_maximum_also_for_nan(spark, make_obs):
    raw = make_obs([("2024-01-01 00:00:00", "SE", "Z1", float("nan")), ("2024-01-01 01:00:00", "SE", "Z1", 5.0)])
    wide = mart.system_metrics(raw).first()
    assert wide["max_hourly_load_mw"] != wide["max_hourly_load_mw"] and wide["peak_load_mw"] != wide["peak_load_mw"]
    assert wide["peak_time_utc"] == ts("2024-01-01 00:00:00")
    zone = mart.system_metrics(raw, by=["country_code", "bidding_zone"]).first()
    assert zone["peak_time_utc"] == ts("2024-01-01 00:00:00")


def test_step_counts_equal_the_spine(spark, make_obs):
    obs = [(dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m), "SE", z, 1.0)
           for z, off in (("Z1", 0), ("Z2", 30), (None, 0)) for m in (0, off, 60, 61, 240, 245, 300 + off, 300 + off)]
    df = make_obs(obs)
    expected = quality.missing_times(df.where("bidding_zone IS NOT NULL")).count()
    got = quality.step_counts(df.where("bidding_zone IS NOT NULL")).first()
    assert got["missing_hours"] == expected
    assert got["actual_hours"] == df.where("bidding_zone IS NOT NULL").select("time_utc").distinct().count()
    assert quality.step_counts(df.limit(0)).first()["missing_hours"] == 0
    by = {r["bidding_zone"]: r["missing_hours"] for r in quality.step_counts(df, by_zone=True).collect()}
    assert by["Z1"] == quality.missing_times(df.where("bidding_zone = 'Z1'")).count()


def test_gap_input_is_shuffled_once(spark, make_obs, tmp_path):
    path = str(tmp_path / "raw")
    make_obs([(f"2024-01-0{d} 0{h}:00:00", "SE", "Z1", 1.0) for d in (1, 2, 3) for h in range(5)]).write.parquet(path)
    df = quality.time_gaps(clean.clean_series(spark.read.parquet(path)))
    assert df.count() == 2
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
