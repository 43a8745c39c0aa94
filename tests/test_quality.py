from __future__ import annotations

import datetime as dt

from conftest import rows, ts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from loadlens.operators import clean, quality
from loadlens.schema import RUN_EVENT_SCHEMA, SeriesSpec


def _ledger(spark, runs):
    from loadlens.operators.tables import ledger_latest
    events = []
    for rid, started, status in runs:
        events.append((rid, "p", "s", "SE", "Z1", ts(started), ts(started), ts(started), None, status,
                       0, 0, None, None, None, None, None, 1))
    return ledger_latest(spark.createDataFrame(events, RUN_EVENT_SCHEMA))


def test_gaps_missing_and_spine(make_obs):
    raw = make_obs([("2024-01-01 00:00:00", "SE", "Z1", 1.0), ("2024-01-01 03:00:00", "SE", "Z1", 1.0),
                    ("2024-01-01 04:00:00", "SE", "Z1", 1.0), ("2024-01-02 01:00:00", "SE", "Z1", 1.0)])
    c = clean.clean_series(raw)
    gaps = rows(quality.time_gaps(c), "previous_time", "time_utc", "gap_seconds")
    assert gaps == [(ts("2024-01-01 00:00:00"), ts("2024-01-01 03:00:00"), 10800),
                    (ts("2024-01-01 04:00:00"), ts("2024-01-02 01:00:00"), 75600)]
    missing = quality.missing_times(c)
    assert missing.count() == 2 + 20
    assert quality.expected_spine(c).count() == 26


def test_off_grid_minimum_shifts_spine(make_obs):
    raw = make_obs([("2024-01-01 00:30:00", "SE", "Z1", 1.0), ("2024-01-01 01:00:00", "SE", "Z1", 1.0),
                    ("2024-01-01 02:30:00", "SE", "Z1", 1.0)])
    c = clean.clean_series(raw, grain=None)
    spine = rows(quality.expected_spine(c), "expected_time")
    assert spine == [(ts("2024-01-01 00:30:00"),), (ts("2024-01-01 01:30:00"),), (ts("2024-01-01 02:30:00"),)]
    assert rows(quality.missing_times(c), "missing_time") == [(ts("2024-01-01 01:30:00"),)]


def test_single_row_zone(make_obs):
    c = clean.clean_series(make_obs([("2024-01-01 05:00:00", "SE", "Z9", 3.0)]))
    assert quality.time_gaps(c).count() == 0
    assert quality.expected_spine(c).count() == 1 and quality.missing_times(c).count() == 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=0, max_value=24 * 40), min_size=1, max_size=40, unique=True),
       st.integers(min_value=1, max_value=8))
def test_present_plus_missing_equals_spine(spark, make_obs, hours, chunk):
    base = dt.datetime(2024, 1, 1)
    raw = make_obs([(base + dt.timedelta(hours=h), "SE", "Z1", 1.0) for h in hours])
    c = clean.clean_series(raw)
    spine = quality.expected_spine(c, chunk_steps=chunk).count()
    assert c.count() + quality.missing_times(c, chunk_steps=chunk).count() == spine
    assert spine == max(hours) - min(hours) + 1


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=0, max_value=60 * 24 * 90), min_size=2, max_size=60, unique=True))
def test_bucketed_lag_equals_plain_lag(spark, make_obs, minutes):
    base = dt.datetime(2024, 1, 1)
    raw = make_obs([(base + dt.timedelta(minutes=m), "SE", "Z1" if m % 2 else "Z2", 1.0) for m in minutes])
    spec = SeriesSpec()
    mine = quality.previous_time(raw.select("country_code", "bidding_zone", "time_utc"), spec)
    plain = raw.select("country_code", "bidding_zone", "time_utc").withColumn(
        "previous_time", F.lag("time_utc").over(Window.partitionBy("country_code", "bidding_zone")
                                                .orderBy("time_utc")))
    assert mine.exceptAll(plain.select(*mine.columns)).count() == 0
    assert plain.select(*mine.columns).exceptAll(mine).count() == 0


def test_duplicates_count_key_groups(make_obs):
    raw = make_obs([("2024-01-01 00:00:00", "SE", "Z1", 1.0)] * 3 + [("2024-01-01 01:00:00", "SE", "Z1", 1.0)])
    assert rows(quality.duplicate_key_groups(raw), "row_count") == [(3,)]


def test_empty_clean_status_recon_mart(spark, make_obs):
    from loadlens.operators import mart
    raw = make_obs([("2024-01-01 00:00:00", "SE", "Z1", -1.0)])
    c = clean.clean_series(raw)
    ledger = _ledger(spark, [])
    status = quality.pipeline_status(raw, c).collect()
    assert len(status) == 1 and status[0]["pipeline_status"] == "FAILED" and status[0]["raw_rows"] == 1
    recon = quality.reconciliation(c, raw, ledger).collect()
    assert len(recon) == 1 and recon[0]["expected_hours"] is None and recon[0]["last_run_id"] is None
    a = {r["assertion_name"]: r["status"]
         for r in quality.assertions(quality.reconciliation(c, raw, ledger), quality.STRICT).collect()}
    assert a == {"missing_hours_check": "FAIL", "duplicate_rows_check": "PASS", "data_coverage_check": "FAIL"}
    assert mart.system_metrics(c).count() == 0


def test_status_ladder_order(make_obs):
    hours = [0, 30]  # 29 missing hours and one gap -> WARNING
    raw = make_obs([(dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), "SE", "Z1", 1.0) for h in hours])
    st_ = quality.pipeline_status(raw, clean.clean_series(raw)).first()
    assert (st_["missing_hours"], st_["time_gaps"], st_["pipeline_status"]) == (29, 1, "WARNING")
    bad = make_obs([("2024-01-01 00:00:00", "SE", "Z1", -3.0)])
    assert quality.pipeline_status(bad, bad).first()["pipeline_status"] == "FAILED"


def test_latest_success_and_gate(spark, make_obs):
    ledger = _ledger(spark, [("a", "2024-01-01 00:00:00", "success"), ("b", "2024-01-02 00:00:00", "failed"),
                             ("c", "2024-01-01 12:00:00", "success")])
    assert rows(quality.latest_success(ledger), "last_run_id") == [("c",)]
    raw = make_obs([("2024-01-01 00:00:00", "SE", "Z1", 1.0)] * 2)
    c = clean.clean_series(raw)
    asrt = quality.assertions(quality.reconciliation(c, raw, ledger), quality.TOLERANT)
    try:
        quality.dq_gate(asrt)
        raised = False
    except quality.DataQualityError:
        raised = True
    assert raised  # duplicate key group in raw


def test_golden_two_year_series_passes_strict(spark, make_obs):
    """17,544 hours over 2024-2025, 20 holes: expected 17,544, actual 17,524, missing 20."""
    base = dt.datetime(2024, 1, 1)
    holes = set(range(100, 2100, 100))
    raw = make_obs([(base + dt.timedelta(hours=h), "SE", "Z1", 1.0) for h in range(17544) if h not in holes])
    c = clean.clean_series(raw)
    ledger = _ledger(spark, [("r1", "2026-01-01 00:00:00", "success")])
    recon = quality.reconciliation(c, raw, ledger).first()
    assert (recon["expected_hours"], recon["actual_hours"], recon["missing_hours"]) == (17544, 17524, 20)
    a = quality.assertions(quality.reconciliation(c, raw, ledger), quality.STRICT)
    assert quality.dq_gate(a) == 0


def test_not_null_checks(make_obs):
    raw = make_obs([("2024-01-01 00:00:00", "SE", "Z1", 1.0, None)])
    out = {r["column_name"]: (r["null_rows"], r["status"])
           for r in quality.not_null_checks(raw, ["load_mw", "source"], "m").collect()}
    assert out == {"load_mw": (0, "PASS"), "source": (1, "FAIL")}
