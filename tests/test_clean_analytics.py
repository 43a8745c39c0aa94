from __future__ import annotations

import math

from conftest import rows, ts

from loadlens.operators import analytics, clean


def test_clean_hourly_averages_filters_and_defaults(make_obs):
    raw = make_obs([
        ("2024-01-01 00:00:00", "SE", "Z1", 10.0, None, "2024-01-02 00:00:00"),
        ("2024-01-01 00:15:00", "SE", "Z1", 20.0, None, "2024-01-02 01:00:00"),
        ("2024-01-01 00:30:00", "SE", "Z1", None),
        ("2024-01-01 00:45:00", "SE", "Z1", -5.0),
        ("2024-01-01 01:00:00", "SE", "Z1", 7.0, "X", None),
    ])
    out = rows(clean.clean_series(raw), "time_utc", "load_mw", "source", "ingested_at")
    assert out == [
        (ts("2024-01-01 00:00:00"), 15.0, "ENTSO-E", ts("2024-01-02 01:00:00")),
        (ts("2024-01-01 01:00:00"), 7.0, "X", None),
    ]


def test_clean_pass_through_keeps_rows(make_obs):
    raw = make_obs([("2024-01-01 00:10:00", "SE", "Z1", 1.0), ("2024-01-01 00:20:00", "SE", "Z1", -1.0)])
    out = clean.clean_series(raw, grain=None)
    assert out.count() == 1 and out.first()["source"] == "ENTSO-E"


def test_nan_passes_validity_unless_rejected(make_obs):
    raw = make_obs([("2024-01-01 00:00:00", "SE", "Z1", float("nan"))])
    assert clean.valid_rows(raw).count() == 1
    assert clean.valid_rows(raw, reject_nan=True).count() == 0


def test_invalid_rows_is_complement(make_obs):
    raw = make_obs([("2024-01-01 00:00:00", "SE", "Z1", -1.0), ("2024-01-01 01:00:00", "SE", "Z1", 2.0)])
    assert rows(clean.invalid_rows(raw), "load_mw") == [(-1.0,)]


def test_daily_summary_and_profile(make_obs):
    raw = make_obs([("2024-01-01 00:00:00", "SE", "Z1", 1.0), ("2024-01-01 01:00:00", "SE", "Z1", 3.0),
                    ("2024-01-02 00:00:00", "SE", "Z1", 5.0)])
    c = clean.clean_series(raw)
    d = rows(analytics.daily_summary(c), "load_date", "avg_load_mw", "peak_load_mw", "min_load_mw",
             "hourly_points")
    assert d[0][1:] == (2.0, 3.0, 1.0, 2) and d[1][1:] == (5.0, 5.0, 5.0, 1)
    p = rows(analytics.curve_profile(c), "hour_of_day", "avg_hourly_load_mw", "observation_count")
    assert p == [(0, 3.0, 2), (1, 3.0, 1)]


def test_zero_baseline_day_has_no_anomaly(make_obs):
    raw = make_obs([("2024-01-01 00:00:00", "SE", "Z1", 0.0), ("2024-01-01 01:00:00", "SE", "Z1", 0.0)])
    assert analytics.anomalies(clean.clean_series(raw)).count() == 0


def test_anomaly_band_is_strict_and_pct_rounded(make_obs):
    # day average 10: 11.0 is exactly +10% (not an anomaly), 13.5 high, 5.5 low
    vals = [11.0, 13.5, 5.5, 10.0]
    raw = make_obs([(f"2024-01-01 0{i}:00:00", "SE", "Z1", v) for i, v in enumerate(vals)])
    out = rows(analytics.anomalies(clean.clean_series(raw)), "load_mw", "pct_deviation", "anomaly_type")
    assert sorted(out) == [(5.5, -45.0, "LOW_ANOMALY"), (13.5, 35.0, "HIGH_ANOMALY")]


def test_window_form_equals_join_form(spark):
    from loadlens.plans.catalog import clean_obs
    from conftest import SF_SMALL
    c = clean_obs(spark, SF_SMALL)
    a = analytics.anomalies(c, exact_scale=6)
    b = analytics.anomalies_vs_baseline(c, analytics.daily_baseline(c, exact_scale=6))
    assert a.exceptAll(b.select(*a.columns)).count() == 0
    assert b.select(*a.columns).exceptAll(a).count() == 0


def test_plain_average_close_to_exact(spark):
    from loadlens.plans.catalog import clean_obs
    from conftest import SF_SMALL
    c = clean_obs(spark, SF_SMALL)
    plain = {tuple(r[:3]): r[3] for r in analytics.daily_summary(c).collect()}
    exact = {tuple(r[:3]): r[3] for r in analytics.daily_summary(c, exact_scale=6).collect()}
    assert plain.keys() == exact.keys()
    assert all(math.isclose(plain[k], exact[k], rel_tol=1e-9, abs_tol=1e-6) for k in plain)
