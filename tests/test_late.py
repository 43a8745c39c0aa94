"""Rows behind the watermark: the streamed hours equal the batch over all rows, also after a broken run."""

from __future__ import annotations

import pytest
from conftest import rows, ts

from loadlens.operators import clean
from loadlens.streaming import late

BATCHES = [
    [("2024-01-31 00:10:00", "SE", "Z1", 1.0, "a"), ("2024-01-31 05:00:00", "SE", "Z1", 3.0)],
    [("2024-02-04 00:00:00", "SE", "Z1", 9.0), ("2024-02-04 00:30:00", "SE", "Z2", 4.0)],
    # days behind: one hour that has rows, one that has none, an invalid row, a zone of its own
    [("2024-01-31 00:40:00", "SE", "Z1", 5.0, "b"), ("2024-01-31 02:00:00", "SE", "Z1", 7.0), ("2024-01-31 05:30:00", "SE", "Z1", -1.0),
     ("2024-01-31 00:20:00", "NO", "Z9", 2.0), ("2024-02-04 01:00:00", "SE", "Z1", 6.0)],
    [("2024-01-31 00:50:00", "SE", "Z1", 6.0)],
]
COLS = ("time_utc", "country_code", "bidding_zone", "load_mw", "source")


@pytest.fixture
def feed(spark, make_obs, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "root")

    def run(batch):
        if batch is not None:
            make_obs(batch).write.mode("append").parquet(src)
        stream = spark.readStream.schema(make_obs(BATCHES[0]).schema).parquet(src)
        return late.downsample_run(stream, root, zone_parts=2, state_partitions=2)

    return run, root


def expected(make_obs, batches):
    return rows(clean.clean_series(make_obs([r for b in batches for r in b])), *COLS)


def test_late_rows_change_their_hours(spark, make_obs, feed):
    run, root = feed
    for n, batch in enumerate(BATCHES, 1):
        seen = run(batch)
        assert seen["repaired"] == (n > 2)
        assert rows(spark.read.parquet(f"{root}/clean"), *COLS) == expected(make_obs, BATCHES[:n])
    assert rows(spark.read.parquet(f"{root}/late"), "bidding_zone", "load_mw") == [
        ("Z1", 5.0), ("Z1", 6.0), ("Z1", 7.0), ("Z9", 2.0)]
    assert run(None) == {"late_rows": 0, "repaired": False}


def test_a_run_that_broke_before_its_repair_is_made_good(spark, make_obs, feed, monkeypatch):
    run, root = feed
    run(BATCHES[0])
    run(BATCHES[1])

    def fail(*_a, **_k):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(late, "repair", fail)
        with pytest.raises(RuntimeError, match="lost driver"):
            run(BATCHES[2])
    assert run(None)["repaired"]
    assert rows(spark.read.parquet(f"{root}/clean"), *COLS) == expected(make_obs, BATCHES[:3])


def test_touched_months_alone_are_read_again(spark, make_obs, tmp_path):
    path = str(tmp_path / "raw")
    obs = make_obs([r for b in BATCHES for r in b])
    late.landing_sink(path)(obs, 0)
    raw = spark.read.schema(late.stored_schema(obs.schema)).parquet(path)
    again = late.hours_again(raw, raw.where("load_mw = 7"))
    assert rows(again, *COLS[:4]) == [(ts("2024-01-31 02:00:00"), "SE", "Z1", 7.0)]
    scans = [line for line in again._jdf.queryExecution().toString().splitlines() if "PartitionFilters" in line]
    assert scans and "2024-01" in scans[0]
