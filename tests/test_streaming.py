"""Streaming operators over two micro-batches (state must carry across them)."""

from __future__ import annotations

from conftest import rows, ts

from loadlens.streaming import stream as st

BATCH1 = [("2024-01-01 00:00:00", "SE", "Z1", 1.0), ("2024-01-01 00:00:00", "SE", "Z1", 2.0),
          ("2024-01-01 05:00:00", "SE", "Z1", 3.0)]
BATCH2 = [("2024-01-01 05:00:00", "SE", "Z1", 9.0), ("2024-01-01 06:00:00", "SE", "Z1", 4.0),
          ("2024-01-01 09:30:00", "SE", "Z1", 5.0)]


def _replay(spark, make_obs, tmp_path, start):
    src, ckpt = str(tmp_path / "src"), str(tmp_path / "ckpt")
    schema = make_obs(BATCH1).schema
    for batch in (BATCH1, BATCH2):
        make_obs(batch).write.mode("append").parquet(src)
        start(spark.readStream.schema(schema).parquet(src), ckpt)


def test_builtin_dedupe_within_watermark(spark, make_obs, tmp_path):
    sink = str(tmp_path / "out")
    _replay(spark, make_obs, tmp_path,
            lambda s, ck: st.run_available_now(st.dedupe_keys(s), ck, sink=sink, state_partitions=2))
    assert rows(spark.read.parquet(sink), "time_utc") == [
        (ts("2024-01-01 00:00:00"),), (ts("2024-01-01 05:00:00"),), (ts("2024-01-01 06:00:00"),),
        (ts("2024-01-01 09:30:00"),)]


def test_dedupe_sink_across_batches(spark, make_obs, tmp_path):
    sink, state = str(tmp_path / "out"), str(tmp_path / "state")
    _replay(spark, make_obs, tmp_path,
            lambda s, ck: st.run_available_now(s, ck, foreach_batch=st.dedupe_sink(spark, state, sink)))
    out = rows(spark.read.parquet(sink), "time_utc", "load_mw", "batch_id")
    assert [r[0] for r in out] == [ts("2024-01-01 00:00:00"), ts("2024-01-01 05:00:00"),
                                   ts("2024-01-01 06:00:00"), ts("2024-01-01 09:30:00")]
    assert out[1][1:] == (3.0, 0)  # the 05:00 copy in the second batch was dropped


def test_gap_sink_and_downsample(spark, make_obs, tmp_path):
    gaps, state = str(tmp_path / "gaps"), str(tmp_path / "gstate")
    _replay(spark, make_obs, tmp_path / "g",
            lambda s, ck: st.run_available_now(s, ck, foreach_batch=st.gap_detector_sink(spark, state, gaps)))
    assert rows(spark.read.parquet(gaps), "previous_time", "gap_seconds") == [
        (ts("2024-01-01 00:00:00"), 18000), (ts("2024-01-01 06:00:00"), 12600)]
    table = str(tmp_path / "clean")
    _replay(spark, make_obs, tmp_path / "d",
            lambda s, ck: st.run_available_now(st.hourly_downsample(s), ck, mode="update", state_partitions=2,
                                               foreach_batch=st.upsert_sink(spark, table, ["time_utc",
                                                                                           "country_code",
                                                                                           "bidding_zone"])))
    assert rows(spark.read.parquet(table), "time_utc", "load_mw") == [
        (ts("2024-01-01 00:00:00"), 1.5), (ts("2024-01-01 05:00:00"), 6.0), (ts("2024-01-01 06:00:00"), 4.0),
        (ts("2024-01-01 09:00:00"), 5.0)]


def test_gap_sink_diverts_late_rows(spark, make_obs, tmp_path):
    src, ckpt = str(tmp_path / "src"), str(tmp_path / "ckpt")
    gaps, state, late = str(tmp_path / "gaps"), str(tmp_path / "state"), str(tmp_path / "late")
    b1 = [("2024-01-01 00:00:00", "SE", "Z1", 1.0), ("2024-01-01 10:00:00", "SE", "Z1", 1.0)]
    b2 = [("2024-01-01 04:00:00", "SE", "Z1", 1.0), ("2024-01-01 11:00:00", "SE", "Z1", 1.0),
          ("2024-01-01 13:00:00", "SE", "Z1", 1.0)]
    schema = make_obs(b1).schema
    for b in (b1, b2):
        make_obs(b).write.mode("append").parquet(src)
        st.run_available_now(spark.readStream.schema(schema).parquet(src), ckpt,
                             foreach_batch=st.gap_detector_sink(spark, state, gaps, late_path=late))
    assert rows(spark.read.parquet(gaps), "previous_time", "time_utc") == [
        (ts("2024-01-01 00:00:00"), ts("2024-01-01 10:00:00")),
        (ts("2024-01-01 11:00:00"), ts("2024-01-01 13:00:00"))]
    assert rows(spark.read.parquet(late), "time_utc") == [(ts("2024-01-01 04:00:00"),)]
    # the late point cuts the gap that was emitted before it came
    assert rows(st.settled_gaps(spark, gaps, late_path=late), "previous_time", "time_utc", "gap_seconds") == [
        (ts("2024-01-01 00:00:00"), ts("2024-01-01 04:00:00"), 14400), (ts("2024-01-01 04:00:00"), ts("2024-01-01 10:00:00"), 21600),
        (ts("2024-01-01 11:00:00"), ts("2024-01-01 13:00:00"), 7200)]


def test_late_rows_are_kept_and_counted_by_default(spark, make_obs, tmp_path):
    src, ckpt, gaps, state = (str(tmp_path / n) for n in ("src", "ckpt", "gaps", "state"))
    first = [(f"2024-01-0{d} 00:00:00", "SE", "Z1", 1.0) for d in (1, 5)]
    late = [(f"2024-01-0{d} 00:00:00", "SE", "Z1", 1.0) for d in (2, 3)] + [("2024-01-02 01:00:00", "SE", "Z1", 1.0)]
    schema = make_obs(first).schema
    for b in (first, late):
        make_obs(b).write.mode("append").parquet(src)
        seen = st.run_available_now(spark.readStream.schema(schema).parquet(src), ckpt,
                                    foreach_batch=st.gap_detector_sink(spark, state, gaps))
        assert seen == {"rows": len(b), "late_rows": 0}
    assert st.late_rows(spark, gaps).count() == 3
    from loadlens.operators import quality
    assert rows(st.settled_gaps(spark, gaps), "previous_time", "time_utc") == rows(
        quality.time_gaps(make_obs(first + late)), "previous_time", "time_utc")
