"""Catalog tables: defaults, refused nulls, read by name, bucketed appends without a shuffle of the stored side."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from loadlens.schema import RUN_EVENT_SCHEMA
from loadlens.sources import warehouse as wh

RAW = wh.TABLES["energy_load_raw"]


@pytest.fixture
def names(spark, tmp_path, request):
    database = f"wh_{abs(hash(request.node.name)) % 10**8}"
    yield wh.create_tables(spark, database, str(tmp_path / "wh"))
    spark.sql(f"DROP DATABASE {database} CASCADE")


def test_tables_are_in_the_catalog_with_their_types(spark, names):
    for name, full in names.items():
        found = spark.table(full)
        assert found.count() == 0
        assert [(f.name, f.dataType) for f in found.schema.fields] == [(f.name, f.dataType) for f in wh.TABLES[name].schema.fields]
    wh.create_table(spark, names["energy_load_raw"], RAW)  # there already


def test_insert_without_ingest_time_gets_the_default(spark, names, make_obs):
    name = names["energy_load_raw"]
    obs = make_obs([("2024-01-01 00:00:00", "SE", "Z1", 1.0, "a", "2024-02-01 00:00:00")])
    before = dt.datetime.now(dt.UTC).replace(tzinfo=None)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")  # the default is UTC in any zone
        wh.insert_rows(spark, name, obs.drop("ingested_at", "source"), RAW)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    wh.insert_rows(spark, name, obs, RAW)
    given, default = sorted(r[0] for r in rows(spark.table(name), "ingested_at"))
    assert given == ts("2024-02-01 00:00:00")
    assert before - dt.timedelta(seconds=1) <= default <= before + dt.timedelta(minutes=5)
    events = wh.TABLES["pipeline_run_events"]
    one = spark.createDataFrame([("r", "p", "s", "SE", "Z1", *[ts("2024-01-01 00:00:00")] * 3, "running", 0)],
                                "run_id string, pipeline_name string, source_name string, country_code string, bidding_zone string, "
                                "requested_start_utc timestamp_ntz, requested_end_utc timestamp_ntz, started_at_utc timestamp_ntz, "
                                "status string, event_seq int")
    wh.insert_rows(spark, names["pipeline_run_events"], one, events)
    assert rows(spark.table(names["pipeline_run_events"]), "rows_seen", "rows_inserted", "finished_at_utc") == [(0, 0, None)]
    assert spark.table(names["pipeline_run_events"]).columns == RUN_EVENT_SCHEMA.fieldNames()


def test_nulls_in_required_columns_are_refused(spark, names, make_obs):
    name = names["energy_load_raw"]
    for row in (("2024-01-01 00:00:00", None, "Z1", 1.0), ("2024-01-01 00:00:00", "SE", "Z1", None)):
        with pytest.raises(Exception, match="null in required column"):
            wh.insert_rows(spark, name, make_obs([row, ("2024-01-02 00:00:00", "SE", "Z1", 1.0)]), RAW)
    with pytest.raises(ValueError, match="required but missing: \\['load_mw'\\]"):
        wh.insert_rows(spark, name, make_obs([("2024-01-01 00:00:00", "SE", "Z1", 1.0)]).drop("load_mw"), RAW)
    with pytest.raises(ValueError, match="unknown: \\['extra'\\]"):
        wh.insert_rows(spark, name, make_obs([("2024-01-01 00:00:00", "SE", "Z1", 1.0)]).withColumn("extra", F.lit(1)), RAW)
    assert spark.table(name).count() == 0


def test_bucketed_append_ignores_conflicts_and_does_not_move_the_stored_side(spark, tmp_path, make_obs):
    names = wh.create_tables(spark, "wh_buckets", str(tmp_path / "b"), buckets=4)
    name = names["energy_load_raw"]
    assert wh.bucket_count(spark, name) == 4
    hours = [(f"2024-01-01 {h:02d}:00:00", "SE", "Z1", float(h)) for h in range(20)]
    wh.append_new(spark, name, make_obs(hours), RAW)
    again = make_obs([(t, c, z, v + 100) for t, c, z, v in hours] + [("2024-01-02 00:00:00", "SE", "Z1", 1.0), ("2024-01-02 00:00:00", "SE", "Z1", 2.0)])
    ordered = again.withColumn("seq", F.col("load_mw"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = wh.new_rows(spark, name, ordered, RAW, "seq")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # the stored side is the last branch of the plan: nothing but its scan, filter and sort below the join
    stored = plan[plan.rindex("Sort ["):]
    assert "Bucketed: true" in stored and "Exchange" not in stored
    assert len(re.findall(r"Exchange hashpartitioning", plan)) >= 1  # the batch's own
    wh.append_new(spark, name, ordered, RAW, "seq")
    assert rows(spark.table(name), "time_utc", "load_mw") == sorted(
        [(ts(t), v) for t, _, _, v in hours] + [(ts("2024-01-02 00:00:00"), 1.0)], key=lambda r: str(r[0]))
    spark.sql("DROP DATABASE wh_buckets CASCADE")


def test_a_fact_is_read_by_its_name_and_replaced_whole(spark, names, make_obs, tmp_path):
    name = names["energy_load_raw"].replace("energy_load_raw", "fact")
    for load in (1.0, 2.0):
        assert rows(wh.save_table(make_obs([("2024-01-01 00:00:00", "SE", "Z1", load)]), name, str(tmp_path / "fact")), "load_mw") == [(load,)]
    assert spark.catalog.tableExists(name)
    assert spark.sql(f"SELECT load_mw FROM {name}").first()[0] == 2.0
