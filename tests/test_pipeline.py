from __future__ import annotations

import datetime as dt

import pytest
from conftest import ts

from loadlens.operators import quality, tables
from loadlens.plans import pipeline
from loadlens.schema import PUBLISH_SCHEMAS, RAW_SCHEMA, RUN_EVENT_SCHEMA
from loadlens.sources import publish as pub


def _write_inputs(spark, tmp_path, hours, holes=()):
    base = dt.datetime(2024, 1, 1)
    raw = spark.createDataFrame([(base + dt.timedelta(hours=h), "SE", "Z1", float(h % 24), None, base)
                                 for h in range(hours) if h not in holes], RAW_SCHEMA)
    raw_path, ledger_path = str(tmp_path / "raw"), str(tmp_path / "ledger")
    raw.write.parquet(raw_path)
    ev = [("r1", "p", "s", "SE", "Z1", base, base, ts("2024-03-01 00:00:00"), ts("2024-03-01 00:05:00"),
           "success", hours, hours, None, None, "PT60M", 1, None, 1)]
    spark.createDataFrame(ev, RUN_EVENT_SCHEMA).write.parquet(ledger_path)
    return raw_path, ledger_path


def test_run_pipeline_publishes_all_objects(spark, tmp_path):
    raw_path, ledger_path = _write_inputs(spark, tmp_path, 24 * 10, holes=(5, 6))
    out = str(tmp_path / "published")
    layers = pipeline.run_pipeline(spark, raw_path, ledger_path, str(tmp_path / "clean"), publish_root=out)
    assert set(PUBLISH_SCHEMAS) <= set(layers)
    for name, schema in PUBLISH_SCHEMAS.items():
        back = pub.read_published(spark, f"{out}/{name}", name)
        assert back.schema.fieldNames() == schema.fieldNames(), name
    gaps = pub.read_published(spark, f"{out}/dq_time_gaps", "dq_time_gaps").collect()
    assert len(gaps) == 1 and gaps[0]["gap_interval"] == "03:00:00"
    assert pub.read_published(spark, f"{out}/dq_invalid_loads", "dq_invalid_loads").count() == 0  # empty object still written
    status = pub.read_published(spark, f"{out}/dq_pipeline_status", "dq_pipeline_status").first()
    assert status["pipeline_status"] == "HEALTHY" and status["missing_hours"] == 2


def test_gate_stops_the_run(spark, tmp_path):
    raw_path, ledger_path = _write_inputs(spark, tmp_path, 24 * 10, holes=tuple(range(10, 80)))
    with pytest.raises(quality.DataQualityError):
        pipeline.run_pipeline(spark, raw_path, ledger_path, str(tmp_path / "clean"))


def test_build_layers_registers_views(spark, make_obs):
    raw = make_obs([("2024-01-01 00:00:00", "SE", "Z1", 1.0), ("2024-01-01 01:00:00", "SE", "Z1", 2.0)])
    ledger = tables.ledger_latest(spark.createDataFrame([], RUN_EVENT_SCHEMA))
    pipeline.build_layers(raw, ledger, register=True, persist=False)
    row = spark.sql("SELECT pipeline_status, clean_rows FROM dq_pipeline_status").first()
    assert (row["pipeline_status"], row["clean_rows"]) == ("HEALTHY", 2)
    assert spark.sql("SELECT count(*) AS n FROM mart_energy_system_metrics_long").first()["n"] == 12


def test_materialise_and_zone_metrics_job(spark, make_obs, tmp_path):
    raw = make_obs([("2024-01-01 00:00:00", "SE", "Z1", 1.0), ("2024-01-01 00:00:00", "SE", "Z2", 3.0),
                    ("2024-01-01 01:00:00", "SE", "Z2", 5.0)])
    src = str(tmp_path / "clean")
    pub.materialise(spark, raw, "clean_tbl", kind="table", path=src)
    assert spark.sql("SELECT count(*) AS n FROM clean_tbl").first()["n"] == 3
    info = pub.zone_metrics_job(spark, src, str(tmp_path / "zm"))
    assert (info["input_rows"], info["output_rows"]) == (3, 2)
    zm = {r["bidding_zone"]: r["avg_load"] for r in spark.read.parquet(str(tmp_path / "zm")).collect()}
    assert zm == {"Z1": 1.0, "Z2": 4.0}


def test_reconciliation_by_zone(spark, make_obs):
    raw = make_obs([("2024-01-01 00:00:00", "SE", "Z1", 1.0), ("2024-01-01 03:00:00", "SE", "Z1", 1.0),
                    ("2024-01-01 00:00:00", "SE", "Z2", 1.0)])
    ledger = tables.ledger_latest(spark.createDataFrame([], RUN_EVENT_SCHEMA))
    from loadlens.operators import clean
    out = {r["bidding_zone"]: (r["expected_hours"], r["actual_hours"], r["missing_hours"])
           for r in quality.reconciliation(clean.clean_series(raw), raw, ledger, by_zone=True).collect()}
    assert out == {"Z1": (4, 2, 2), "Z2": (1, 1, 0)}


def test_ndjson_export_format(spark, make_obs, tmp_path):
    import json
    raw = make_obs([("2024-01-01 05:00:00", "SE", "Z1", 1.5, None, "2024-01-02 00:00:00.25")])
    path = str(tmp_path / "nd")
    pub.export_ndjson(pub.declared_select(raw, "energy_load_raw"), path)
    lines = [r["value"] for r in spark.read.text(path).collect()]
    rec = json.loads(lines[0])
    assert rec == {"time_utc": "2024-01-01T05:00:00", "country_code": "SE", "bidding_zone": "Z1",
                   "load_mw": 1.5, "source": None, "ingested_at": "2024-01-02T00:00:00.250000"}
    back = pub.read_ndjson(spark, path, "energy_load_raw").first()
    assert back["ingested_at"] == dt.datetime(2024, 1, 2, 0, 0, 0, 250000)


def test_dbt_models_views_and_tables(spark, make_obs, tmp_path):
    from loadlens.operators import clean
    raw = make_obs([("2024-01-01 00:00:00", "SE", "Z1", 2.0), ("2024-01-01 01:00:00", "SE", "Z1", 4.0)])
    c = clean.clean_series(raw)
    ledger = tables.ledger_latest(spark.createDataFrame([], RUN_EVENT_SCHEMA))
    asrt = quality.assertions(quality.reconciliation(c, raw, ledger))
    models = pipeline.build_dbt_models(spark, c, asrt, str(tmp_path / "dbt"))
    assert spark.sql("SELECT avg_load_mw FROM fct_energy_daily_summary").first()[0] == 3.0
    assert spark.sql("SELECT count(*) FROM fct_energy_hourly_profile").first()[0] == 2
    assert spark.sql("SELECT count(*) FROM stg_dq_assertions").first()[0] == 3
    assert spark.read.parquet(str(tmp_path / "dbt" / "fct_energy_daily_summary")).count() == 1
    nn = quality.not_null_checks(models["fct_energy_hourly_profile"], ["hour_of_day"], "fct_energy_hourly_profile")
    assert nn.first()["status"] == "PASS"


def test_scale_conf_sizes_partitions():
    from loadlens.session import scale_conf
    conf = scale_conf(100 * 2**40, 8000)  # 100 TB on 1,000 executors x 8 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 40961
    assert conf["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    small = scale_conf(10 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
