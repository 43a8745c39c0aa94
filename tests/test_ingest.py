from __future__ import annotations

import os

import pytest
from conftest import rows, ts
from pyspark.sql import functions as F

from loadlens.plans import ingest
from loadlens.plans.pipeline import IngestPaths, ingest as ingest_job
from loadlens.schema import STATE_SCHEMA
from loadlens.session import read_version
from loadlens.sources import market_xml as mx

NS_DOC = """<?xml version="1.0" encoding="UTF-8"?>
<Publication_MarketDocument xmlns="urn:test:load:doc:1">
  <mRID>doc-1</mRID>
  {body}
</Publication_MarketDocument>"""

PREFIXED = """<?xml version="1.0"?>
<q:LoadDoc xmlns:q="urn:test:other:2">
  <q:TimeSeries><q:mRID>p1</q:mRID><q:Period>
    <q:timeInterval><q:start>2024-03-01T00:00Z</q:start><q:end>2024-03-01T02:00Z</q:end></q:timeInterval>
    <q:resolution>PT60M</q:resolution>
    <q:Point><q:position>2</q:position><q:quantity>40.25</q:quantity></q:Point>
  </q:Period></q:TimeSeries>
</q:LoadDoc>"""

GOOD_BODY = """
  <TimeSeries><mRID>a</mRID>
    <Period><timeInterval><start>2024-03-01T00:00Z</start><end>2024-03-01T03:00Z</end></timeInterval>
      <resolution>PT60M</resolution>
      <Point><position>1</position><quantity>10</quantity></Point>
      <Point><position>3</position><quantity>30.5</quantity></Point>
      <Point><position>4</position></Point>
      <Point><position>5</position><quantity></quantity></Point>
    </Period>
    <Period><timeInterval><start>2024-03-02T00:00Z</start></timeInterval>
      <resolution>PT15M</resolution>
      <Point><position>1</position><quantity>1</quantity></Point>
      <Point><position>2</position><quantity> 2 </quantity></Point>
    </Period>
    <Period><timeInterval><start>2024-03-03T00:00Z</start></timeInterval>
      <Point><position>1</position><quantity>99</quantity></Point>
    </Period>
  </TimeSeries>
  <TimeSeries><mRID>no-period</mRID></TimeSeries>"""


def _write(root, zone_dir: str, name: str, text: str) -> None:
    d = os.path.join(root, zone_dir)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as fh:
        fh.write(text)


def test_flatten_cases(spark, tmp_path):
    root = str(tmp_path / "landing")
    _write(root, "country_code=SE/bidding_zone=Z1", "a.xml", NS_DOC.format(body=GOOD_BODY))
    _write(root, "country_code=SE/bidding_zone=Z2", "b.xml", PREFIXED)
    series = mx.read_documents(spark, root)
    assert series.count() == 3  # the series without a period still counts
    pts = rows(mx.flatten_points(series), "bidding_zone", "time_utc", "load_mw")
    assert pts == [
        ("Z1", ts("2024-03-01 00:00:00"), 10.0), ("Z1", ts("2024-03-01 02:00:00"), 30.5),
        ("Z1", ts("2024-03-02 00:00:00"), 1.0), ("Z1", ts("2024-03-02 00:15:00"), 2.0),
        ("Z2", ts("2024-03-01 01:00:00"), 40.25),
    ]
    res = rows(ingest.resolutions_seen(mx.periods(series)), "bidding_zone", "resolution_detected")
    assert res == [("Z1", "PT15M,PT60M"), ("Z2", "PT60M")]
    stats = rows(ingest.run_stats(mx.flatten_points(series), series), "bidding_zone", "rows_seen",
                 "source_timeseries_count")
    assert stats == [("Z1", 4, 2), ("Z2", 1, 1)]


@pytest.mark.parametrize("body", [
    GOOD_BODY.replace("PT15M", "PT30M"),                      # unknown resolution
    GOOD_BODY.replace("<quantity>10</quantity>", "<quantity>1x0</quantity>"),  # bad number
])
def test_flatten_failures(spark, tmp_path, body):
    root = str(tmp_path / "bad")
    _write(root, "country_code=SE/bidding_zone=Z1", "a.xml", NS_DOC.format(body=body))
    with pytest.raises(Exception):
        mx.flatten_points(mx.read_documents(spark, root)).collect()


def test_truncated_file_fails(spark, tmp_path):
    root = str(tmp_path / "trunc")
    _write(root, "country_code=SE/bidding_zone=Z1", "a.xml", NS_DOC.format(body=GOOD_BODY)[:400])
    with pytest.raises(Exception):
        mx.flatten_points(mx.read_documents(spark, root)).collect()


def test_round_trip_documents(spark, tmp_path, make_obs):
    pts = make_obs([("2024-01-01 00:00:00", "SE", "Z1", 1.5), ("2024-01-01 02:00:00", "SE", "Z1", 2.5)]) \
        .select("time_utc", "country_code", "bidding_zone", "load_mw").withColumn("resolution", F.lit("PT60M"))
    root = str(tmp_path / "rt")
    mx.write_documents(mx.to_documents(pts), root)
    back = mx.flatten_points(mx.read_documents(spark, root))
    assert rows(back, "time_utc", "load_mw") == [(ts("2024-01-01 00:00:00"), 1.5), (ts("2024-01-01 02:00:00"), 2.5)]


def _requests(spark, start, end, zone="Z1"):
    return spark.createDataFrame([("p", "SE", zone, start, end)],
                                 "pipeline_name string, country_code string, bidding_zone string, "
                                 "start_date string, end_date string")


def _marks(spark, last):
    data = [] if last is None else [("p", "SE", "Z1", ts(last), ts("2025-01-01 00:00:00"))]
    return spark.createDataFrame(data, STATE_SCHEMA)


def test_request_window_and_reversed_dates(spark):
    w = ingest.request_window(_requests(spark, "2024-01-01", "2024-01-02")).first()
    assert (w["requested_start_utc"], w["requested_end_utc"]) == (ts("2024-01-01 00:00:00"), ts("2024-01-02 23:00:00"))
    with pytest.raises(Exception):
        ingest.request_window(_requests(spark, "2024-02-01", "2024-01-01")).collect()


def test_effective_window_clamp(spark):
    w = ingest.request_window(_requests(spark, "2024-01-10", "2024-01-20"))
    assert ingest.effective_window(w, _marks(spark, None)).first()["effective_start_utc"] == ts("2024-01-10 00:00:00")
    assert ingest.effective_window(w, _marks(spark, "2024-01-01 05:00:00")).first()["effective_start_utc"] \
        == ts("2024-01-10 00:00:00")
    assert ingest.effective_window(w, _marks(spark, "2024-01-15 05:00:00")).first()["effective_start_utc"] \
        == ts("2024-01-15 06:00:00")
    step15 = F.expr("INTERVAL 15 MINUTES")
    assert ingest.effective_window(w, _marks(spark, "2024-01-15 23:45:00"), step15).first()["effective_start_utc"] \
        == ts("2024-01-16 00:00:00")
    ahead = ingest.effective_window(w, _marks(spark, "2024-02-01 00:00:00"))
    assert ingest.quarter_chunks(ahead).count() == 0
    noop = ingest.noop_runs(ahead, F.lit("r"), F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")).first()
    assert (noop["status"], noop["rows_seen"], noop["source_timeseries_count"]) == ("success", 0, 0)
    assert noop["requested_start_utc"] == ts("2024-02-01 01:00:00")


def test_quarter_chunks_cross_four_quarters(spark):
    w = ingest.effective_window(ingest.request_window(_requests(spark, "2024-02-15", "2024-11-03")),
                                _marks(spark, None))
    out = rows(ingest.quarter_chunks(w), "chunk_start_utc", "chunk_end_utc", "period_start", "period_end")
    assert out == [
        (ts("2024-02-15 00:00:00"), ts("2024-03-31 23:00:00"), "202402150000", "202404010000"),
        (ts("2024-04-01 00:00:00"), ts("2024-06-30 23:00:00"), "202404010000", "202407010000"),
        (ts("2024-07-01 00:00:00"), ts("2024-09-30 23:00:00"), "202407010000", "202410010000"),
        (ts("2024-10-01 00:00:00"), ts("2024-11-03 23:00:00"), "202410010000", "202411040000"),
    ]


def test_ingest_job_incremental(spark, tmp_path):
    root = str(tmp_path / "landing")
    _write(root, "country_code=SE/bidding_zone=Z1", "a.xml", NS_DOC.format(body=GOOD_BODY.replace(
        "<resolution>PT15M</resolution>", "<resolution>PT60M</resolution>")))
    paths = IngestPaths(root, str(tmp_path / "raw"), str(tmp_path / "marks"), str(tmp_path / "ledger"))
    req = spark.createDataFrame([("SE", "Z1", "2024-03-01", "2024-03-02")],
                                "country_code string, bidding_zone string, start_date string, end_date string")
    now = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    closed = ingest_job(spark, req, paths, now=now).first()
    assert (closed["status"], closed["rows_seen"], closed["rows_inserted"]) == ("success", 4, 4)
    assert closed["resolution_detected"] == "PT60M"
    assert spark.read.parquet(paths.raw).count() == 4
    mark = spark.read.parquet(paths.marks).first()
    assert mark["last_ingested_at_utc"] == ts("2024-03-02 01:00:00")
    # second run resumes after the mark: nothing new is inserted
    again = ingest_job(spark, req, paths, now=now).first()
    assert again["status"] == "success" and again["rows_inserted"] == 0
    assert spark.read.parquet(paths.raw).count() == 4
    ledger = spark.read.parquet(paths.ledger)
    assert ledger.filter("event_seq = 0").count() == 2 and ledger.filter("event_seq = 1").count() == 2


def test_ingest_job_failure_marks_run_failed(spark, tmp_path):
    root = str(tmp_path / "landing")
    _write(root, "country_code=SE/bidding_zone=Z1", "a.xml",
           NS_DOC.format(body=GOOD_BODY.replace("PT15M", "PT5M")))
    paths = IngestPaths(root, str(tmp_path / "raw"), str(tmp_path / "marks"), str(tmp_path / "ledger"))
    req = spark.createDataFrame([("SE", "Z1", "2024-03-01", "2024-03-02")],
                                "country_code string, bidding_zone string, start_date string, end_date string")
    with pytest.raises(Exception):
        ingest_job(spark, req, paths)
    last = spark.read.parquet(paths.ledger).filter("event_seq = 1").first()
    assert last["status"] == "failed" and "Unsupported resolution" in last["error_message"]


def test_ingest_resumes_by_resolution_seen(spark, tmp_path):
    """Quarter-hour data ending 23:45 resumes at 00:00, not 00:45."""
    pts = "".join(f"<Point><position>{p}</position><quantity>{p}</quantity></Point>" for p in range(1, 193))
    body = f"""<TimeSeries><mRID>q</mRID><Period>
        <timeInterval><start>2024-03-01T00:00Z</start></timeInterval>
        <resolution>PT15M</resolution>{pts}</Period></TimeSeries>"""
    root = str(tmp_path / "landing")
    _write(root, "country_code=SE/bidding_zone=Z1", "a.xml", NS_DOC.format(body=body))
    paths = IngestPaths(root, str(tmp_path / "raw"), str(tmp_path / "marks"), str(tmp_path / "ledger"))
    schema = "country_code string, bidding_zone string, start_date string, end_date string"
    now = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    first = ingest_job(spark, spark.createDataFrame([("SE", "Z1", "2024-03-01", "2024-03-01")], schema),
                       paths, now=now).first()
    assert first["rows_inserted"] == 96 and first["max_event_time_utc"] == ts("2024-03-01 23:45:00")
    second = ingest_job(spark, spark.createDataFrame([("SE", "Z1", "2024-03-01", "2024-03-02")], schema),
                        paths, now=F.lit("2025-01-02 00:00:00").cast("timestamp_ntz")).first()
    assert second["requested_start_utc"] == ts("2024-03-02 00:00:00") and second["rows_inserted"] == 96
    assert spark.read.parquet(paths.raw).count() == 192


def _run(spark, paths, zones, start, end, day=1):
    schema = "country_code string, bidding_zone string, start_date string, end_date string"
    req = spark.createDataFrame([("SE", z, start, end) for z in zones], schema)
    return {r["bidding_zone"]: r for r in ingest_job(
        spark, req, paths, now=F.lit(f"2025-01-0{day} 00:00:00").cast("timestamp_ntz")).collect()}


def _paths(tmp_path):
    return IngestPaths(*(str(tmp_path / n) for n in ("landing", "raw", "marks", "ledger")))


def _series(day, res, n, value=1.0, name="s"):
    pts = "".join(f"<Point><position>{p}</position><quantity>{value}</quantity></Point>" for p in range(1, n + 1))
    return (f"<TimeSeries><mRID>{name}</mRID><Period><timeInterval><start>2024-03-0{day}T00:00Z</start>"
            f"<end>2024-03-0{day + 1}T00:00Z</end></timeInterval><resolution>{res}</resolution>{pts}</Period></TimeSeries>")


def test_one_bad_zone_fails_alone(spark, tmp_path):
    paths = _paths(tmp_path)
    good, bad = _series(1, "PT60M", 24), _series(1, "PT60M", 24).replace("<quantity>1.0", "<quantity>1x", 1)
    _write(paths.landing, "country_code=SE/bidding_zone=Z1", "a.xml", NS_DOC.format(body=good))
    _write(paths.landing, "country_code=SE/bidding_zone=Z2", "a.xml", NS_DOC.format(body=good)[:-60])
    _write(paths.landing, "country_code=SE/bidding_zone=Z3", "a.xml", NS_DOC.format(body=bad))
    _write(paths.landing, "country_code=SE/bidding_zone=Z4", "a.xml", NS_DOC.format(body=_series(1, "PT5M", 3)))
    got = _run(spark, paths, ["Z1", "Z2", "Z3", "Z4", "Z5"], "2024-03-01", "2024-03-02")
    assert {z: r["status"] for z, r in got.items()} == {"Z1": "success", "Z2": "failed", "Z3": "failed", "Z4": "failed", "Z5": "success"}
    assert (got["Z1"]["rows_seen"], got["Z1"]["rows_inserted"], got["Z5"]["rows_seen"]) == (24, 24, 0)
    assert (got["Z3"]["rows_seen"], got["Z3"]["rows_inserted"]) == (23, 0)
    assert "malformed document: a.xml" in got["Z2"]["error_message"] and "1x" in got["Z3"]["error_message"]
    assert "Unsupported resolution PT5M" in got["Z4"]["error_message"]
    assert {r["bidding_zone"] for r in spark.read.parquet(paths.raw).collect()} == {"Z1"}
    assert [r["bidding_zone"] for r in read_version(spark, paths.marks, STATE_SCHEMA).collect()] == ["Z1"]


def test_window_decides_series_resolution_and_resume(spark, tmp_path):
    paths = _paths(tmp_path)
    for day, res, n in ((1, "PT15M", 96), (2, "PT60M", 24), (3, "PT60M", 24)):
        _write(paths.landing, "country_code=SE/bidding_zone=Z1/quarter=2024Q1", f"{day}.xml", NS_DOC.format(body=_series(day, res, n)))
    _write(paths.landing, "country_code=SE/bidding_zone=Z1/quarter=2024Q2", "bad.xml", "<broken")
    got = [_run(spark, paths, ["Z1"], "2024-03-01", f"2024-03-0{d}", d)["Z1"] for d in (1, 2, 3)]
    assert [(r["resolution_detected"], r["source_timeseries_count"], r["rows_inserted"]) for r in got] == [
        ("PT15M", 1, 96), ("PT60M", 1, 24), ("PT60M", 1, 24)]
    assert [r["requested_start_utc"] for r in got] == [ts(f"2024-03-0{d} 00:00:00") for d in (1, 2, 3)]


def test_only_requested_quarters_are_listed(spark, tmp_path):
    root = str(tmp_path / "landing")
    for q in ("2023Q4", "2024Q1", "2024Q2"):
        _write(root, f"country_code=SE/bidding_zone=Z1/quarter={q}", "a.xml", NS_DOC.format(body=_series(1, "PT60M", 2)))
    w = ingest.effective_window(ingest.request_window(_requests(spark, "2024-01-01", "2024-03-31")), _marks(spark, None))
    folders = mx.requested_folders(spark, root, ingest.quarter_chunks(w))
    assert [f.rsplit("/", 1)[1] for f in folders] == ["quarter=2024Q1"]
    assert mx.read_documents(spark, folders, strict=False, base_path=root).count() == 1


def test_first_document_wins(spark, tmp_path):
    paths = _paths(tmp_path)
    for i in range(8):
        _write(paths.landing, "country_code=SE/bidding_zone=Z1", f"{i}.xml", NS_DOC.format(body=_series(1, "PT60M", 24, value=float(i))))
    conf = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        assert _run(spark, paths, ["Z1"], "2024-03-01", "2024-03-01")["Z1"]["rows_inserted"] == 24
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r["load_mw"] for r in spark.read.parquet(paths.raw).collect()} == {0.0}


def test_unreadable_marks_fail_and_stay(spark, tmp_path):
    paths = _paths(tmp_path)
    _write(paths.landing, "country_code=SE/bidding_zone=Z1", "a.xml", NS_DOC.format(body=_series(1, "PT60M", 24)))
    _run(spark, paths, ["Z1"], "2024-03-01", "2024-03-01")
    [part] = [f for f in os.listdir(f"{paths.marks}/v=1") if f.endswith(".parquet")][:1]
    healthy = open(f"{paths.marks}/v=1/{part}", "rb").read()
    with open(f"{paths.marks}/v=1/{part}", "wb") as fh:
        fh.write(b"not parquet")
    with pytest.raises(Exception):
        _run(spark, paths, ["Z1"], "2024-03-01", "2024-03-02", 2)
    assert os.listdir(paths.marks) == ["v=1"] or "v=2" not in os.listdir(paths.marks)
    with open(f"{paths.marks}/v=1/{part}", "wb") as fh:
        fh.write(healthy)
