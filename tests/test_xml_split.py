"""Documents read by byte ranges give what a whole-file reader gives, in document order."""

from __future__ import annotations

import os

import pytest
from conftest import rows
from test_ingest import GOOD_BODY, NS_DOC, PREFIXED, _write

from loadlens.sources import market_xml as mx

ATTRIBUTES = GOOD_BODY.replace("<TimeSeries>", "<TimeSeries version='1' note=\"a > b, 'c'\">")
ODD = {
    "comment": NS_DOC.format(body="<!-- <TimeSeries><mRID>x</mRID></TimeSeries> -->" + GOOD_BODY),
    "cdata": NS_DOC.format(body=GOOD_BODY.replace("no-period", "<![CDATA[</TimeSeries>]]>")),
    "end tag": NS_DOC.format(body=GOOD_BODY.replace("</TimeSeries>", "</TimeSeries  >")),
    "empty tag": NS_DOC.format(body=GOOD_BODY + "<TimeSeries/>"),
    "inner name": NS_DOC.format(body=GOOD_BODY.replace("</mRID>", "</mRID><OtherTimeSeries>y</OtherTimeSeries>", 1)),
}


@pytest.fixture
def split_bytes(spark):
    """Sets the size of a file split for one test."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def use(n: int):
        for k, v in zip(keys, (n, 0), strict=True):
            spark.conf.set(k, v)
    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def points(series):
    return rows(mx.flatten_points(series).drop("doc_order"))


@pytest.mark.parametrize("size", [37, 200, 1 << 20])
def test_any_split_gives_the_rows_of_a_whole_read(spark, tmp_path, split_bytes, size):
    root = str(tmp_path / "landing")
    for i, text in enumerate([NS_DOC.format(body=GOOD_BODY), PREFIXED, NS_DOC.format(body=ATTRIBUTES), NS_DOC.format(body="")]):
        _write(root, f"country_code=SE/bidding_zone=Z{i}", "a.xml", text)
    expected = points(mx.read_documents(spark, root))
    series = rows(mx.read_documents(spark, root), "mRID", "bidding_zone")
    split_bytes(size)
    found = mx.read_documents_split(spark, root)
    assert points(found) == expected and rows(found, "mRID", "bidding_zone") == series


@pytest.mark.parametrize("kind", ODD)
def test_documents_whose_tags_do_not_tell_are_read_whole(spark, tmp_path, split_bytes, kind):
    root = str(tmp_path / "landing")
    _write(root, "country_code=SE/bidding_zone=Z1", "odd.xml", ODD[kind])
    _write(root, "country_code=SE/bidding_zone=Z2", "plain.xml", NS_DOC.format(body=GOOD_BODY))
    expected = points(mx.read_documents(spark, root))
    split_bytes(150)
    assert [os.path.basename(p) for p in mx.unsplittable(spark, root)] == ["odd.xml"]
    assert points(mx.read_documents_split(spark, root)) == expected


@pytest.mark.parametrize("cut", ["</Period>", "<Point>", "</TimeSeries>"])
def test_documents_that_break_off_fail(spark, tmp_path, split_bytes, cut):
    root = str(tmp_path / "landing")
    whole = NS_DOC.format(body=GOOD_BODY)
    _write(root, "country_code=SE/bidding_zone=Z1", "a.xml", whole[:whole.index(cut)])
    split_bytes(100)
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        mx.read_documents_split(spark, root).collect()


def test_malformed_series_fails(spark, tmp_path):
    root = str(tmp_path / "landing")
    _write(root, "country_code=SE/bidding_zone=Z1", "a.xml", NS_DOC.format(body=GOOD_BODY.replace("</Point>", "</Pt>", 1)))
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        mx.read_documents_split(spark, root).collect()


def test_one_large_document_is_read_by_several_tasks_in_order(spark, tmp_path, split_bytes):
    root, days = str(tmp_path / "landing"), 4000
    one = ("<TimeSeries><mRID>s{i}</mRID><Period><timeInterval><start>2024-01-01T00:00Z</start></timeInterval><resolution>PT15M</resolution>"
           + "".join(f"<Point><position>{p}</position><quantity>{p}.5</quantity></Point>" for p in range(1, 25)) + "</Period></TimeSeries>\n")
    _write(root, "country_code=SE/bidding_zone=Z1", "large.xml", NS_DOC.format(body="".join(one.format(i=i) for i in range(days))))
    split_bytes(1 << 20)
    found = mx.read_documents_split(spark, root)
    assert found.rdd.getNumPartitions() >= 5
    assert [r["mRID"] for r in found.orderBy(mx.FILE, mx.SEQ).select("mRID").collect()] == [f"s{i}" for i in range(days)]
    first = mx.flatten_points(found).orderBy("doc_order").select("load_mw").limit(30).collect()
    assert [r[0] for r in first] == [p + 0.5 for p in [*range(1, 25), *range(1, 7)]]
    assert mx.flatten_points(found).count() == 24 * days
