"""The rule ledger against a plain restatement of its measurements, and policies by bits."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_helpers import SF, documents
from loadlens.llm import ledger as L
from loadlens.llm import texts as X
from loadlens.llm.queries import QUERIES, SQL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text: str) -> list[int]:
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return [len(text.encode()), len(text), len(words), sum(map(len, words)), max(map(len, words), default=0),
            sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7f]", w)) for w in words),
            sum(len(re.findall("[A-Z]", w)) > 1 and not re.search("[a-z]", w) for w in words),
            sum(c in "#*$%&|<>" for c in text), sum(c in "!?" for c in text),
            len(lines), len(lines) - len(set(lines)), len(repeated), sum(map(str.__eq__, words, words[1:]))]


def measured(texts: list[str]) -> list[list[int]]:
    found = L._measured(pa.array([t.encode() for t in texts], pa.binary()))
    return [[int(x) for x in row] for row in zip(*found, strict=True)]


TEXT = st.text("ab é数#!\n \t\x0b\x1fAB", max_size=60) | st.lists(st.sampled_from(["a", "b", "a b a b a b", "\n", "é!", "AB"]), max_size=30).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_measurements_equal_a_plain_count(texts):
    assert measured(texts) == [plain(t) for t in texts]


def test_equal_keys_of_other_windows(monkeypatch):
    """With a key that is the same for all windows only equal windows count."""
    monkeypatch.setattr(L, "MIX", np.uint64(0))
    codes = np.array([1, 2, 3, 4, 9, 5, 1, 2, 3, 4, 9, 6, 7, 8, 5, 5, 5, 5, 9], np.int32)  # keys hold the last word alone
    assert L.repeated_words(codes, np.zeros(len(codes), np.int64), 1).tolist() == [10]


def test_cut_by_bytes_keeps_every_row_once():
    sizes = [0, 5, 100, 3, 3, 3, 0, 50, 1]
    batch = pa.record_batch([pa.array(range(len(sizes))), pa.array([b"x" * n for n in sizes], pa.binary())], ["a", "t"])
    parts = list(X.cut_by_bytes(batch, 1, 10))
    assert [r for p in parts for r in p.column(0).to_pylist()] == list(range(len(sizes)))
    assert all(p.num_rows == 1 or sum(map(len, p.column(1).to_pylist())) <= 10 for p in parts)


def test_odd_rows_and_empty_table(spark, odd_docs, no_docs):
    rows = [tuple(r) for r in L.measure(odd_docs).collect()]
    expected = [(r["doc_id"], *plain(r["text"] or "")) if r["text"] is None or len(r["text"]) < 1000 else None
                for r in odd_docs.select("doc_id", "text").collect()]
    assert len(rows) == len(expected)
    for e in filter(None, expected):
        assert e in rows
    assert {r[-2] for r in rows if r[0] == 7} == {160_000}  # the very long text repeats itself throughout
    assert L.judged(L.measure(no_docs)).count() == 0


@pytest.fixture(scope="module")
def ledger(spark):
    return L.judged(L.measure(spark.read.parquet(f"{SF}/documents.parquet"))).cache()


def test_policies_and_ablations_equal_a_recount(ledger):
    rows = ledger.collect()
    bit = {r.name: 1 << r.bit for r in L.RULES}
    for policy in L.POLICIES.values():
        hard, soft = L.mask(policy.reject), L.mask(policy.soft)

        def out(bits, hard=hard, soft=soft, policy=policy):
            return bool(bits & hard) or (bits & soft).bit_count() > policy.allowed if policy.soft else bool(bits & hard)

        kept = {(r["doc_id"], r["failed"], r["kept"]) for r in L.with_policy(ledger, policy).collect()}
        assert kept == {(r["doc_id"], r["failed"], not out(r["failed"])) for r in rows}
        found = {r["rule"]: r for r in L.ablations(L.mask_counts(ledger), policy).collect()}
        assert set(found) == set(policy.reject + policy.soft)
        for name, r in found.items():
            freed = [x for x in rows if out(x["failed"]) and not out(x["failed"] & ~bit[name])]
            assert r["n_failed"] == sum(bool(x["failed"] & bit[name]) for x in rows)
            assert r["n_rejected"] == sum(out(x["failed"]) for x in rows)
            assert (r["n_freed"], r["words_freed"]) == (len(freed), sum(x["n_words"] for x in freed))
            assert r["n_alone"] == sum(out(x["failed"]) and x["failed"] & (hard | soft) == bit[name] for x in rows)


def test_good_documents_stay_and_bad_ones_go(spark):
    verdict = QUERIES["op11_quality_rules"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").dropDuplicates(["doc_id"])
    table = {(r["quality"], r["kept"]): r["count"] for r in verdict.join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert table[1, True] / (table[1, True] + table.get((1, False), 0)) > 0.97
    assert table.get((0, False), 0) / sum(v for (q, _), v in table.items() if q == 0) > 0.99


def test_query_equals_its_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    result = con.execute(SQL["op11_quality_rules"])
    names = [d[0] for d in result.description]
    found = sorted(tuple(r) for r in QUERIES["op11_quality_rules"](spark, SF).select(*names).collect())
    assert found == sorted(result.fetchall()) and len(found) == len(documents())
