"""SimHash classes and exact top-k against brute force."""

from __future__ import annotations

import math
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_helpers import SF, documents
from loadlens.llm import simhash as S
from loadlens.llm.common import components
from loadlens.llm.queries import QUERIES
from loadlens.llm.topk import integer_codes, top_k, usable


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps: dict) -> dict:
    """Smallest id reachable over links of 3 or fewer bits, by brute force."""
    names = list(fps)
    values = np.array([fps[n] for n in names], np.uint64)
    parent = {n: n for n in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, n in enumerate(names):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3):
            a, b = find(n), find(names[j])
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in names}


def test_op9_equals_brute_force(spark):
    fps = {d: plain_fingerprint(t) for d, t, *_ in documents()}
    expected = classes(fps)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op9_simhash_dedup"](spark, SF).collect()}
    assert got == {d: (format(f, "016x"), expected[d]) for d, f in fps.items()}


@settings(max_examples=200, deadline=None)
@given(st.text("aAbBéÉ \t\nß1", max_size=30))
def test_fingerprint_of_any_text(text):
    assert S.simhash(text.encode()) == plain_fingerprint(text)


def test_masks_leave_no_pair_out():
    masks = S.key_masks(3)
    rng = np.random.default_rng(5)
    for _ in range(2000):
        x = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(x & m == 0 for m in masks)


@pytest.mark.parametrize("piece", [1 << 30, 16])
def test_dense_and_sparse_groups_link_as_by_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(S, "PIECE", piece)  # 16: most keys are cut into pieces
    rng = np.random.default_rng(3)
    values = set(rng.integers(0, 1 << 63, 300).tolist())
    walk = 12345
    for _ in range(400):  # a chain of neighbours: one large class
        walk ^= 1 << int(rng.integers(0, 64))
        values.add(walk)
    for v in list(values)[:100]:
        values.add(v ^ (1 << int(rng.integers(0, 64))) ^ (1 << int(rng.integers(0, 64))))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    expected = classes({v: v % (1 << 64) for v in signed})
    roots = {r["node"]: r["root"] for r in components(S.links(spark.createDataFrame([(v,) for v in signed], "fp long"))).collect()}
    got = {v: roots.get(v, v) for v in signed}
    assert len(set(expected.values())) == len(set(got.values()))
    pairs = {(expected[v], got[v]) for v in signed}
    assert len(pairs) == len(set(expected.values()))


def test_links_are_a_forest_not_all_pairs(spark):
    fps = spark.range(0, 1 << 12).select(F.col("id").alias("fp"))  # 4096 values within 12 bits of each other
    assert S.links(fps).count() < 12 * len(S.key_masks(3)) * 4096


def test_odd_documents(spark, odd_docs, no_docs):
    got = S.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[2]["component_id"] == 1 and sum(r["doc_id"] == 1 for r in got) == 2
    assert {by_id[d]["component_id"] for d in (4, 5, 6)} == {4} and by_id[4]["fp"] == 0
    assert by_id[9]["component_id"] == 9
    assert {r["component_id"] for r in got if r["doc_id"] is None} == {None, 4}
    assert S.near_duplicates(no_docs).collect() == []


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(200, 300)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in [5, *range(200, 300)]}}


# ------------------------------------------------------------------ top-k

def best(codes: list[tuple[int, list[int]]], wanted, k):
    out = {}
    for q, a in codes:
        if wanted(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in codes if c != q)
            out[q] = [(c, -s) for s, c in scored[:k]]
    return out


def test_top_k_with_ties_gaps_and_odd_vectors(spark):
    nan, inf = math.nan, math.inf
    rows = [(i, [((i * 7 + d) % 5 - 2) / 256.0 if (i + d) % 3 else 0.0 for d in range(6)]) for i in range(60)]
    odd = [(100, None), (101, [1.0, None]), (102, [nan, 1.0]), (103, [inf] * 6), (104, []), (105, [0.5]), (None, [1.0] * 6)]
    df = spark.createDataFrame([(*r, "x") for r in rows + odd], "vec_id long, embedding array<double>, score string")
    made = df.where(usable("embedding")).select("vec_id", integer_codes("embedding").alias("codes"), "score")
    got = {}
    for r in top_k(made, F.col("vec_id") % 5 == 0, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    codes = [(i, [math.floor(256 * x) for x in v]) for i, v in rows + [(104, []), (105, [0.5])]]
    assert got == best(codes, lambda q: q % 5 == 0, 5)


def test_top_k_few_candidates_and_huge_codes(spark):
    df = spark.createDataFrame([(0, [1 << 40, 3]), (1, [1 << 21, -1]), (1, [5, 5])], "vec_id long, codes array<long>")
    got = [tuple(r) for r in top_k(df, F.col("vec_id") == 0, 5).orderBy("rank").collect()]
    assert got == [(0, 1, 1, (1 << 61) - 3), (0, 2, 1, 5 * (1 << 40) + 15)]
    assert top_k(df.limit(0), F.lit(True), 5).collect() == []


def test_op2_reads_all_rows(spark):
    got = QUERIES["op2_exact_topk"](spark, SF).collect()
    assert len(got) == 5 * len({r["query_id"] for r in got}) == 5 * 10
