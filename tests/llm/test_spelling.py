"""Spelling variants against brute force over all pairs of a small vocabulary."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_helpers import SF, SF_TINY, documents
from loadlens.llm import spelling as S
from loadlens.llm.queries import QUERIES, SQL


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts: dict[str, int]) -> set[tuple]:
    out, form = {}, {}
    for w, n in counts.items():
        close = sorted(((-m, v) for v, m in counts.items() if near(w, v)))
        good = close and -close[0][0] >= 2 * n
        form[w] = close[0][1] if good else None
        out[w] = (n, len(close), -close[0][0] if good else None)
    rows = set()
    for w, (n, n_near, form_n) in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n, n_near, form_n))
    return rows


def vocabulary(docs: list[tuple]) -> dict[str, int]:
    counts = Counter()
    for doc_id, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({i: i + 32 for i in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def answer(df) -> set[tuple]:
    return {tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()}


WORDS = st.lists(st.text("abÿé", min_size=1, max_size=6), max_size=40, unique=True)


@settings(max_examples=150, deadline=None)
@given(WORDS, st.integers(1, 64))
def test_every_near_pair_is_probed_once(words, limit):
    """Without Spark: filters of one block range each, all words as probes."""
    sizes = {}
    for w in words:
        sizes[S.shard_of(len(w))] = 4
    pairs = []
    for ranges in S.passes(sizes, limit):
        filters = {s: np.zeros(b - a, np.uint64) for s, (a, b) in ranges.items()}
        for w in words:
            shard = S.shard_of(len(w))
            total = S.term(np.arange(len(w))[None, :], S.letters([w])).sum(axis=1, dtype=np.uint64)
            block, bits = S.block_and_bits(total, sizes[shard])
            if shard in ranges and ranges[shard][0] <= block[0] < ranges[shard][1]:
                filters[shard][int(block[0]) - ranges[shard][0]] |= bits[0]
        probe = S.Probe(filters, ranges, sizes, [ord(c) for c in "abÿé"])
        pairs += [(words[i], v) for i, v in probe.edits(words) if v in words]
    expected = {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}
    assert {frozenset(p) for p in pairs} == expected and len(pairs) == len(expected)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 16).map(lambda k: 1 << k), max_size=8), st.integers(1, 1 << 18))
def test_passes_cover_every_block_once_within_the_limit(sizes, limit):
    seen = {s: [] for s in sizes}
    for ranges in S.passes(sizes, limit):
        assert 8 * sum(b - a for a, b in ranges.values()) <= max(limit, 8 * S.PAGE)
        for s, (a, b) in ranges.items():
            assert a % S.PAGE == 0
            seen[s].append((a, b))
    for s, n in sizes.items():
        assert [a for a, _ in seen[s]] == [0, *[b for _, b in seen[s]][:-1]] and seen[s][-1][1] == n


@pytest.mark.parametrize("limit", [None, 8 * S.PAGE])
def test_vocabulary_with_long_and_hot_words_equals_brute_force(spark, limit):
    rnd = random.Random(7)
    base = ["".join(rnd.choices("abcdé", k=rnd.choice([5, 6, 9, 63, 64, 65, 300]))) for _ in range(60)]
    words = set(base) | {"center", "centre", "aaaaaa", "aaaaa", "aaaaaaa"}
    for w in base:
        i = rnd.randrange(len(w))
        words |= {w[:i] + w[i + 1:], w[:i] + "b" + w[i + 1:], w[:i] + "z" + w[i:]}
    words |= {"hotword"[:i] + c + "hotword"[i + 1:] for i in range(7) for c in "abcxyz"}
    counts = {w: rnd.choice([3, 3, 4, 6, 8, 12, 24, 100]) for w in sorted(words)}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert answer(S.spelling_variants(table, limit=limit)) == brute(counts)


def test_forms_are_followed_to_the_last(spark):
    counts = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96}
    found = {r[0]: r[2] for r in answer(S.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))}
    assert set(found.values()) == {"bbbbb"}


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    rows = odd_docs.unionByName(odd_docs).unionByName(odd_docs)
    expected = brute(vocabulary([tuple(r) for r in rows.select("doc_id", "text").collect()]))
    assert answer(S.text_variants(rows)) == expected and expected
    assert answer(S.text_variants(no_docs)) == set()


def test_query_equals_brute_force_and_its_sql(spark):
    found = answer(QUERIES["op13_spelling_variants"](spark, SF_TINY))
    assert found == brute(vocabulary(documents(SF_TINY)))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert answer(QUERIES["op13_spelling_variants"](spark, SF)) == set(con.execute(SQL["op13_spelling_variants"]).fetchall())
