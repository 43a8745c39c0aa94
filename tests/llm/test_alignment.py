"""Token alignment against a plain restatement with the libraries on whole texts."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_helpers import SF_TINY, documents
from loadlens.llm import alignment as A
from loadlens.llm.memo import ENTRY, ByteMemo, by_bytes
from loadlens.llm.queries import QUERIES

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_ids(text):
    """Ids of a whole text by both libraries; none if they do not give back its bytes."""
    if not text:
        return [], []
    a = A.byte_level(BYTES).encode(" " + text, add_special_tokens=False).ids
    b = A.pieces_model(PIECES).encode(text)
    whole = (" " + text).encode()
    good = all(b"".join(A.token_bytes(p)[i] for i in ids) == whole for p, ids in ((BYTES, a), (PIECES, b)))
    return (a, b) if good else ([], [])


def plain_groups(a, b):
    """Groups by the set of byte offsets at which both sides end."""
    ends = []
    for path, ids in ((BYTES, a), (PIECES, b)):
        at, out = 0, []
        for i in ids:
            at += len(A.token_bytes(path)[i])
            out.append(at)
        ends.append(out)
    common, out = set(ends[0]) & set(ends[1]), [([], [])]
    x = y = 0
    for end in sorted(common):
        while x < len(a) and ends[0][x] <= end:
            out[-1][0].append(a[x])
            x += 1
        while y < len(b) and ends[1][y] <= end:
            out[-1][1].append(b[y])
            y += 1
        out.append(([], []))
    return out[:-1]


def plain_rows(docs):
    aligned = [(d, *plain_ids(t)) for d, t in docs]
    groups = [plain_groups(a, b) for _, a, b in aligned]
    counts = Counter((g[0][-1], g[1][-1]) for one in groups for g in one)
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for (doc, a, b), one in zip(aligned, groups, strict=True):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in one)
        links = [(x[-1], y[-1]) for x, y in one]
        out.append((doc, len(a), len(b), len(one), len(links), sum(counts[p] == most[p[1]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if one else ""))
    return out


ORDER = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def answer(df, key="id"):
    return sorted((tuple(r) for r in df.select(key, *ORDER).collect()), key=str)


ENDS = st.lists(st.integers(1, 3), min_size=1, max_size=80)


@settings(max_examples=400, deadline=None)
@given(ENDS, ENDS, st.integers(0, 200), st.integers(0, 200))
def test_diagonal_runs_equal_the_common_ends(a, b, run_a, run_b):
    """Irregular starts, long one-to-one runs in the middle, other shifts behind."""
    a, b = a + [2] * run_a + a, b + [2] * run_b + b
    gap = sum(a) - sum(b)
    (b if gap > 0 else a).extend([1] * abs(gap))
    one, two = np.cumsum(a), np.cumsum(b)
    found = A.align(one, two)
    common = np.intersect1d(one, two)
    assert one[found[0] - 1].tolist() == two[found[1] - 1].tolist() == common.tolist()


@lru_cache
def kept_encoder():
    return A.Encoder(BYTES, PIECES)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60) | st.text("ab Àé'’s\t\n ▁　数019_!?.<|endoftext|></s><0x41>", max_size=60))
def test_parts_encode_as_whole_texts(text):
    import pyarrow as pa
    encoder = kept_encoder()
    data, offsets = A.flat(pa.array([(" " + text).encode() if text else b""], pa.binary()))
    ids_a, ids_b, _, _ = encoder.encode(data, offsets)
    assert (ids_a.tolist(), ids_b.tolist()) == tuple(map(list, plain_ids(text)))


def test_rows_of_long_and_short_texts_in_stretches(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(A, "STRETCH", 50)
    texts = ["", "one two", "x" * 400, "Grüße, 数字 and more words " * 30, "▁ lost", " ", "end"]
    aligner = A.Aligner(BYTES, PIECES)
    found = aligner.rows(pa.array([(" " + t).encode() if t else b"" for t in texts], pa.binary()))
    expected = plain_rows(list(enumerate(texts)))
    assert [c.to_pylist() for c in found[:3]] == [[r[k] for r in expected] for k in (1, 2, 3)]
    assert found[4].to_pylist() == [r[-1] for r in expected]


def test_every_linked_pair_is_linkable(spark):
    docs = spark.read.parquet(f"{SF_TINY}/documents.parquet")
    pairs = [r["pair"] for r in A.link_counts(A.alignments(docs, BYTES, PIECES)).collect()]
    size, a, b = len(A.token_bytes(PIECES)), A.token_bytes(BYTES), A.token_bytes(PIECES)
    assert all(a[p // size].endswith(b[p % size]) or b[p % size].endswith(a[p // size]) for p in pairs)
    assert len(pairs) <= A.linkable_pairs(BYTES, PIECES) < 1_000_000
    with pytest.raises(ValueError, match="allow"):
        A.with_link_counts(A.alignments(docs, BYTES, PIECES), A.link_counts(A.alignments(docs, BYTES, PIECES)), size, 3)


def test_linkable_pairs_equal_a_count_over_all_pairs(monkeypatch):
    tables = {"x": [b"a", b"ba", b"", b"cba", b"z"], "y": [b"a", b"cba", b"", b"dcba", b"a"]}
    monkeypatch.setattr(A, "token_bytes", tables.get)
    both = [(a, b) for a in filter(None, tables["x"]) for b in filter(None, tables["y"]) if a.endswith(b) or b.endswith(a)]
    assert A.linkable_pairs("x", "y") == len(both)


def test_odd_rows_and_empty_table(spark, odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    assert answer(A.aligned_corpus(odd_docs, BYTES, PIECES)) == sorted(plain_rows(docs), key=str)
    assert answer(A.aligned_corpus(no_docs, BYTES, PIECES)) == []


def test_query_equals_brute_force(spark):
    docs = [(d, t) for d, t, *_ in documents(SF_TINY)]
    assert answer(QUERIES["op12_token_alignment"](spark, SF_TINY), "doc_id") == sorted(plain_rows(docs), key=str)


def test_memo_is_bounded_by_bytes_and_right():
    rnd, asked = random.Random(3), []
    memo = ByteMemo(lambda keys: asked.append(len(keys)) or [k * 2 for k in keys], limit=100 * ENTRY)
    for _ in range(300):
        keys = [str(rnd.randrange(400)).encode() * rnd.choice([1, 1, 9]) for _ in range(40)]
        assert memo.values(keys) == [k * 2 for k in keys]
        assert sum(len(k) + len(v) + ENTRY for k, v in memo.known.items()) == memo.used <= 100 * ENTRY
    assert sum(asked) < 300 * 40
    keys = [b"x" * n for n in (5, 0, 30, 7, 7)]
    assert [k for some in by_bytes(keys, 10) for k in some] == keys
