"""Token counts and token files against the tokenizers library."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from llm_helpers import SF, documents
from loadlens.llm import pretokens as P
from loadlens.llm import token_output as O
from loadlens.llm.queries import QUERIES, vocabulary
from loadlens.llm.token_count import token_counts
from loadlens.session import scratch_path

WORD = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_whole_tokens_are_proved(library):
    whole = P.whole_tokens(WORD)
    assert 30_000 < len(whole) <= 49_408
    for text in list(whole)[::997]:
        assert ids(library, text) == [whole[text]]


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60) | st.text("abcÀéÏß'’s ’\t\n019_!?.<|endoftext|>", max_size=60))
def test_any_text_encodes_as_by_the_library(text):
    library = P.load(WORD)
    data = text.encode()
    expected = library.encode(text, add_special_tokens=False).ids
    assert P.counter(WORD, frozenset(P.whole_tokens(WORD)))(data) == len(expected)
    assert np.frombuffer(P.encoder(WORD, P.whole_tokens(WORD))(data), "<u4").tolist() == expected


WORDS = st.lists(st.sampled_from(["Word", "WORD", "Ärger", "ſtraßé", "×mal", "a×b", "İl", "it's", "'S", "x'", "end.'s", "a<|endoftext|>", "<|ENDOFTEXT|>",
                                  "fin!!", "a.b", "_a_", "a_", "...", "9", "a9.", "$x", "ñ&&&", "o\u0301.", "Ωmega,", "語。", "\xa0", " ", "\n", ","]),
                 max_size=12)


@settings(max_examples=150, deadline=None)
@given(st.lists(WORDS.map(" ".join) | WORDS.map("".join), max_size=6))
def test_columns_of_words_with_signs_behind_them_encode_as_by_the_library(texts):
    import pyarrow as pa
    library, whole = P.load(WORD), P.whole_tokens(WORD)
    column = pa.array([t.encode() for t in texts], pa.binary())
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    found, ends = P.batch_encoder(WORD, whole)(column)
    assert found.tolist() == [i for e in expected for i in e]
    assert ends.tolist() == np.cumsum([len(e) for e in expected], dtype=np.int64).tolist()
    assert P.batch_counter(WORD, whole)(column).tolist() == [len(e) for e in expected]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_go_through_the_library(name):
    path = public_tokenizers.path(name)
    assert not P.splits_words(path)
    for text in ("Hello  world, it's 12 o'clock!", "", " \n "):
        assert P.counter(path, {})(text.encode()) == len(P.library_ids(path, text))


def test_memo_stays_bounded_and_right():
    made = P.Memo(lambda x: x * 2, limit=10)
    assert [made[i % 37] for i in range(500)] == [i % 37 * 2 for i in range(500)]
    assert len(made) + len(made.old) <= 20


def test_worker_memory_stays_bounded_on_unspaced_texts():
    """10,000 texts of one part of 3,000 characters each: what is kept stays near the stated bytes."""
    import resource

    import pyarrow as pa
    count, encode = P.batch_counter(WORD, frozenset(P.whole_tokens(WORD))), P.batch_encoder(WORD, P.whole_tokens(WORD))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    for start in range(0, 10_000, 100):
        texts = pa.array([("数字" * 1498 + f"{i:04d}").encode() for i in range(start, start + 100)], pa.binary())
        tokens = count(texts)
        ids, ends = encode(texts)
        assert np.diff(ends, prepend=0).tolist() == tokens.tolist() and len(ids) == tokens.sum()
    grown = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024
    assert grown < 3 * 2 * P.PART_BYTES / (1 << 20) + 200


def test_op4_equals_the_library(spark, library):
    expected = {d: (len((t or "").encode()), len(ids(library, t)), len(ids(library, t)) > 2048) for d, t, *_ in documents()}
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in QUERIES["op4_token_counts"](spark, SF).collect()}
    assert got == expected


def test_op3_equals_the_library(spark, library):
    expected, start = {}, 0
    for doc, text, *_ in documents():
        all_ids = [*ids(library, text), 2]
        expected[doc] = (start, len(all_ids), zlib.crc32(np.array(all_ids, "<u4").tobytes()))
        start += len(all_ids)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op3_token_output"](spark, SF).collect()}
    assert got == expected


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 255), st.integers(0, 49_407), st.integers(0, (1 << 32) - 1)), max_size=3000))
def test_codes_round_trip_and_give_random_access(values):
    chunks, bitmaps, ranks = O.encode_levels(np.array(values, np.uint32))
    assert O.decode_levels(chunks, bitmaps).tolist() == values
    for place in range(0, len(values), 7):
        assert O.token_at(chunks, bitmaps, ranks, place) == values[place]


def test_random_access_over_files(spark, library, odd_docs):
    out = scratch_path(spark, "tokens")
    O.write_tokens(odd_docs, out, vocabulary(), 2)
    rows = sorted(O.read_documents(spark, out).collect(), key=lambda r: r["start"])
    stream = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in rows]).tolist()
    assert len(rows) == odd_docs.count() and [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows)])[:-1].tolist()
    order = [r["id"] for r in rows]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    by_text = sorted(tuple([*ids(library, r["text"]), 2]) for r in odd_docs.collect())
    assert sorted(tuple(np.frombuffer(r["ids"], "<u4").tolist()) for r in rows) == by_text
    places = list(range(0, len(stream), 97)) + [len(stream) - 1]
    asked = spark.createDataFrame([(p,) for p in [*places, len(stream), -1, None]], "place long")
    assert {r["place"]: r["token"] for r in O.read_tokens(spark, out, asked).collect()} == {p: stream[p] for p in places}


def test_odd_and_empty_tables(spark, library, odd_docs, no_docs):
    got = token_counts(odd_docs, WORD)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    expected = sorted((str(r["doc_id"]), len(ids(library, r["text"]))) for r in odd_docs.collect())
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in got.collect()) == expected
    assert token_counts(no_docs, WORD).collect() == []
    out = scratch_path(spark, "tokens")
    O.write_tokens(no_docs, out, WORD, 2)
    assert O.read_documents(spark, out).collect() == []
