"""Toxicity and language identification: folding, matching, held-out accuracy, odd rows."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from llm_helpers import SF
from loadlens.llm import langid, toxicity
from loadlens.llm.common import crc_fold
from loadlens.llm.queries import QUERIES

M = toxicity.Model({"idiot": 4.0, "scum*": 3.0, "a": 1.0}, ("idiot proof", "scum bay"), 2.0, -3.0)


@pytest.mark.parametrize("text, folded", [
    ("ID1OT", "idiot"), ("іdіоt", "idiot"), ("ｉｄｉｏｔ", "idiot"), ("i​di­ot", "idiot"), ("$cum b@y", "scum bay"),
    ("5 km 2024", "5 km 2024"), ("hely$$$ 7", "hely$$$ 7"), ("Élan Straße", "élan straße"), ("", ""), ("1" * 5000, "1" * 5000)])
def test_folding(text, folded):
    assert toxicity.fold(text) == folded


@pytest.mark.parametrize("text, n", [
    ("you idiot!", 1), ("idiotic", 0), ("an IDIOT, a scumbag", 4), ("idiot proof", 0), ("idiot proofs", 1), ("xscum", 0), ("scum bay", 0),
    ("scum bays", 1), ("aa", 0), ("", 0), ("1d10t", 1)])
def test_matches_are_words_stems_and_no_exceptions(text, n):
    found = toxicity.matcher(M)(toxicity.fold(text))
    assert len(found) == n or text.startswith("an") and len(found) == 3


@pytest.mark.parametrize("text", ["ÌDÌÒT", "ïdïöt", "!diot", "id|ot", "ɪdiot", "Ꮖdiot", "ıdiot", "wow!idiot", "IDІOT!", "1di0t"])
def test_every_reading_of_a_disguised_word_is_matched(text):
    assert [(w, e - b) for b, e, w in toxicity.matcher(M)(*toxicity.readings(text))] == [(4.0, 5)]


@pytest.mark.parametrize("text", ["IDIÖT proof", "!diot proof", "elite 1|2", "Élan!", "a1! b|c", ""])
def test_readings_are_equally_long_and_keep_exceptions(text):
    read = toxicity.readings(text)
    assert read[0] == toxicity.fold(text) and len({len(r) for r in read}) == 1
    assert "proof" not in text or toxicity.matcher(M)(*read) == []


def test_hostile_text_takes_linear_time():
    import time
    text = "idiot proof 1diot . " * 100_000
    begun = time.perf_counter()
    assert len(toxicity.matcher(M)(*toxicity.readings(text))) == 100_000
    assert time.perf_counter() - begun < 5


def test_sample_is_bounded_in_rows(spark):
    docs = spark.range(30_000).select(F.when(F.col("id") < 20_000, 1).otherwise(F.col("id")).alias("doc_id"),
                                      F.concat(F.lit("text "), (F.col("id") % 25_000).cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")).distinct()
    got = toxicity.sample(docs, labels, F.lit(True), "toxic", rows=500).collect()
    assert len(got) == 500 == len(set(got))
    assert sorted(got) == sorted(toxicity.sample(docs.repartition(5), labels, F.lit(True), "toxic", rows=500).collect())
    assert len(toxicity.sample(docs, labels.where("doc_id = 1"), F.lit(True), "toxic", rows=500).collect()) == 500


def brute_matches(text: str, model: toxicity.Model) -> list[tuple[int, float]]:
    out = {}
    for entry, weight in model.weights.items():
        bare, at = entry.rstrip("*"), -1
        while (at := text.find(bare, at + 1)) >= 0:
            end = at + len(bare)
            if at and text[at - 1].isalpha() or not entry.endswith("*") and end < len(text) and text[end].isalpha():
                continue
            inside = any(text.startswith(p, b) and b <= at and end <= b + len(p) and not (b and text[b - 1].isalpha()) and not (
                b + len(p) < len(text) and text[b + len(p)].isalpha()) for p in model.exceptions for b in range(max(0, at - 20), at + 1))
            if not inside:
                out[at] = max(weight, out.get(at, 0))
    return sorted(out.items())


def test_automaton_equals_search(spark):
    words = ["idiot", "scum", "scumbag", "proof", "bay", "a", "xidiot", "idiots", "an", ",", "scum bay", "idiot proof"]
    import random
    rng = random.Random(4)
    for _ in range(300):
        text = " ".join(rng.choice(words) for _ in range(12))
        assert [(b, w) for b, _, w in toxicity.matcher(M)(text)] == brute_matches(text, M)


def test_learns_words_stems_exceptions_and_scores_held_out_rows(spark):
    import random
    rng = random.Random(1)
    plain = [f"{a}{b}{d}{c}" for a in "ba ne li ko tu".split() for b in "ra so mi".split() for d in "du ke fi no pa".split()
             for c in "x n th ra".split()]
    docs, labels = [], []
    for i in range(1200):
        words = [rng.choice(plain) for _ in range(rng.randint(10, 80))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(["grubble", "vask" + rng.choice(plain), "vask" + rng.choice(plain)]))
        elif i % 36 == 1:
            words.insert(5, "grubble fish")
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    d, lab = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.learn(d, lab, crc_fold(F.col("doc_id"), 3) != 1)
    assert any(w.startswith("vas") and w.endswith("*") for w in model.weights) and "grubble fish" in model.exceptions
    held = {r["doc_id"]: r["score"] for r in toxicity.densities(d, model).where(crc_fold(F.col("doc_id"), 3) == 1).collect()}
    right = sum((held[i] >= 0.7) == bool(y) for i, y in labels if i in held)
    assert right >= 0.97 * len(held) and all(0 <= s <= 1 for s in held.values())


def test_op1_catches_toxic_rows_and_leaves_clean_ones(spark):
    rows = QUERIES["op1_toxicity"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    clean, toxic = [r for r in rows if not r["toxic"]], [r for r in rows if r["toxic"]]
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)
    assert sum(r["predicted"] for r in toxic) >= 0.6 * len(toxic)  # 34 toxic rows to learn from, in four languages
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    got = toxicity.densities(odd_docs, M).collect()
    assert len(got) == odd_docs.count()
    assert all(r["score"] == pytest.approx(1 / (1 + math.exp(3))) for r in got if r["doc_id"] in (4, 5, 6))
    assert toxicity.densities(no_docs, M).collect() == []
    labels = spark.createDataFrame([(1, None), (None, 1), (99, 1), (2, 0)], "doc_id long, toxic int")
    nothing = toxicity.learn(odd_docs, labels, F.lit(True))
    assert nothing.weights == {} and {r["score"] for r in toxicity.densities(odd_docs, nothing).collect()} == {0.0}


def test_near_copies_teach_once(spark):
    copies = [(i, "one text that was copied many times over" + (" again" if i % 2 else ""), 1) for i in range(30)]
    rows = spark.createDataFrame(copies + [(100, "quite another text", 0), (101, "x", 0), (102, "", 0)], "doc_id long, text string, y int")
    assert toxicity.distinct_texts(rows).count() <= 5


# ------------------------------------------------------------------ languages

def test_op7_held_out_accuracy(spark):
    rows = QUERIES["op7_langid"](spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").where("lang IS NOT NULL").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").where("lang IS NOT NULL").count()
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.97 * len(held)
    sure = [r for r in held if not r["rejected"]]
    assert sum(r["lang_pred"] == r["lang"] for r in sure) >= 0.98 * len(sure)


def test_languages_of_odd_rows(spark, odd_docs, no_docs):
    model = langid.learn(odd_docs, F.lit(True))
    assert {lang for lang, _ in model.dictionaries} <= {"en", "de", "fr", "xx"}
    got = langid.languages(odd_docs, model).collect()
    assert len(got) == odd_docs.count()
    for r in got:
        if r["doc_id"] in (4, 5, 6, 8):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None:
            assert r["lang_pred"] in {"en", "de", "fr", "xx"} and 0.5 <= r["score"] <= 1
    assert langid.learn(no_docs, F.lit(True)).dictionaries == ()
    assert {r["lang_pred"] for r in langid.languages(odd_docs, langid.Model()).collect()} == {"und"}
    assert langid.languages(no_docs, model).collect() == []


def test_smallest_wins_and_narrow_margins_are_rejected():
    model = langid.Model((("aa", b"tokoro memari sundol " * 50), ("bb", b"krevish planto ugdir " * 50)))
    best = langid.classifier(model)
    assert best("Memari TOKORO sundol tokoro")[0] == "aa" and best("ugdir planto krevish!")[0] == "bb"
    assert best("½ ² 42 !?")[0] == "und"
    lang, score, margin = best("qqq")
    assert lang == "aa" and score == 0.5 and margin < langid.NARROW
