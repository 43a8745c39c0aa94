"""Toxicity by a weighted lexicon matched with an Aho-Corasick automaton.

Folding: compatibility forms, lower case, look-alike letters of other scripts to
Latin ones, invisible characters away, and digits or signs inside a word to the
letters they stand for. The automaton finds all lexicon entries in one pass over the
folded text; an entry is a whole word, or a stem (any word that begins with it).
A text with signs or letters of more than one reading (``1``, ``!`` or ``|`` as i or l,
letters with accents, look-alikes of Greek, Cherokee and small capitals) is matched in
each reading; readings are equally long, and what begins at one place counts once.
A match inside an exception phrase does not count. The weights found, over the
number of words, give a density, and a logistic curve turns it into a score.

Learning: on a bounded sample of labelled rows (``SAMPLE_ROWS``, those of least hash of the
id, then of the text; near copies of a text count once) every word and word stem is counted once per document in toxic and in clean rows.
Entries are those that toxic rows hold far more often than chance allows (binomial
tail, divided among all that were tried); the weight is the log odds, and an entry
that a kept stem covers is left out. Phrases of an entry and a neighbour word that
clean rows hold and toxic rows hardly do become exceptions. The curve is fitted on
the same sample, by Newton steps with a small ridge.

Cases: null, empty and wordless texts have density 0 and the score of a text without
matches; labels that are null or repeat (the largest counts) or belong to no row are
left out; without a toxic or a clean label nothing is learned and all scores are 0;
ties at the sample's border go to the smaller hash and id, rows of one id and text are
one row of the sample, and an id on many texts does not enlarge it; an empty table gives no
rows; only id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import stored

#: Most labelled rows to learn from.
SAMPLE_ROWS = 20_000
#: Lengths of stems that are tried; fewest toxic rows of an entry; most chance hits expected; least weight (log odds).
STEMS, LEAST_ROWS, CHANCE, LEAST_WEIGHT = range(4, 8), 3, 0.5, 1.5

#: Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans(
    "аеорсухіјѕԁһӏвкмнтαεορυχικντ", "aeopcyxijsdhlbkmhtaeopuxikvt")
INVISIBLE = re.compile("[\\u00ad\\u200b-\\u200f\\u2060\\ufeff\\u0300-\\u036f]")
#: Digits and signs inside a word, and the letters they stand for.
STANDS_FOR = str.maketrans("013457@$", "oieastas")
SUBSTITUTE = re.compile(r"[0-9]|[@$](?=[^\W\d_])")
TOKEN = re.compile(r"[\w@$]+")
LATIN = re.compile("[\\t-~\\u00a0-\\u00ac\\u00ae-\\u024f]*")
WORD = re.compile(r"[^\W\d_]+")
#: Further readings: of 1, ! and | as i or l, and of letters by look or by base letter.
READINGS = [str.maketrans("013457@$!|", f"o{one}eastas{one}{one}") for one in "il"]
READ_TOKEN = re.compile(r"(?<![\w@$!|])(?:[^\W1]|[@$])*+[1!|][\w@$!|]*+")
LOOKS = [dict(zip("ᎪᏴᏟᎠᎬᏀᎻᏆᎫᏦᏞᎷᏢᎡᏚᎢᏙᎳᏃ".lower(), "abcdeghijklmprstvwz", strict=True)) | dict(zip("βγζημτ", greek, strict=True))
         for greek in ("byzhmt", "byznut")]
NAMED = re.compile("LATIN (?:LETTER SMALL CAPITAL|SMALL LETTER(?: DOTLESS| SCRIPT| BARRED| OPEN)?) ([A-Z])(?: WITH .*)?")


def _base_letters() -> dict[str, str]:
    """Small Latin letters beyond ASCII and the plain letter that the character's name gives."""
    named = ((chr(c), NAMED.fullmatch(unicodedata.name(chr(c), ""))) for c in range(0x80, 0x2E80))
    return {c: m[1].lower() for c, m in named if m}


LETTERS = [str.maketrans(_base_letters() | looks) for looks in LOOKS]
GREEK = re.compile("[βγζημτ]")
READ_LETTER = re.compile(f"[{''.join(map(chr, LETTERS[0]))}]")


def readings(text: str) -> list[str]:
    """The folded text, then its other readings, each as long as the first."""
    plain = _plain(text)
    out = [_substituted(plain)]
    signs = READ_TOKEN.search(plain)
    letters = not plain.isascii() and READ_LETTER.search(plain)
    for stands, looks in zip(READINGS, LETTERS, strict=True):
        other = READ_LETTER.sub(lambda m, to=looks: to[ord(m[0])], plain) if letters else plain
        if signs:
            other = READ_TOKEN.sub(lambda m, t=stands: _letters(m, t, "@$!|"), other)
        if other == plain:
            break  # no sign stands in a word: both readings are the first
        other = _substituted(other)
        if other not in out:
            out.append(other)
        if not signs and not GREEK.search(plain):
            break  # both tables read these letters alike
    return out


def fold(text: str) -> str:
    """The text in the form in which lexicon entries are written."""
    return _substituted(_plain(text))


def _plain(text: str) -> str:
    if not LATIN.fullmatch(text):
        text = INVISIBLE.sub("", unicodedata.normalize("NFKC", text)).lower().translate(LOOKALIKES)
    else:
        text = text.lower()
    return text


def _substituted(text: str) -> str:
    return TOKEN.sub(_letters, text) if SUBSTITUTE.search(text) else text


def _letters(match: re.Match, stands: dict = STANDS_FOR, signs: str = "@$") -> str:
    """Digits and signs of a word that has letters too, but for signs at its end."""
    token = match[0]
    word = token.rstrip(signs)
    return word.translate(stands) + token[len(word):] if WORD.search(word) else token


@dataclass(frozen=True)
class Model:
    """Weighted entries (``word`` or ``stem*``), exception phrases, and the curve's two numbers."""
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    slope: float = 0.0
    base: float = -math.inf

    def score(self, density: float) -> float:
        x = self.base + self.slope * math.log1p(density)
        return 0.0 if x < -700 else 1 / (1 + math.exp(-x))


def matcher(model: Model) -> Callable[..., list[tuple[int, int, float]]]:
    """A function that finds (begin, end, weight) of all counting matches in a folded text.

    It takes the readings of one text. Of entries that begin at one place the heaviest counts.
    """
    machine = ahocorasick.Automaton()
    entries: dict[str, list] = {}
    for entry, weight in model.weights.items():
        entries.setdefault(entry.rstrip("*"), [None, None, False])[entry.endswith("*")] = weight
    for phrase in model.exceptions:
        entries.setdefault(phrase, [None, None, False])[2] = True
    for text, (word, stem, safe) in entries.items():
        machine.add_word(text, (len(text), word, stem, safe))
    machine.make_automaton()

    def find(*texts: str) -> list[tuple[int, int, float]]:
        hits: dict[int, tuple[int, float]] = {}
        safe_spans = []
        for text in texts:
            for last, (size, word, stem, safe) in machine.iter(text):
                begin, end = last - size + 1, last + 1
                if begin and text[begin - 1].isalpha():
                    continue
                whole = end == len(text) or not text[end].isalpha()
                weight = max((w for w, ok in ((word, whole), (stem, True)) if ok and w is not None), default=None)
                if safe and whole:
                    safe_spans.append((begin, end))
                if weight is not None:
                    if begin in hits:
                        end, weight = max(end, hits[begin][0]), max(weight, hits[begin][1])
                    hits[begin] = (end, weight)
        return _outside(sorted((begin, end, weight) for begin, (end, weight) in hits.items()), sorted(safe_spans))

    return find if entries else lambda *texts: []


def _outside(hits: list[tuple[int, int, float]], spans: list[tuple[int, int]]) -> list[tuple[int, int, float]]:
    """Hits that lie in no span; both lists in order, one pass: of the spans begun so far the farthest end tells."""
    out, at, reach = [], 0, -1
    for hit in hits:
        while at < len(spans) and spans[at][0] <= hit[0]:
            reach = max(reach, spans[at][1])
            at += 1
        if hit[1] > reach:
            out.append(hit)
    return out


def densities(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, n_words, n_matches, density, score`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most a few thousand entries

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = matcher(shared.value)
        for batch in batches:
            words, matches, dense, scores = [], [], [], []
            for cell in batch.column(1):
                text = cell.as_py()
                hits = find(*readings(text))
                n = len(text.split())
                d = 100 * sum(h[2] for h in hits) / (n + 20)
                words.append(n), matches.append(len(hits)), dense.append(d), scores.append(shared.value.score(d))
            yield pa.record_batch([batch.column(0), pa.array(words, pa.int64()), pa.array(matches, pa.int64()),
                                   pa.array(dense, pa.float64()), pa.array(scores, pa.float64())],
                                  ["id", "n_words", "n_matches", "density", "score"])

    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    kind = plain.schema["id"].dataType.simpleString()
    return plain.mapInArrow(run, f"id {kind}, n_words long, n_matches long, density double, score double").withColumnRenamed("id", id_col)


# ------------------------------------------------------------------ learning

def sample(docs: DataFrame, labels: DataFrame, wanted: Column, label_col: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, text, y`` of at most ``rows`` labelled rows."""
    known = labels.where(wanted & F.col("doc_id").isNotNull() & F.col(label_col).isNotNull()).groupBy("doc_id").agg(
        F.max(F.col(label_col)).cast("int").alias("y"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    labelled = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(some), "doc_id")  # bounded by ``rows``
    labelled = stored(labelled.withColumn("of_text", F.xxhash64("text")), "toxicity-labelled")
    kept = labelled.select("doc_id", "of_text").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "of_text").limit(rows)
    return labelled.join(F.broadcast(kept), ["doc_id", "of_text"]).groupBy("doc_id", "of_text", "y").agg(
        F.min("text").alias("text")).select("doc_id", "text", "y")


def distinct_texts(rows: DataFrame) -> DataFrame:
    """Of rows whose texts are near copies only the one of least id, so that a copied text counts once.

    Rows that agree in any of three minima of their word pairs' hashes count as copies.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
        for batch in batches:
            least = []
            for cell in batch.column(1):
                words = cell.as_py().lower().split()
                pairs = [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)] or [" ".join(words)]
                hashes = np.array([xxhash.xxh64_intdigest(p) for p in pairs], np.uint64)
                least.append((hashes[:, None] * odd).min(axis=0).view(np.int64))
            least = np.array(least, np.int64).reshape(-1, 3)
            yield pa.record_batch([*batch.columns, *(pa.array(least[:, i]) for i in range(3))], ["doc_id", "text", "y", "m0", "m1", "m2"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    out = rows.select("doc_id", "text", "y").mapInArrow(run, f"doc_id {kind}, text string, y int, m0 long, m1 long, m2 long")
    out = left = stored(out, "toxicity-minima")
    for m in ("m0", "m1", "m2"):  # as many rows as the sample has at most, so a common copy needs no shuffle of texts
        left = left.join(F.broadcast(out.groupBy(m).agg(F.min("doc_id").alias(f"first_{m}"))), m)
    return left.where("doc_id = first_m0 AND doc_id = first_m1 AND doc_id = first_m2").select("doc_id", "text", "y")


def _terms(text: str) -> set[str]:
    words = set(WORD.findall(fold(text)))
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) >= n}


def _counts(rows: DataFrame, terms: Callable[[str], Iterable[str]]) -> DataFrame:
    """``term, toxic, clean``: rows that hold the term, by label; added up in each task first."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (Counter(), Counter())
            for text, y in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found[y > 0].update(terms(text.as_py()))
            names = list(found[0].keys() | found[1].keys())
            yield pa.record_batch([pa.array(names, pa.string()), pa.array([found[1][t] for t in names], pa.int64()),
                                   pa.array([found[0][t] for t in names], pa.int64())], ["term", "toxic", "clean"])

    made = rows.select("text", "y").mapInArrow(run, "term string, toxic long, clean long")
    return made.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn(docs: DataFrame, labels: DataFrame, wanted: Column, label_col: str = "toxic", rows: int = SAMPLE_ROWS) -> Model:
    """A model from the labelled rows for which ``wanted`` holds."""
    some = stored(distinct_texts(sample(docs, labels, wanted, label_col, rows)), "toxicity-sample")
    sizes = some.agg(F.count_if(F.col("y") > 0).alias("t"), F.count_if(F.col("y") <= 0).alias("c")).first()
    nt, nc = sizes["t"], sizes["c"]
    if not nt or not nc:
        return Model()
    rate = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    tried = stored(_counts(some, _terms).where(F.col("toxic") >= LEAST_ROWS), "toxicity-terms")
    strong = tried.where(rate > F.lit(min(0.95, 0.5 + nt / (nt + nc) / 2)))  # few: clean rows hardly hold them
    n_tried = tried.count()
    found = {r["term"]: (r["toxic"], r["clean"]) for r in strong.collect()}

    def weight(term: str) -> float:
        t, c = found[term]
        return math.log((t + 0.5) / (nt + 1)) - math.log((c + 0.5) / (nc + 1))

    weights: dict[str, float] = {}
    for term in sorted(found, key=lambda x: (len(x), x)):
        if weight(term) >= LEAST_WEIGHT and _tail(*found[term], nt / (nt + nc)) * n_tried <= CHANCE and not any(
                term.rstrip("*")[:n] + "*" in weights for n in STEMS):
            weights[term] = weight(term)
    # a stem that only repeats one whole word adds nothing but false hits
    for stem in [w for w in weights if w.endswith("*")]:
        inside = [w for w in found if not w.endswith("*") and w.startswith(stem[:-1]) and found[w][0] >= 0.9 * found[stem][0]]
        if inside:
            word = max(inside, key=lambda w: (found[w][0], w))
            del weights[stem]
            weights[word] = weight(word)
    model = Model(weights, _exceptions(some, weights))
    return _fit(some, model)


def _tail(t: int, c: int, p: float) -> float:
    """Chance of at least t toxic rows among t + c, bounded from above (Chernoff)."""
    a = t / (t + c)
    if a <= p:
        return 1.0
    d = a * math.log(a / p) + ((1 - a) * math.log((1 - a) / (1 - p)) if a < 1 else 0.0)
    return math.exp(-(t + c) * d)


def _exceptions(some: DataFrame, weights: dict[str, float]) -> tuple[str, ...]:
    """Phrases of a matched word and one neighbour that clean rows hold, toxic rows hardly ever."""
    bare = Model(weights)

    def phrases(text: str) -> set[str]:
        folded, out = fold(text), set()
        for begin, end, _ in matches(folded):
            right = re.compile(r"[^\W\d_]*\s+[^\W\d_]+").match(folded, end)
            left = re.search(r"[^\W\d_]+\s+$", folded[max(0, begin - 40):begin])
            stop = re.compile(r"[^\W\d_]*").match(folded, end).end()
            if right:
                out.add(folded[begin:right.end()])
            if left:
                out.add(left[0] + folded[begin:stop])
        return out

    matches = _lazy(bare)
    found = _counts(some, phrases).where((F.col("clean") >= 5) & (F.col("clean") > 20 * F.col("toxic")))
    return tuple(sorted(r["term"] for r in found.collect()))


def _lazy(model: Model) -> Callable[[str], list]:
    """A matcher that is built in the worker, once."""
    made: list = []

    def find(text: str) -> list:
        if not made:
            made.append(matcher(model))
        return made[0](text)
    return find


def _fit(some: DataFrame, model: Model, ridge: float = 1e-6, steps: int = 200) -> Model:
    """Logistic curve over log density on the sample (two numbers for each sampled row)."""
    labelled = some.select(F.struct("doc_id", "y").alias("pair"), "text")
    got = densities(labelled, model, "pair").select("pair.y", "density").toPandas()
    x, y = np.log1p(got["density"].to_numpy()), (got["y"].to_numpy() > 0).astype(float)
    a = np.stack([np.ones(len(x)), x], axis=1)
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-a @ w))
        slope = a.T @ (p - y) / len(y) + ridge * w
        bend = (a * (p * (1 - p))[:, None]).T @ a / len(y) + ridge * np.eye(2)
        step = np.clip(np.linalg.solve(bend, slope), -1, 1)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return Model(model.weights, model.exceptions, float(w[1]), float(w[0]))
