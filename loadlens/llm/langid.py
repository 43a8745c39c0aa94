"""Language identification by compression.

For each language a raw-content dictionary is cut from a bounded sample of its
labelled texts. A whole text, cut into pieces of ``PIECE`` bytes so that it cannot
serve as its own dictionary, is compressed with every dictionary by zstandard; the
language whose dictionary makes it smallest in sum wins. If the runner-up is hardly larger
the row is marked as rejected (its best language is still named).

Cases: a null text, or one without any letter, is ``und`` with score 0; so is every
text if nothing could be learnt. Equal sizes go to the language learnt from more
rows, then by name, with score 0.5 and rejected. Languages that are null teach
nothing. Repeated rows give the same result; an empty table gives no rows; only id
and text are read, so other columns may have any name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sampled rows of a language, longest text among them (code points), bytes of a dictionary.
SAMPLE_ROWS, SAMPLE_CHARS, DICT_BYTES = 400, 20_000, 1 << 16
#: Bytes compressed at once, and the level (high enough to search for short matches).
PIECE, LEVEL = 1024, 9
#: Saved bits that double the odds of the best language; least share of size between best and next.
BITS_PER_ODDS, NARROW = 8, 0.01
OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """The words alone, in lower case: case, digits and signs say nothing of the language."""
    return OTHER.sub(" ", text.lower()).strip().encode()


@dataclass(frozen=True)
class Model:
    """Dictionaries by language, in the order in which ties are decided."""
    dictionaries: tuple[tuple[str, bytes], ...] = ()


def learn(docs: DataFrame, wanted: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    """Dictionaries from at most ``SAMPLE_ROWS`` rows of each language for which ``wanted`` holds.

    The rows of least hash are taken; the driver gets the sampled texts only
    (about 1.3 MB of short texts for a language, 8 MB at most).
    """
    known = docs.where(wanted & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model()
    share = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, 1.5 * SAMPLE_ROWS / n)))])
    order = F.xxhash64("id", "text")
    unit = F.pmod(order, F.lit(1 << 20)) / F.lit(1 << 20)
    some = known.where((unit < share[F.col("lang")]) & (F.length("text") <= SAMPLE_CHARS) & F.col("text").rlike(r"\p{L}"))
    texts: dict[str, list[tuple[int, str]]] = {}
    for r in some.select("lang", order.alias("h"), "text").distinct().toLocalIterator():
        texts.setdefault(r["lang"], []).append((r["h"], r["text"]))
    made = []
    for lang in sorted(texts, key=lambda x: (-counts[x], x)):
        data, size = [], 0
        for _, text in sorted(texts[lang])[:SAMPLE_ROWS]:
            if size >= DICT_BYTES:
                break
            data.append(letters(text))
            size += len(data[-1]) + 1
        made.append((lang, b"\n".join(data)[:DICT_BYTES]))
    return Model(tuple(made))


def classifier(model: Model):
    """A function from a text to (language, score, margin)."""
    pairs = []
    for lang, data in model.dictionaries:
        words = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=LEVEL)
        pairs.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=words, write_checksum=False, write_content_size=False).compress))

    def best(text: str) -> tuple[str, float, float]:
        if not pairs or not any(map(str.isalpha, text)):
            return "und", 0.0, 0.0
        data = letters(text)
        parts = [data[at:at + PIECE] for at in range(0, len(data), PIECE)]
        sizes = sorted((sum(map(len, map(shrink, parts))), place) for place, (_, shrink) in enumerate(pairs))
        (least, place), gap = sizes[0], (sizes[1][0] - sizes[0][0] if len(sizes) > 1 else sizes[0][0])
        return pairs[place][0], 1 / (1 + math.exp(-min(700.0, 8 * gap * math.log(2) / BITS_PER_ODDS))), gap / (least + gap)

    return best


def languages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>, lang_pred, score, margin, rejected`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DICT_BYTES for each language

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = classifier(shared.value)
        for batch in batches:
            got = [best(t.as_py()) for t in batch.column(1)]
            yield pa.record_batch([
                batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                pa.array([g[2] for g in got], pa.float64()), pa.array([g[2] < NARROW for g in got], pa.bool_())],
                ["id", "lang_pred", "score", "margin", "rejected"])

    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    kind = plain.schema["id"].dataType.simpleString()
    return plain.mapInArrow(run, f"id {kind}, lang_pred string, score double, margin double, rejected boolean").withColumnRenamed("id", id_col)
