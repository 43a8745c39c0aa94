"""Spelling variants by Bloom-guided neighbourhoods.

The words of a vocabulary go into Bloom filters, one for each word length, cut into
blocks of 64 bits (a key sets its bits in one block). A task makes the edits of its
words, hashes them without building them, and asks the filter of the edit's length;
only edits that a filter knows become strings and are shuffled to an exact join with
the vocabulary, which removes the filter's errors.

Being near is symmetric, so a pair is made once: a deletion by the longer word (at the
last of equal neighbouring letters), a replacement by the word with the smaller letter.

Filters are built in pages by tasks. One pass broadcasts filters of at most
``PASS_BYTES``; a larger vocabulary takes more passes (a filter larger than that is cut
by block ranges), so a broadcast never grows with the data and no word is left out.

Cases: null and empty texts have no words; a null id counts as an empty string in the
occurrence hash; repeated rows count again; equal counts go to the word first in
code-point order; an empty table, or one without frequent words, gives no rows; other
columns are not read. Words have any length: edits are made in pieces of ``EDITS``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import shuffle_width, stored

#: Letters of a run, and those of them that are lower-cased.
LETTERS = r"A-Za-zÀ-ÿ"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bits of a filter for each word; bits that a word sets in its block; lengths from here on share a filter.
BITS_A_WORD, BITS_SET, LONG = 24, 4, 64
#: Bytes of the filters that one pass broadcasts; blocks of 64 bits in a page; edits hashed at once.
PASS_BYTES, PAGE, EDITS = 32 << 20, 4096, 1 << 20
FACTOR_1, FACTOR_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


# ---------------------------------------------------------------- vocabulary

def word_occurrences(docs: DataFrame, least_length: int, noise: int = 97, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` of every run of letters that can reach ``least_length``, capitals A-Z lowered.

    If ``noise`` divides the crc32 of ``<id>:<run>`` (unsigned), the run loses the
    code point at that number modulo its length.
    """
    run = F.regexp_extract_all(F.col("t"), F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("t")).select(
        "id", F.explode(run).alias("run")).select("id", F.translate("run", CAPITALS, CAPITALS.lower()).alias("run"))
    marked = found.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return marked.select(F.when(F.col("h") % noise == 0, cut).otherwise(F.col("run")).alias("word")).where(
        F.length("word") >= least_length)


def frequent_words(occurrences: DataFrame, least_count: int) -> DataFrame:
    """``word, n`` of the words that occur ``least_count`` times or more."""
    return occurrences.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


# ---------------------------------------------------------------- hashes and filters

def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value for each of the numbers."""
    x = (x ^ (x >> np.uint64(30))) * FACTOR_1
    x = (x ^ (x >> np.uint64(27))) * FACTOR_2
    return x ^ (x >> np.uint64(31))


def term(place: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """What a letter at a place adds to the hash of a word."""
    return mixed((place.astype(np.uint64) << np.uint64(21)) + letter.astype(np.uint64) + np.uint64(1))


def letters(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)


def block_and_bits(total: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The block of each word hash and the bits it sets there. ``n_blocks`` is a power of two."""
    h = mixed(total)
    bits = np.zeros(len(h), np.uint64)
    for k in range(BITS_SET):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
    return (h >> np.uint64(6 * BITS_SET)) & np.uint64(n_blocks - 1), bits


def shard_of(length: int) -> int:
    return min(length, LONG)


def filter_sizes(words: DataFrame) -> dict[int, int]:
    """Blocks of the filter of each shard: a power of two for its number of words (a row for each of ``LONG`` lengths)."""
    rows = words.groupBy(F.least(F.length("word"), F.lit(LONG)).alias("shard")).count().collect()
    return {r["shard"]: 1 << max(0, (r["count"] * BITS_A_WORD // 64).bit_length()) for r in rows}


def by_length(words: list[str]) -> Iterator[tuple[int, list[int]]]:
    """Lengths of the words, with the places of the words of that length."""
    places: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        places.setdefault(len(w), []).append(i)
    yield from places.items()


def filter_pages(words: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """``shard, page, bits``: the filters, in pages of ``PAGE`` blocks."""
    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            strings = batch.column(0).to_pylist()
            for length, places in by_length(strings):
                shard = shard_of(length)
                grid = letters([strings[i] for i in places])
                total = term(np.arange(length)[None, :], grid).sum(axis=1, dtype=np.uint64)
                block, bits = block_and_bits(total, sizes[shard])
                yield pa.record_batch([
                    pa.array(np.full(len(places), shard, np.int32)), pa.array((block // PAGE).astype(np.int32)),
                    pa.array((block % PAGE).astype(np.int32)), pa.array(bits.view(np.int64))], ["shard", "page", "block", "bits"])

    def page(key: tuple, rows: pa.Table) -> pa.Table:
        out = np.zeros(min(PAGE, sizes[key[0].as_py()]), np.uint64)
        np.bitwise_or.at(out, rows.column("block").to_numpy(), rows.column("bits").to_numpy().view(np.uint64))
        return pa.table({"shard": [key[0]], "page": [key[1]], "bits": pa.array([out.tobytes()], pa.binary())})

    keys = words.select("word").mapInArrow(hashed, "shard int, page int, block int, bits long")
    return keys.groupBy("shard", "page").applyInArrow(page, "shard int, page int, bits binary")


def passes(sizes: dict[int, int], limit: int | None = None) -> list[dict[int, tuple[int, int]]]:
    """Block ranges ``{shard: (from, to)}`` of each pass, of at most ``limit`` bytes together."""
    room, out = max(1, (limit or PASS_BYTES) // 8), [{}]
    free = room
    for shard, n_blocks in sorted(sizes.items()):
        at = 0
        while at < n_blocks:
            if not free or shard in out[-1]:
                out.append({})
                free = room
            end = min(n_blocks, at + free)
            if end < n_blocks:  # ranges begin and end at pages
                end = max(end // PAGE * PAGE, at)
            if end == at:
                if free == room:
                    end = min(n_blocks, at + PAGE)  # one page at least
                else:
                    free = 0
                    continue
            out[-1][shard] = (at, end)
            free, at = max(0, free - (end - at)), end
    return [p for p in out if p]


def load_filters(pages: DataFrame, ranges: dict[int, tuple[int, int]]) -> dict[int, np.ndarray]:
    """The blocks of a pass on the driver, at most ``PASS_BYTES``."""
    filters = {shard: np.zeros(end - begin, np.uint64) for shard, (begin, end) in ranges.items()}
    wanted = " OR ".join(f"(shard = {s} AND page >= {a // PAGE} AND page < {-(-b // PAGE)})" for s, (a, b) in ranges.items())
    for row in pages.where(wanted).toLocalIterator():
        blocks = np.frombuffer(row["bits"], np.uint64)
        at = row["page"] * PAGE - ranges[row["shard"]][0]
        filters[row["shard"]][at:at + len(blocks)] = blocks
    return filters


# ---------------------------------------------------------------- edits

class Probe:
    """Asks the filters of one pass for the edits of words."""

    def __init__(self, filters: dict[int, np.ndarray], ranges: dict[int, tuple[int, int]], sizes: dict[int, int], alphabet: list[int]):
        self.filters, self.ranges, self.sizes = filters, ranges, sizes
        self.alphabet = np.array(sorted(alphabet), np.uint32)

    def known(self, shard: int, total: np.ndarray) -> np.ndarray:
        """Which of the hashes the shard's filter knows."""
        begin, end = self.ranges[shard]
        block, bits = block_and_bits(total, self.sizes[shard])
        inside = (block >= begin) & (block < end)
        found = np.zeros(len(total), bool)
        blocks = self.filters[shard][(block[inside] - np.uint64(begin)).astype(np.int64)]
        found[inside] = (blocks & bits[inside]) == bits[inside]
        return found

    def replaced(self, grid: np.ndarray, own: np.ndarray, total: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Word, place and letter of the replacements by a larger letter that may be words."""
        length, shard = grid.shape[1], shard_of(grid.shape[1])
        step = max(1, EDITS // (len(grid) * len(self.alphabet)))
        for at in range(0, length, step):
            place = np.arange(at, min(at + step, length))
            new = term(place[:, None], self.alphabet[None, :])
            word, where, letter = np.nonzero(self.alphabet[None, None, :] > grid[:, place, None])
            hit = np.flatnonzero(self.known(shard, total[word] - own[word, place[where]] + new[where, letter]))
            yield word[hit], place[where[hit]], self.alphabet[letter[hit]]

    def deleted(self, grid: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word and place of the deletions that may be words."""
        length, shard = grid.shape[1], shard_of(grid.shape[1] - 1)
        moved = term(np.arange(-1, length - 1).clip(0)[None, :], grid)
        before = np.cumsum(own, axis=1, dtype=np.uint64) - own
        behind = moved.sum(axis=1, dtype=np.uint64)[:, None] - np.cumsum(moved, axis=1, dtype=np.uint64)
        last = np.ones(grid.shape, bool)
        last[:, :-1] = grid[:, 1:] != grid[:, :-1]
        word, place = np.nonzero(last)
        hit = np.flatnonzero(self.known(shard, (before + behind)[word, place]))
        return word[hit], place[hit]

    def edits(self, words: list[str]) -> Iterator[tuple[int, str]]:
        """Number of a word and an edit of it that a filter knows."""
        for length, places in by_length(words):
            for at in range(0, len(places), step := max(1, EDITS // (length * max(1, len(self.alphabet))))):
                some = places[at:at + step]
                grid = letters([words[i] for i in some])
                own = term(np.arange(length)[None, :], grid)
                if shard_of(length) in self.filters:
                    for word, place, letter in self.replaced(grid, own, own.sum(axis=1, dtype=np.uint64)):
                        for w, p, c in zip(word.tolist(), place.tolist(), letter.tolist(), strict=True):
                            text = words[some[w]]
                            yield some[w], text[:p] + chr(c) + text[p + 1:]
                if length > 1 and shard_of(length - 1) in self.filters:
                    word, place = self.deleted(grid, own)
                    for w, p in zip(word.tolist(), place.tolist(), strict=True):
                        text = words[some[w]]
                        yield some[w], text[:p] + text[p + 1:]


def possible_pairs(words: DataFrame, limit: int | None = None) -> DataFrame:
    """``word, n, near``: every near pair once, with the filters' errors."""
    spark = words.sparkSession
    sizes = filter_sizes(words)
    alphabet = [ord(r[0]) for r in words.select(F.explode(F.split("word", ""))).distinct().collect() if r[0]]
    pages = stored(filter_pages(words, sizes), "filter-pages")
    spread = stored(words.repartition(shuffle_width(spark), "word"), "spread-words")
    out = []
    for ranges in passes(sizes, limit):
        sent = spark.sparkContext.broadcast(load_filters(pages, ranges))

        def run(batches: Iterable[pa.RecordBatch], sent=sent, ranges=ranges) -> Iterator[pa.RecordBatch]:
            probe = Probe(sent.value, ranges, sizes, alphabet)
            for batch in batches:
                strings = batch.column(0).to_pylist()
                number, near = [], []
                for i, edit in probe.edits(strings):
                    number.append(i)
                    near.append(edit)
                yield pa.record_batch([*(batch.column(c).take(pa.array(number, pa.int32())) for c in (0, 1)),
                                       pa.array(near, pa.string())], ["word", "n", "near"])

        # written before the filters go, so that a lost task can still run again
        out.append(stored(spread.select("word", "n").mapInArrow(run, "word string, n long, near string"), "possible-pairs"))
        sent.unpersist()
    empty = spark.createDataFrame([], "word string, n long, near string")
    for part in out:
        empty = empty.unionByName(part)
    return empty


def near_words(words: DataFrame, limit: int | None = None) -> DataFrame:
    """``word, near, near_n``: both directions of every pair that differs by one code point."""
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = possible_pairs(words, limit).join(known, "near")
    both = F.array(F.struct("word", "near", "near_n"),
                   F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    return pairs.select(F.explode(both).alias("p")).select("p.*")


# ---------------------------------------------------------------- groups

def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of a table ``word, form`` whose steps never return: each round doubles the steps taken."""
    table = stored(forms.select("word", F.col("form").alias("root"), F.lit(False).alias("done")), "roots")
    while not table.where("NOT done").isEmpty():
        ahead = table.select(F.col("word").alias("root"), F.col("root").alias("next"), F.col("done").alias("next_done"))
        table = stored(table.where("done").unionByName(
            table.where("NOT done").join(ahead, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.coalesce("next_done", F.lit(True)).alias("done"))), "roots")
    return table.select("word", "root")


def spelling_variants(words: DataFrame, factor: int = 2, limit: int | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a vocabulary ``word, n`` of distinct words.

    A word's form is its near word of largest count (the first in code-point order of
    several), if that count is ``factor`` times the word's or more.
    """
    best = near_words(words, limit).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    formed = -F.col("best.m") >= factor * F.col("n")
    judged = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.m")).alias("form_n")), "variants")
    found = roots(judged.where("form IS NOT NULL"))
    return judged.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def text_variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, noise: int = 97) -> DataFrame:
    """The spelling variants among the frequent words of all texts."""
    words = stored(frequent_words(word_occurrences(docs, least_length, noise), least_count), "vocabulary")
    return spelling_variants(words)
