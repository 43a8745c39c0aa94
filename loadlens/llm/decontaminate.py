"""Benchmark decontamination by template canonicalisation.

Texts become templates: words in lower case without the signs around them, numbers
as ``<num>``, capitalised words inside a sentence as ``<name>``, unit words after a
number as ``<unit>``. Windows of ``WINDOW`` template words are hashed. A document is
contaminated by an item if it holds at least ``SHARE`` of the item's windows with
slots that fit: within one alignment every value of the item (its names, numbers, units)
stands for the value of the document that most windows set against it, and windows with
another one do not count. So a question with other
names and numbers is found, and a text that only shares its template words is not.
Capitals tell names only in sentences that have lower-case words too. Beside these
typed windows there are literal ones, of the words themselves without regard to case:
a document that holds at least ``SHARE`` of an item's literal windows is contaminated
whatever its slots, so a copy in capitals or in lower case is found (its row then counts
literal windows).

Join: an item with n windows that may miss a fifth of them is sure to share one of
any fifth of its windows plus one; that many of its rarest windows are its anchors.
Documents pass two Bloom filters of fixed size (anchors, all windows) in the scan;
what passes the first is hash-joined with the anchors exactly, and only the pairs
found are checked window by window. Nothing else of a document is shuffled.

Cases: null and empty texts have no windows; scripts without spaces are split by
character; an item of fewer than ``WINDOW`` words is one typed window of all its words,
and only a document of exactly those words has it, and, from ``ROLLED`` words on, one literal
window of its length that is rolled over the documents; an item of fewer words is found in
no longer document; typed windows with fewer than ``LITERALS`` words that are not placeholders say
nothing and are left out (such items are found by their literal windows); items with fewer
than ``LITERALS`` words that are not numbers have no literal windows; items without text are left out,
items without id are returned as null, repeated item ids are checked each; repeated document rows give their pair once;
without items, or on an empty table, there are no rows; a null doc_id is returned as
such; only ids and texts are read, so other columns may have any name.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import stored
from loadlens.llm.texts import SPACES, byte_list, coded, cut_by_bytes, flat, runs, spans

WINDOW, SHARE, LITERALS = 5, 0.8, 2
#: Words of the shortest item that is looked for inside longer documents.
ROLLED = 3
#: Bits of each Bloom filter (2 MB), tested at three places.
BLOOM_BITS = 1 << 24

NUMBER = re.compile(r"[$€£]?[+-]?\d+(?:[.,:/]\d+)*%?")
MEASURED = re.compile(r"[$€£]?[+-]?\d+(?:[.,:/]\d+)*([^\W\d_]{1,3})")
HEAD, TAIL = re.compile(r"[\w$€£%+-]"), re.compile(r"[\w%]")
UNITS = frozenset("""
    mm cm dm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz ounce ounces pound pounds
    ton tons ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours
    day days week weeks month months year years c f k degree degrees percent w kw mw v a hz khz mhz ghz b kb mb gb tb
    meter meters metre metres gram grams kilogram kilograms cent cents dollar dollars euro euros usd eur mph kmh
    kilometer kilometers kilometre kilometres stunde stunden tag tage jahr jahre heure heures jour jours hora horas
    """.split())
#: Thai, Lao, Burmese, Khmer, kana and Han.
SPACELESS = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff"
                       "\uf900-\ufaff\uff66-\uff9d\U00020000-\U0003ffff]")
#: Signs that may follow a word at once; below this character no script goes without spaces.
SIGNS, FIRST_SPACELESS = frozenset(".,;:!?"), "\u0e00"
CAPITAL, LOWER, STOP, IS_NUMBER, IS_MEASURED, IS_UNIT, IS_SPACELESS, FLAGS = 1, 2, 4, 8, 16, 32, 64, 127
NAME, NUM, MEASURE, UNIT = (np.uint64(xxhash.xxh64_intdigest(x) & ~FLAGS) for x in ("<name>", "<num>", "<num><unit>", "<unit>"))
#: Tells literal windows from typed ones of the same words.
LITERAL = np.uint64(0xA0761D6478BD642F)
TYPED_KIND, LITERAL_KIND = 0, 1
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def bare(text: str) -> str:
    """A part without the signs around its word (in time that grows with its length only)."""
    first = HEAD.search(text)
    if not first:
        return ""
    end = len(text)
    while end > first.start() and not TAIL.match(text, end - 1):
        end -= 1
    return text[first.start():end]


def _code(part: bytes) -> int:
    """Hash of a part's word without regard to case (upper 57 bits) and what it is (lower 7); 0 if it has no word."""
    text = part.decode()
    word = text[:-1] if text[-1] in SIGNS else text
    if word.isalpha() and (word.isascii() or max(word) < FIRST_SPACELESS):  # most parts: nothing but a word and a sign
        flags = STOP if text[-1] in ".!?:;" else 0
        flags |= CAPITAL if word[0].isupper() else LOWER if word[0].islower() else 0
        folded = word.casefold()
        return (xxhash.xxh64_intdigest(folded) & ~FLAGS) | flags | (IS_UNIT if word.lower() in UNITS else 0)
    if len(text) > 1 and SPACELESS.search(text):
        return IS_SPACELESS  # for _split
    word = bare(text)
    if not word:
        return 0
    flags = STOP if text[-1] in ".!?:;" or text[-2:-1] in (".", "!", "?") else 0
    measured = MEASURED.fullmatch(word)
    if NUMBER.fullmatch(word):
        flags |= IS_NUMBER
    elif measured and measured[1].lower() in UNITS:
        flags |= IS_MEASURED
    else:
        flags |= IS_UNIT if word.lower() in UNITS else 0
        flags |= CAPITAL if word[0].isupper() else LOWER if word[0].islower() else 0
    return (xxhash.xxh64_intdigest(word.casefold()) & ~FLAGS) | flags


def _split(parts: list[bytes]) -> list[bytes]:
    """Parts with each character of a script without spaces on its own."""
    return [x.encode() for part in parts for x in SPACELESS.sub(r" \g<0> ", part.decode()).split()]


def _codes(parts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_code, parts), np.uint64, len(parts))


def _rolled(code: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` words."""
    n = len(code) - length + 1
    spread, hashes = code ^ (code >> np.uint64(29)), np.zeros(max(n, 0), np.uint64)
    for i in range(length if n > 0 else 0):
        hashes += spread[i:i + n] * MULTIPLIERS[i]
    return hashes ^ (hashes >> np.uint64(31))


class Templates:
    """Windows of texts."""

    @staticmethod
    def codes(column: pa.Array) -> list[np.ndarray]:
        """The code of every part of each text; a distinct part of the column is judged once."""
        data, offsets = flat(column)
        starts, ends, owner = runs(~SPACES[data], offsets)
        which, distinct = coded(spans(data, starts, ends))
        found = _codes(byte_list(distinct))[which]
        upto = np.searchsorted(owner, np.arange(len(column)), "right").tolist()
        return [found[a:b] for a, b in zip([0, *upto], upto, strict=False)]

    @staticmethod
    def worded(data: bytes, found: np.ndarray) -> list[bytes]:
        """The parts that have a word, spaceless scripts by character (as ``windows`` counts them)."""
        parts = data.split()
        if (found == IS_SPACELESS).any():
            parts = _split(parts)
            found = _codes(parts)
        return parts if found.all() else [parts[i] for i in np.flatnonzero(found)]

    @staticmethod
    def windows(data: bytes, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hashes and places of the telling typed windows, which words are slots, and the words' codes."""
        if (found == IS_SPACELESS).any():
            found = _codes(_split(data.split()))
        found = found[found > 0]
        if not len(found):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool), found
        flags = (found & np.uint64(FLAGS)).astype(np.uint8)
        plain = found & ~np.uint64(FLAGS)
        measured = (flags & IS_MEASURED) > 0
        number = measured | ((flags & IS_NUMBER) > 0)
        after_stop, after_number = np.ones(len(found), bool), np.zeros(len(found), bool)
        after_stop[1:], after_number[1:] = (flags[:-1] & STOP) > 0, number[:-1]
        sentence = np.cumsum(after_stop) - 1
        mixed = (np.bincount(sentence, (flags & LOWER) > 0) > 0)[sentence]
        unit = ((flags & IS_UNIT) > 0) & after_number
        name = ((flags & CAPITAL) > 0) & ~after_stop & ~unit & mixed
        code = np.where(measured, MEASURE, np.where(number, NUM, np.where(unit, UNIT, np.where(name, NAME, plain))))
        slots = number | unit | name
        if len(code) < WINDOW:  # one window of all words, told from others by its length
            one = (code * MULTIPLIERS[:len(code)]).sum(dtype=np.uint64) ^ np.uint64(len(code))
            hashes, literals = np.array([one ^ (one >> np.uint64(31))], np.uint64), np.array([(~slots).sum()])
        else:
            hashes = _rolled(code, WINDOW)
            runs = np.concatenate([[0], np.cumsum(~slots)])
            literals = runs[WINDOW:] - runs[:len(hashes)]
        places = np.flatnonzero(literals >= min(LITERALS, len(code)))
        return hashes[places], places, slots, found

    @staticmethod
    def literal(codes: np.ndarray, length: int = WINDOW) -> np.ndarray:
        """Hashes of the literal windows of a length; values are kept, so each of them tells."""
        return _rolled((codes & ~np.uint64(FLAGS)) ^ LITERAL, length)


def _item_literals(codes: np.ndarray) -> np.ndarray:
    """The literal windows of an item; none if it has too few words, or too few that are not numbers."""
    worded = ((codes & np.uint64(IS_NUMBER | IS_MEASURED)) == 0).sum()
    if len(codes) < ROLLED or worded < LITERALS:
        return np.zeros(0, np.uint64)
    return Templates.literal(codes, min(WINDOW, len(codes)))


def _slot_values(places: np.ndarray, slots: np.ndarray, parts: list[bytes]) -> list[list[str]]:
    """For each window the values of its slots as ``offset=value``."""
    out = []
    for at in places.tolist():
        out.append([f"{i}={bare(parts[at + i].decode())}" for i in range(min(WINDOW, len(parts) - at)) if slots[at + i]])
    return out


def item_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, item_row, kind, n_windows, w, at, values, length`` for every telling window of every item, typed or literal.

    ``length`` is the number of words of a literal window.

    ``item_row`` is xxhash64 of id and text, so that items of no or of one id stay apart.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Templates
        for batch in batches:
            rows = []
            for item, key, cell, found in zip(*(batch.column(i).to_pylist() for i in range(3)), made.codes(batch.column(2)), strict=True):
                hashes, places, slots, codes = made.windows(cell, found)
                parts = made.worded(cell, found)
                literal = _item_literals(codes)
                one = {"item_id": item, "item_row": key}
                rows += [one | {"kind": TYPED_KIND, "n_windows": len(places), "w": w, "at": at, "values": v, "length": WINDOW} for w, at, v in
                         zip(hashes.view(np.int64).tolist(), places.tolist(), _slot_values(places, slots, parts), strict=True)]
                rows += [one | {"kind": LITERAL_KIND, "n_windows": len(literal), "w": w, "at": at, "values": [], "length": min(WINDOW, len(codes))}
                         for at, w in enumerate(literal.view(np.int64).tolist())]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("item_id", pa.int64()), ("item_row", pa.int64()), ("kind", pa.int32()), ("n_windows", pa.int32()), ("w", pa.int64()),
                ("at", pa.int32()), ("values", pa.list_(pa.string())), ("length", pa.int32())]))

    plain = items.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).cast("binary").alias("t"))
    return plain.mapInArrow(run, "item_id long, item_row long, kind int, n_windows int, w long, at int, values array<string>, length int")


def _bloom(hashes: DataFrame) -> bytes:
    """A Bloom filter of fixed size over column ``w``: at most BLOOM_BITS / 64 words reach the driver."""
    places = hashes.select(F.explode(F.array(*[_place(i) for i in range(3)])).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits")).collect()
    table = np.zeros(BLOOM_BITS // 64, np.int64)
    if words:
        table[[r["word"] for r in words]] = [r["bits"] for r in words]
    return table.tobytes()


def _place(i: int):
    return F.shiftrightunsigned("w", 20 * i).bitwiseAND(F.lit(BLOOM_BITS - 1))


def _passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = np.arange(len(hashes))
    for i in range(3):  # few are left after the first test
        p = (hashes[at] >> np.uint64(20 * i)) & np.uint64(BLOOM_BITS - 1)
        at = at[(table[(p >> np.uint64(6)).astype(np.int64)] >> (p & np.uint64(63))) & np.uint64(1) > 0]
    ok = np.zeros(len(hashes), bool)
    ok[at] = True
    return ok


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document and item it holds:
    ``row_key, <id_col>, item_id, n_windows, n_found, containment, new_values``.

    ``new_values`` says that at least one slot has another value than in the item;
    the counts are of typed windows, or of literal ones where the typed ones do not reach ``SHARE``;
    ``row_key`` is xxhash64 of id and text.
    """
    spark = docs.sparkSession
    windows = stored(item_windows(items), "benchmark-windows")
    spread = windows.groupBy("w").agg(F.count(F.lit(1)).alias("common"))
    ranked = windows.join(spread, "w").groupBy("item_row", "kind", "n_windows").agg(
        F.array_sort(F.collect_set(F.struct("common", "w"))).alias("ws"))  # the windows of one kind of one item
    missed = F.floor(F.col("n_windows") * F.lit(1 - SHARE) + F.lit(1e-9)).cast("int")
    anchors = stored(ranked.select("item_row", F.explode(F.slice("ws", F.lit(1), missed + 1)).alias("x")).select(
        "item_row", F.col("x.w").alias("w")), "benchmark-anchors")
    first, every = (spark.sparkContext.broadcast(_bloom(x.select("w").distinct())) for x in (anchors, windows))

    short = sorted(r["length"] for r in windows.where(F.col("length") < WINDOW).select("length").distinct().collect())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Templates

        def texts(batch: pa.RecordBatch) -> Iterator[tuple]:
            for piece in cut_by_bytes(batch, 1, 8 << 20):
                yield from zip(piece.column(0).to_pylist(), piece.column(1), made.codes(piece.column(1)), strict=True)

        lead, any_ = np.frombuffer(first.value, np.uint64), np.frombuffer(every.value, np.uint64)
        for batch in batches:
            rows = []
            for key, cell, found in texts(batch):
                hashes, places, slots, codes = made.windows(cell.as_py(), found)
                both = np.concatenate([hashes, made.literal(codes), *(made.literal(codes, n) for n in short)])
                lead_hits = both[_passes(lead, both)]
                if len(lead_hits):
                    near = _passes(any_, hashes)
                    at, literal, parts = places[near], np.unique(both[len(hashes):]), made.worded(cell.as_py(), found)
                    rows.append({"row_key": key, "leads": np.unique(lead_hits).view(np.int64).tolist(),
                                 "ws": hashes[near].view(np.int64).tolist(), "ats": at.tolist(), "values": _slot_values(at, slots, parts),
                                 "literal": literal[_passes(any_, literal)].view(np.int64).tolist()})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("row_key", pa.int64()), ("leads", pa.list_(pa.int64())), ("ws", pa.list_(pa.int64())), ("ats", pa.list_(pa.int64())),
                ("values", pa.list_(pa.list_(pa.string()))), ("literal", pa.list_(pa.int64()))]))

    keyed = docs.select(F.xxhash64(id_col, text_col).alias("row_key"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    hits = stored(keyed.mapInArrow(run, "row_key long, leads array<long>, ws array<long>, ats array<long>, values array<array<string>>, "
                                    "literal array<long>")
                  .dropDuplicates(["row_key"]), "benchmark-hits")
    pairs = hits.select("row_key", F.explode("leads").alias("w")).join(anchors, "w").select("row_key", "item_row").distinct()
    whole = windows.groupBy("item_row").agg(
        F.first("item_id").alias("item_id"), F.collect_set(F.struct("kind", "w", "at", "values")).alias("item"))  # one item's windows
    both = pairs.join(hits.drop("leads"), "row_key").join(whole, "item_row")

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                typed = [(x["w"], x["at"], x["values"]) for x in r["item"] if x["kind"] == TYPED_KIND]
                found, new = aligned(typed, list(zip(r["ws"], r["ats"], r["values"], strict=True)))
                n = len(typed)
                if not typed or found < SHARE * n - 1e-9:
                    held = set(r["literal"])
                    literal = [x["w"] in held for x in r["item"] if x["kind"] == LITERAL_KIND]
                    found, n = sum(literal), len(literal)
                if n and found >= SHARE * n - 1e-9:
                    rows.append({"row_key": r["row_key"], "item_id": r["item_id"], "n_windows": n, "n_found": found,
                                 "containment": found / n, "new_values": new})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([
                ("row_key", pa.int64()), ("item_id", pa.int64()), ("n_windows", pa.int32()), ("n_found", pa.int32()),
                ("containment", pa.float64()), ("new_values", pa.bool_())]))

    sure = both.mapInArrow(check, "row_key long, item_id long, n_windows int, n_found int, containment double, new_values boolean")
    names = docs.select(F.xxhash64(id_col, text_col).alias("row_key"), id_col).join(sure.select("row_key").distinct(), "row_key", "left_semi").distinct()
    return sure.distinct().join(names, "row_key").select("row_key", id_col, "item_id", "n_windows", "n_found", "containment", "new_values")


def aligned(item: list[tuple], doc: list[tuple]) -> tuple[int, bool]:
    """Windows of an item that a document holds in alignments and whose slots fit, and whether a value differs.

    In an alignment each value of the item stands for its most frequent partner (of equally frequent
    ones for itself, else for the least); a window that holds another partner does not fit.
    """
    where: dict[int, list] = defaultdict(list)
    for w, at, values in item:
        where[w].append((at, values))
    shifts: dict[int, list] = defaultdict(list)
    for w, at, values in doc:
        for item_at, item_values in where.get(w, ()):
            shifts[at - item_at].append((item_at, [(a.partition("=")[2], b.partition("=")[2]) for a, b in zip(item_values, values, strict=True)]))
    found: set[int] = set()
    new = False
    for matches in shifts.values():
        partners: dict[str, Counter] = defaultdict(Counter)
        for _, pairs in matches:
            for a, b in pairs:
                partners[a][b] += 1
        stands_for = {a: min(seen, key=lambda b: (-seen[b], a != b, b)) for a, seen in partners.items()}
        fits = {at for at, pairs in matches if all(stands_for[a] == b for a, b in pairs)}
        found |= fits
        new |= bool(fits) and any(a != b for a, seen in partners.items() for b in seen)
    return len(found), new
