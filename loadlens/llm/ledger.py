"""Quality rules as a bitmask ledger.

``measure`` reads every text once and gives its measurements; ``judged`` adds one
integer in which bit i is set if rule i fails. Written as a table this is the ledger:
texts are not read again. A policy is a mask of the ledger's bits, so policies are
applied, compared and ablated by integer operations alone.

Rules keep their bit for ever; a changed rule is a new rule with the next free bit,
and a changed policy a new version, so old ledgers and verdicts stay readable.

Cases: null and empty texts have no words and no lines (they fail ``few_words`` and
nothing else); white space is space, tab, line feed, vertical tab, form feed and
carriage return; repeated rows and rows without an id are judged like any other, one
row out for each row in; an empty table gives an empty ledger; other columns are not
read, so they may have any name. A task holds a piece of ``texts.PIECE_BYTES`` of text
or one longer text, whose word numbers and window keys take about 40 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.texts import SPACES, byte_table, coded, cut_by_bytes, flat, row_sums, runs, spans

#: Words of a window whose repetition counts.
WINDOW = 5
#: Odd multiplier of the window keys.
MIX = np.uint64(0x9E3779B97F4A7C15)
SYMBOLS, MARKS = byte_table("#*$%&|<>"), byte_table("!?")
CAPITALS, SMALL = (byte_table("".join(map(chr, range(a, a + 26)))) for a in (65, 97))
LETTERS = CAPITALS | SMALL | (np.arange(256) >= 128)

MEASURES = ("n_bytes", "n_chars", "n_words", "word_chars", "longest_word", "n_letter_words", "n_capital_words",
            "n_symbols", "n_marks", "n_lines", "n_dup_lines", "n_repeat_words", "n_echo_words")


@dataclass(frozen=True)
class Rule:
    """A check over the measurements; ``fails`` is a condition in Spark SQL."""

    bit: int
    name: str
    fails: str


#: Conditions in whole numbers, so that a limit is met or missed without rounding.
RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 10 * n_words"),
    Rule(3, "duplicate_lines", "n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)"),
    Rule(5, "capitals", "100 * n_capital_words > 50 * n_words"),
    Rule(6, "marks", "100 * n_marks > 50 * n_words"),
    Rule(7, "few_letters", "100 * n_letter_words < 50 * n_words"),
    Rule(8, "long_word", "longest_word > 1000"),
    Rule(9, "echoes", "100 * n_echo_words > 30 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """Rejects a document if a rule of ``reject`` fails, or more than ``allowed`` of ``soft``."""

    name: str
    version: int
    reject: tuple[str, ...]
    soft: tuple[str, ...] = ()
    allowed: int = 0


#: Words in scripts without spaces are whole sentences, so ``clean`` does not judge word lengths.
POLICIES = {(p.name, p.version): p for p in (
    Policy("base", 1, ("few_words", "repeated_words")),
    Policy("clean", 1, ("few_words", "repeated_words", "symbols", "duplicate_lines", "capitals", "marks", "few_letters",
                        "echoes")),
    Policy("strict", 1, ("few_words", "repeated_words", "symbols", "duplicate_lines"),
           ("word_length", "capitals", "marks", "few_letters", "long_word", "echoes"), 0),
)}


def mask(names: Iterable[str], rules: Iterable[Rule] = RULES) -> int:
    """The bits of the named rules."""
    bits = {r.name: 1 << r.bit for r in rules}
    return reduce(or_, (bits[n] for n in names), 0)


def repeated_words(codes: np.ndarray, owner: np.ndarray, n_rows: int) -> np.ndarray:
    """For each row the words that lie in a window found twice or more in that row.

    Windows are compared by a 64-bit key; those that share one are compared word by
    word, so a key that two different windows share changes nothing.
    """
    n = len(codes) - WINDOW + 1
    if n < 2:
        return np.zeros(n_rows, np.int64)
    at = np.flatnonzero(owner[:n] == owner[WINDOW - 1:])
    key = owner[at].astype(np.uint64)
    for k in range(WINDOW):
        key = (key ^ (key >> np.uint64(29))) * MIX + codes[at + k].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    met = np.flatnonzero(key[order[1:]] == key[order[:-1]])
    if not len(met):
        return np.zeros(n_rows, np.int64)
    left, right = at[order[met]], at[order[met + 1]]
    same = owner[left] == owner[right]
    for k in range(WINDOW):
        same &= codes[left + k] == codes[right + k]
    if same.all():
        twice = np.unique(np.concatenate([left, right]))
    else:
        some = np.unique(np.concatenate([left, right]))
        whole = np.stack([owner[some], *(codes[some + k] for k in range(WINDOW))], axis=1)
        _, which, count = np.unique(whole, axis=0, return_inverse=True, return_counts=True)
        twice = some[count[which.ravel()] > 1]
    change = np.zeros(len(codes) + 1, np.int32)
    change[twice] = 1
    np.subtract.at(change, twice + WINDOW, 1)
    return np.bincount(owner[np.cumsum(change[:-1]) > 0], minlength=n_rows)


def _measured(column: pa.Array) -> list[np.ndarray]:
    data, offsets = flat(column)
    n = len(offsets) - 1
    space, char = SPACES[data], (data & 0xC0) != 0x80
    starts, ends, owner = runs(~space, offsets)
    words, cuts = np.bincount(owner, minlength=n), _edges(starts, ends)
    chars, capitals, small, letters = (row_sums(m, cuts)[1::2] for m in (char, CAPITALS[data], SMALL[data], LETTERS[data]))
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, owner, chars)
    line_starts, line_ends, line_owner = runs(data != 10, offsets)
    lines, _ = coded(spans(data, line_starts, line_ends))
    filled = row_sums(~space, _edges(line_starts, line_ends))[1::2] > 0
    line_owner, lines = line_owner[filled], lines[filled].astype(np.int64)
    n_lines = np.bincount(line_owner, minlength=n)
    distinct = np.unique(line_owner.astype(np.int64) << 32 | lines) >> 32
    codes, _ = coded(spans(data, starts, ends))
    echo = (codes[1:] == codes[:-1]) & (owner[1:] == owner[:-1])
    return [offsets[1:] - offsets[:-1], row_sums(char, offsets), words, row_sums(char & ~space, offsets), longest,
            np.bincount(owner[letters > 0], minlength=n), np.bincount(owner[(capitals > 1) & (small == 0)], minlength=n),
            row_sums(SYMBOLS[data], offsets), row_sums(MARKS[data], offsets), n_lines,
            n_lines - np.bincount(distinct, minlength=n), repeated_words(codes, owner, n),
            np.bincount(owner[1:][echo], minlength=n)]


def _edges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Offsets that cut bytes into gap, run, gap, run and so on, up to the last run."""
    out = np.empty(2 * len(starts) + 1, np.int64)
    out[0], out[1::2], out[2::2] = 0, starts, ends
    return out


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``<id_col>`` and the measurements of every row, from one pass over its text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in cut_by_bytes(batch, 1):
                found = [pa.array(x.astype(np.int64)) for x in _measured(piece.column(1))]
                yield pa.record_batch([piece.column(0), *found], ["id", *MEASURES])

    plain = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    kind = plain.schema["id"].dataType.simpleString()
    return plain.mapInArrow(run, f"id {kind}, {', '.join(f'{m} long' for m in MEASURES)}").withColumnRenamed("id", id_col)


def judged(measured: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """The ledger: measurements and ``failed``, with the bit of every rule that fails."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit).cast("long")).otherwise(F.lit(0).cast("long")) for r in rules]
    return measured.withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("long")))


def write_ledger(docs: DataFrame, out: str, id_col: str = "doc_id", text_col: str = "text", rules: Iterable[Rule] = RULES) -> None:
    """Evaluate every rule on every row once and write the ledger to ``out``."""
    judged(measure(docs, id_col, text_col), rules).write.option("compression", "zstd").parquet(out)


def rejected(policy: Policy, rules: Iterable[Rule] = RULES, failed: Column | str = "failed") -> Column:
    """Whether a policy rejects a ledger row, from its bits alone."""
    bits = F.col(failed) if isinstance(failed, str) else failed
    hard = bits.bitwiseAND(F.lit(mask(policy.reject, rules)).cast("long")) != 0
    if not policy.soft:
        return hard
    return hard | (F.bit_count(bits.bitwiseAND(F.lit(mask(policy.soft, rules)).cast("long"))) > policy.allowed)


def with_policy(ledger: DataFrame, policy: Policy, rules: Iterable[Rule] = RULES) -> DataFrame:
    """The ledger with ``kept``, the verdict of a policy, and its name and version."""
    return ledger.withColumns({"policy": F.lit(policy.name), "policy_version": F.lit(policy.version),
                               "kept": ~rejected(policy, rules)})


def mask_counts(ledger: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Documents and words for each distinct set of failures (at most 2 ** rules, in truth a few)."""
    return ledger.groupBy(*(by or []), "failed").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n_words").alias("n_words"))


def ablations(counts: DataFrame, policy: Policy, rules: Iterable[Rule] = RULES, by: list[str] | None = None) -> DataFrame:
    """What each rule of a policy does, from ``mask_counts``.

    One row for each rule: documents that fail it, that are rejected, that would be
    kept if the rule were taken out (and their words), and that it alone rejects.
    """
    rules = list(rules)
    used = [r for r in rules if r.name in policy.reject + policy.soft]
    cases = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in used])
    whole = F.lit(mask((r.name for r in used), rules)).cast("long")
    each = counts.withColumn("case", F.explode(cases))
    without = F.col("failed").bitwiseAND(F.bitwise_not(F.col("case.bit")))
    fails, out = F.col("failed").bitwiseAND(F.col("case.bit")) != 0, rejected(policy, rules)
    freed = out & ~rejected(policy, rules, without)

    def docs(when: Column, value: str = "n_docs") -> Column:
        return F.sum(F.when(when, F.col(value)).otherwise(0)).cast("long")

    return each.groupBy(*(by or []), F.col("case.rule").alias("rule")).agg(
        docs(fails).alias("n_failed"), docs(out).alias("n_rejected"), docs(freed).alias("n_freed"),
        docs(freed, "n_words").alias("words_freed"),
        docs(out & (F.col("failed").bitwiseAND(whole) == F.col("case.bit"))).alias("n_alone"))
