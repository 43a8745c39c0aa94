"""Token ids of whole texts by parts that a public tokenizer encodes independently.

A word tokenizer (one whose pre-tokenizer keeps only matches of a pattern that
holds no white space) gives a text the ids of its white-space-separated parts,
one after another. So the distinct parts of an Arrow batch are looked up or encoded
once, and the ids of its texts are gathered by number. What is remembered is bounded by
bytes. For other tokenizers every text goes through the library as a whole.

``whole_tokens`` is the proof step, run once on the driver: the vocabulary
strings that the library, asked for each of them alone, encodes as that one token.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from loadlens.llm.memo import ByteMemo
from loadlens.llm.texts import SPACES, byte_list, byte_table, coded, flat, runs, spans

#: Bytes of the parts, and of their pieces, that a worker remembers.
PART_BYTES = 96 << 20

#: Characters on which Python and the tokenizer's own rules surely agree: printable
#: ASCII and the composed Latin letters (but the dotted capital I).
PLAIN = re.compile("[!-~À-ÖØ-öø-įı-ſ]*")
#: The pre-tokens of a lower-cased plain part.
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
#: The pattern that ``PIECE`` restates; the shortcut holds only for it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Memo(dict):
    """A dict that solves missing keys and keeps between ``limit`` and twice as many of the latest."""

    def __init__(self, solve: Callable, limit: int = 250_000):
        super().__init__()
        self.solve, self.limit, self.old = solve, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.solve(key)
        if len(self) >= self.limit:
            self.old = self.copy()
            self.clear()
        self[key] = value
        return value


@lru_cache(maxsize=4)
def load(path: str):
    """The library's tokenizer of a vocabulary file: tokenizers for .json, sentencepiece for .model."""
    if path.endswith(".model"):
        import sentencepiece
        return sentencepiece.SentencePieceProcessor(model_file=path)
    from tokenizers import Tokenizer
    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    return made


def library_ids(path: str, text: str) -> list[int]:
    made = load(path)
    return made.encode(text, num_threads=1) if path.endswith(".model") else made.encode(text, add_special_tokens=False).ids


@lru_cache(maxsize=4)
def splits_words(path: str) -> bool:
    """Whether the tokenizer is the kind for which the parts of a text encode independently:
    composed, white space folded, lower case, then only matches of ``PATTERN``."""
    if path.endswith(".model"):
        return False
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    steps = [s.get("type") for s in (made.get("normalizer") or {}).get("normalizers", [])]
    first, *rest = (made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return (steps == ["NFC", "Replace", "Lowercase"] and first.get("pattern") == {"Regex": PATTERN}
            and first.get("behavior") == "Removed" and bool(first.get("invert"))
            and all(r.get("type") == "ByteLevel" and not r.get("add_prefix_space") and not r.get("use_regex") for r in rest)
            and made["post_processor"] is None
            and not any(a.get("lstrip") or a.get("rstrip") or a.get("single_word") or not a["content"].startswith("<|")
                        for a in made["added_tokens"]))


@lru_cache(maxsize=4)
def whole_tokens(path: str) -> dict[str, int]:
    """Vocabulary strings that surely encode alone as their one token (at most the vocabulary's size)."""
    if not splits_words(path):
        return {}
    from tokenizers.decoders import ByteLevel
    made, back = load(path), ByteLevel()
    end = json.loads(made.to_str())["model"].get("end_of_word_suffix") or ""
    words = {}
    for token, number in made.get_vocab(with_added_tokens=False).items():
        if token.endswith(end):
            text = back.decode([token[:len(token) - len(end)]])
            if text and PLAIN.fullmatch(text) and PIECE.findall(text.lower()) == [text]:
                words[text] = number
    texts = list(words)
    found = made.encode_batch_fast(texts, add_special_tokens=False)
    return {t: words[t] for t, e in zip(texts, found, strict=True) if e.ids == [words[t]]}


def pieces(part: str) -> list[str] | None:
    """The pre-tokens of a plain part; None if only the library can tell."""
    if part.isascii():  # most parts: letters, perhaps with a sign behind them
        if part.isalpha():
            return [part.lower()]
        if part[-1] in ".,;:!?" and part[:-1].isalpha():
            return [part[:-1].lower(), part[-1]]
    if "<|" in part or not PLAIN.fullmatch(part):
        return None
    return PIECE.findall(part.lower())


_KEPT: dict = {}


def kept(kind: str, path: str, make: Callable) -> Callable:
    """``make()``, once for each Python worker: what a task has learnt serves the next."""
    if (kind, path) not in _KEPT:
        _KEPT[kind, path] = make()
    return _KEPT[kind, path]


#: Python's Latin-1 characters as byte-level BPE writes them: printable ones as they are, the rest from 256 on.
_HIDDEN = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b >= 174)]
BYTE_LEVEL = {b: 256 + i for i, b in enumerate(_HIDDEN)}


def merger(path: str) -> Callable[[bytes], list[int]]:
    """A function from a plain pre-token (see ``pieces``) to its ids, by the library's model alone."""
    model = load(path).model

    def merge(piece: bytes) -> list[int]:
        text = piece.decode() if piece.isascii() else piece.decode("latin-1").translate(BYTE_LEVEL)
        return [t.id for t in model.tokenize(text)]

    return merge


#: ASCII letters, and ASCII signs behind which no special string and no contraction can hide.
LETTERS = byte_table("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
SIGNS = byte_table("!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~")
#: First bytes of the two-byte letters of ``PLAIN``, and the three characters among them that are not in it.
LEADS, NOT_PLAIN = (0xC3, 0xC5), ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0))


def plain_letters(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to letters of ``PLAIN``."""
    inside = LETTERS[data]
    lead = (data >= LEADS[0]) & (data <= LEADS[1])
    if lead.any():
        at = np.flatnonzero(lead)
        after = data[at + 1]
        for first, second in NOT_PLAIN:
            keep = (data[at] != first) | (after != second)
            at, after = at[keep], after[keep]
        inside[at] = inside[at + 1] = True
    return inside


def cut_signs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """The bytes and the parts, with plain words in small ASCII letters and the signs behind a plain word as a part of their own.

    The word and the signs are pre-tokens for themselves, so the ids stay the same; words
    that differ by what stands behind them, or by capitals, are one distinct part.
    """
    letters = plain_letters(data)
    letters_upto = np.concatenate([[0], np.cumsum(letters, dtype=np.int32)])
    signs_upto = np.concatenate([[0], np.cumsum(SIGNS[data], dtype=np.int32)])
    middle = starts + letters_upto[ends] - letters_upto[starts]
    plain = (middle > starts) & (letters_upto[middle] - letters_upto[starts] == middle - starts) & (
        signs_upto[ends] - signs_upto[middle] == ends - middle)
    edges = np.zeros(len(data) + 1, np.int8)
    edges[starts[plain]] = 1
    edges[middle[plain]] -= 1
    small = data + 32 * (np.cumsum(edges[:-1], dtype=np.int8).view(np.uint8) & (data >= 65) & (data <= 90))
    cut = plain & (middle < ends)
    place = np.arange(len(starts)) + np.cumsum(cut) - cut
    begins, stops = np.empty(len(starts) + cut.sum(), np.int64), np.empty(len(starts) + cut.sum(), np.int64)
    begins[place], stops[place + cut] = starts, ends
    begins[place[cut] + 1] = stops[place[cut]] = middle[cut]
    return small, begins, stops, np.repeat(owner, 1 + cut)


class Parts:
    """Values of the white-space-separated parts of many texts (see ``cut_signs``); each distinct part of a batch is looked up once."""

    def __init__(self, solve: Callable[[list[bytes]], Iterable], limit: int = PART_BYTES, weight: Callable = len):
        self.memo = ByteMemo(solve, limit, weight)

    def of(self, column: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
        """Distinct values, the number of each part's value, and the row of each part."""
        data, offsets = flat(column)
        data, starts, ends, owner = cut_signs(data, *runs(~SPACES[data], offsets))
        codes, distinct = coded(spans(data, starts, ends))
        return self.memo.values(byte_list(distinct)), codes, owner


def batch_counter(path: str, whole: dict[str, int] | frozenset[str]) -> Callable[[pa.Array], np.ndarray]:
    """A function from a column of UTF-8 bytes to each text's number of tokens."""
    if not splits_words(path):
        return lambda column: np.array([len(library_ids(path, t.as_py().decode())) for t in column], np.int64)
    made = load(path)

    merge = merger(path)
    rest = ByteMemo(lambda keys: [len(merge(k)) for k in keys], PART_BYTES, lambda n: 8)

    def solve(parts: list[bytes]) -> list[int]:
        """Whole tokens are counted directly; the library merges the rest, each distinct piece once."""
        counts, owner, left = [0] * len(parts), [], []
        for i, part in enumerate(parts):
            if part.isalpha():  # ASCII: one piece, and remembered as a part
                text = part.decode().lower()
                counts[i] = 1 if text in whole else len(merge(text.encode()))
                continue
            found = pieces(part.decode())
            if found is None:
                counts[i] = len(made.encode(part.decode(), add_special_tokens=False).ids)
                continue
            for p in found:
                if p in whole:
                    counts[i] += 1
                else:
                    owner.append(i)
                    left.append(p.encode())
        for i, n in zip(owner, rest.values(left), strict=True):
            counts[i] += n
        return counts

    table = Parts(solve, weight=lambda n: 8)

    def count(column: pa.Array) -> np.ndarray:
        values, codes, owner = table.of(column)
        each = np.array(values, np.int64)[codes] if len(codes) else np.zeros(0, np.int64)
        return np.bincount(owner, each, minlength=len(column)).astype(np.int64)

    return count


def batch_encoder(path: str, whole: dict[str, int]) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]:
    """A function from a column of UTF-8 bytes to the ids of all its texts, and where each text's ids end."""
    if not splits_words(path):
        def each(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            ids = [library_ids(path, t.as_py().decode()) for t in column]
            return np.array([i for x in ids for i in x], np.uint32), np.cumsum([len(x) for x in ids], dtype=np.int64)
        return each
    made = load(path)
    single = {token.encode(): number.to_bytes(4, "little") for token, number in whole.items()}

    merge = merger(path)
    rest = ByteMemo(lambda keys: [array("I", merge(k)).tobytes() for k in keys], PART_BYTES)

    def mixed(part: bytes) -> bytes:
        """The ids of a part that is not a plain word; its pieces come again in other parts."""
        found = pieces(part.decode())
        if found is None:
            return array("I", made.encode(part.decode(), add_special_tokens=False).ids).tobytes()
        some = [p.encode() for p in found]
        if len(some) == 1:  # remembered as a part
            return single.get(some[0]) or array("I", merge(some[0])).tobytes()
        left = [p for p in some if p not in single]
        known = dict(zip(left, rest.values(left), strict=True))
        return b"".join([known.get(p) or single[p] for p in some])

    def solve(parts: list[bytes]) -> Iterator[bytes]:
        """Whole tokens have their id; the library's model merges the rest."""
        for part in parts:
            if part.isalpha():  # ASCII: one piece, and remembered as a part
                part = part.lower()
                yield single.get(part) or array("I", merge(part)).tobytes()
            else:
                yield mixed(part)

    table = Parts(solve)

    def encode(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        values, codes, owner = table.of(column)
        if not len(codes):
            return np.zeros(0, np.uint32), np.zeros(len(column), np.int64)
        packed = pa.array(values, pa.binary())
        sizes = np.diff(np.frombuffer(packed.buffers()[1], np.int32, len(values) + 1)) // 4
        taken = packed.take(pa.array(codes)).buffers()[2]
        ends = np.cumsum(np.bincount(owner, sizes[codes], minlength=len(column))).astype(np.int64)
        return (np.frombuffer(taken, "<u4") if taken else np.zeros(0, np.uint32))[:ends[-1]], ends

    return encode


def counter(path: str, whole: dict[str, int] | frozenset[str]) -> Callable[[bytes], int]:
    """A function from one text's UTF-8 bytes to its number of tokens."""
    count = batch_counter(path, whole)
    return lambda data: int(count(pa.array([data], pa.binary()))[0])


def encoder(path: str, whole: dict[str, int]) -> Callable[[bytes], bytes]:
    """A function from one text's UTF-8 bytes to its ids as little-endian unsigned 32-bit integers."""
    encode = batch_encoder(path, whole)
    return lambda data: encode(pa.array([data], pa.binary()))[0].astype("<u4").tobytes()
