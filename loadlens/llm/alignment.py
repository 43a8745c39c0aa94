"""Alignment of two tokenizers over the same bytes.

A text is encoded by A (byte-level BPE) and B (sentencepiece); where a token of A and
one of B end at the same byte the text is cut into groups. ``align`` walks the two end
arrays by diagonal run skipping: at the current shift between their indices it probes
stretches of doubling length and jumps those that are equal (one token to one token);
an irregular group is resolved by stepping the side that is behind, which updates the
shift.

Both tokenizers encode the parts of a text between certain spaces independently (see
``part_starts``), so a part is encoded once and remembered (bounded by bytes). Texts
are aligned over whole stretches of tokens, cut only where a part ends.

A link is the pair of tokens that end together; tokens have a byte at least, so each
group has one. One of two linked tokens is a suffix of the other, so the vocabularies
alone bound the number of distinct pairs (``linkable_pairs``): their corpus-wide
counts are small enough to send to every task, whatever the size of the corpus.

Cases: null and empty texts, and texts whose tokens do not give back their bytes (the
sign U+2581 in a text), have no tokens: zeros and an empty digest; repeated rows and
rows without id are aligned and counted each; an empty table gives no rows; other
columns are not read. A task holds a piece of ``texts.PIECE_BYTES`` or one longer text.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import stored
from loadlens.llm.memo import ByteMemo, by_bytes
from loadlens.llm.pretokens import kept
from loadlens.llm.texts import byte_list, byte_table, cut_by_bytes, flat

#: Tokens of one side that are aligned at once; distinct pairs that a counting task collects before it adds them up.
STRETCH, PENDING = 1 << 19, 1 << 20
#: Bytes of the encoded parts that a worker remembers.
MEMO_BYTES = 128 << 20
PRINTABLE = byte_table("".join(map(chr, range(0x21, 0x7F))))
#: First bytes of two-byte characters none of which is white space (U+00C0 to U+07FF).
TWO_BYTES = (np.arange(256) >= 0xC3) & (np.arange(256) < 0xE0)


# ---------------------------------------------------------------- vocabularies

@lru_cache(maxsize=2)
def byte_level(path: str):
    """The tokenizer of a .json file; strings of special tokens in a text are plain text."""
    from tokenizers import Tokenizer
    made = Tokenizer.from_file(path)
    made.no_truncation()
    made.no_padding()
    made.encode_special_tokens = True
    return made


@lru_cache(maxsize=2)
def pieces_model(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level BPE writes for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of every token, by id; empty for special tokens, which no plain text has."""
    if path.endswith(".model"):
        model = pieces_model(path)

        def piece_bytes(i: int) -> bytes:
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                return bytes([int(piece[3:5], 16)])
            return b"" if model.is_control(i) or model.is_unknown(i) else piece.replace("▁", " ").encode()

        return [piece_bytes(i) for i in range(model.get_piece_size())]
    back = byte_alphabet()
    special = {a["id"] for a in json.loads(byte_level(path).to_str())["added_tokens"]}
    vocabulary = byte_level(path).get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        if i not in special:
            out[i] = bytes(back[c] for c in token)
    return out


def linkable_pairs(path_a: str, path_b: str) -> int:
    """How many pairs of tokens can end together at all: those of which one is a suffix of the other."""
    tokens_a, tokens_b = token_bytes(path_a), token_bytes(path_b)

    def counts(tokens: list[bytes]) -> dict[bytes, int]:
        out: dict[bytes, int] = {}
        for t in filter(None, tokens):
            out[t] = out.get(t, 0) + 1
        return out

    in_a, in_b = counts(tokens_a), counts(tokens_b)
    shorter_b = sum(in_b.get(t[-k:], 0) for t in tokens_a for k in range(1, len(t) + 1))
    return shorter_b + sum(in_a.get(t[-k:], 0) for t in tokens_b for k in range(1, len(t)))


def splits_at_spaces(path: str) -> bool:
    """Whether parts that begin with a single space encode alone (see ``part_starts``).

    Byte-level: the usual pattern splits the text as it is. Pieces: none goes on over a
    space after another character, so no merge crosses the start of a part.
    """
    if path.endswith(".model"):
        return not any(b" " in t.lstrip(b" ") for t in token_bytes(path))
    made = json.loads(byte_level(path).to_str())
    step = made["pre_tokenizer"] or {}
    return made["normalizer"] is None and step.get("type") == "ByteLevel" and step["use_regex"] and not step["add_prefix_space"]


# ---------------------------------------------------------------- encoding

def part_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the texts (each after a space) can be cut: at their starts, and at single spaces
    between two characters that are surely no white space.

    B never merges over such a space, and A's pattern begins a match there: its
    alternatives take white space only at their start, and a run of white space is one
    part with what is around it.
    """
    at = np.flatnonzero(data == 32)
    at = at[(at >= 2) & (at < len(data) - 1)]
    before = PRINTABLE[data[at - 1]] | (TWO_BYTES[data[at - 2]] & ((data[at - 1] & 0xC0) == 0x80))
    after = PRINTABLE[data[at + 1]] | TWO_BYTES[data[at + 1]]
    first = np.zeros(len(data), bool)
    first[at[before & after]] = first[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    return np.flatnonzero(first)


class Encoder:
    """Ids by both tokenizers of the parts of texts; a value is A's ids, B's ids, and whether they give back the part."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_level(path_a), pieces_model(path_b)
        self.bytes_a, self.bytes_b = token_bytes(path_a), token_bytes(path_b)
        self.whole = not (splits_at_spaces(path_a) and splits_at_spaces(path_b))
        self.memo = ByteMemo(self.solve, MEMO_BYTES, lambda v: len(v[0]) + len(v[1]) + 200)

    def solve(self, parts: list[bytes]) -> Iterator[tuple[bytes, bytes, bool]]:
        for some in by_bytes(parts):
            texts = [p.decode() for p in some]
            by_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
            by_b = self.b.encode([t[1:] for t in texts], num_threads=1)  # B adds the space itself
            for part, a, b in zip(some, by_a, by_b, strict=True):
                good = (b"".join([self.bytes_a[i] for i in a]) == part) and (b"".join([self.bytes_b[i] for i in b]) == part)
                yield array("I", a).tobytes(), array("I", b).tobytes(), good

    def parts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        starts = offsets[:-1][offsets[1:] > offsets[:-1]] if self.whole else part_starts(data, offsets)
        places = np.append(starts, len(data)).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data)])
        return starts, found.dictionary_encode()

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all rows by A and by B, and where each row's ids end on either side."""
        n = len(offsets) - 1
        if not len(data):
            none = np.zeros(0, np.uint32)
            return none, none, np.zeros(n, np.int64), np.zeros(n, np.int64)
        starts, coded = self.parts(data, offsets)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        values = self.memo.values(byte_list(coded.dictionary))
        owner = np.searchsorted(offsets, starts, "right") - 1
        good = np.array([v[2] for v in values], bool)
        lost = [r for r in np.unique(owner[~good[codes]]).tolist() if not self.gives_back(
            data[offsets[r]:offsets[r + 1]].tobytes(), [values[c] for c in codes[owner == r]])]
        if lost:
            stay = ~np.isin(owner, lost)
            codes, owner = codes[stay], owner[stay]
        out = []
        for side in (0, 1):
            packed = pa.array([v[side] for v in values], pa.binary())
            sizes = np.diff(np.frombuffer(packed.buffers()[1], np.int32, len(values) + 1)) // 4
            taken = packed.take(pa.array(codes)).buffers()[2] if len(codes) else None
            out.append((np.frombuffer(taken, "<u4") if taken else np.zeros(0, np.uint32),
                        np.cumsum(np.bincount(owner, sizes[codes], minlength=n)).astype(np.int64)))
        (ids_a, rows_a), (ids_b, rows_b) = out
        return ids_a, ids_b, rows_a, rows_b

    def gives_back(self, text: bytes, values: list[tuple[bytes, bytes, bool]]) -> bool:
        """Whether the ids of a text's parts together give back the text on both sides."""
        return all(b"".join([table[i] for v in values for i in np.frombuffer(v[side], "<u4").tolist()]) == text
                   for side, table in ((0, self.bytes_a), (1, self.bytes_b)))


# ---------------------------------------------------------------- alignment

def align(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each group the number of A's and of B's tokens up to its end.

    Both arrays rise strictly and end with the same number.
    """
    one, two = ends_a.tolist(), ends_b.tolist()
    wide_a, wide_b = ends_a.astype(np.int64).tobytes(), ends_b.astype(np.int64).tobytes()
    n, i, j = len(one), 0, 0
    from_a, from_b, lengths = [], [], []
    while i < n:
        x, y = one[i], two[j]
        if x == y:
            from_a.append(i)
            from_b.append(j)
            first, step = i, 4
            i, j = i + 1, j + 1
            if i < n and one[i] == two[j]:  # a run: probe doubling stretches at this shift
                i, j = i + 1, j + 1
                while i + step <= n and wide_a[8 * i:8 * (i + step)] == wide_b[8 * j:8 * (j + step)]:
                    i, j, step = i + step, j + step, 2 * step
                while step > 4:  # it ends within the next stretch: halve
                    step //= 2
                    if i + step <= n and wide_a[8 * i:8 * (i + step)] == wide_b[8 * j:8 * (j + step)]:
                        i, j = i + step, j + step
                while i < n and one[i] == two[j]:
                    i, j = i + 1, j + 1
            lengths.append(i - first)
        else:
            while x != y:
                if x < y:
                    i += 1
                    x = one[i]
                else:
                    j += 1
                    y = two[j]
            from_a.append(i)
            from_b.append(j)
            lengths.append(1)
            i, j = i + 1, j + 1
    size = np.array(lengths, np.int64)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return np.repeat(np.array(from_a, np.int64), size) + inside + 1, np.repeat(np.array(from_b, np.int64), size) + inside + 1


def align_rows(ends_a: np.ndarray, ends_b: np.ndarray, rows_a: np.ndarray, rows_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``align`` over the concatenated rows, some rows at a time.

    ``rows_a`` and ``rows_b`` hold where each row's tokens end; rows end together.
    """
    groups_a, groups_b, a, b, row = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0, 0, 0
    while row < len(rows_a):
        row = max(row + 1, int(np.searchsorted(rows_a, a + STRETCH, "right")))
        to_a, to_b = int(rows_a[row - 1]), int(rows_b[row - 1])
        found_a, found_b = align(ends_a[a:to_a], ends_b[b:to_b])
        groups_a.append(found_a + a)
        groups_b.append(found_b + b)
        a, b = to_a, to_b
    return np.concatenate(groups_a), np.concatenate(groups_b)


class Aligner:
    """Groups, links and digests of many texts."""

    def __init__(self, path_a: str, path_b: str):
        self.encoder = Encoder(path_a, path_b)
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in table], np.uint8 if max(map(len, table)) < 256 else np.uint32)
                                      for table in (self.encoder.bytes_a, self.encoder.bytes_b))
        self.n_a, self.n_b = len(self.sizes_a), len(self.sizes_b)
        if self.n_a * self.n_b >= 1 << 32:
            raise ValueError("pairs of ids must fit 32 bits")
        signs = [(self.n_a, ","), (self.n_a, "|"), (self.n_b, ","), (self.n_b, ";")]
        self.written = pa.array([f"{i}{sign}".encode() for size, sign in signs for i in range(size)], pa.binary())

    def digests(self, ids_a: np.ndarray, ids_b: np.ndarray, groups_a: np.ndarray, groups_b: np.ndarray,
                rows_a: np.ndarray, rows_b: np.ndarray) -> Iterator[memoryview]:
        """Each row's groups as text: ``a1,a2|b1;a3|b2,b3``."""
        zero = np.zeros(1, np.int64)
        sizes_a, sizes_b = np.diff(groups_a, prepend=zero), np.diff(groups_b, prepend=zero)
        last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
        last_a[groups_a - 1], last_b[groups_b - 1] = True, True
        signs = np.empty(len(ids_a) + len(ids_b), np.int32)
        signs[np.arange(len(ids_a)) + np.repeat(groups_b - sizes_b, sizes_a)] = ids_a + last_a * np.uint32(self.n_a)
        signs[np.arange(len(ids_b)) + np.repeat(groups_a, sizes_b)] = 2 * self.n_a + ids_b + last_b * np.uint32(self.n_b)
        text = self.written.take(pa.array(signs))
        _, places, data = text.buffers()
        ends = np.frombuffer(places, np.int32, len(text) + 1)[rows_a + rows_b]
        view, begin = memoryview(data) if data is not None else memoryview(b""), 0
        for end in ends.tolist():
            yield view[begin:max(begin, end - 1)]
            begin = end

    def rows(self, column: pa.Array) -> list[pa.Array]:
        """``n_a, n_b, n_groups, n_links, groups_sha256, links`` of texts that begin with a space (or are empty)."""
        data, offsets = flat(column)
        ids_a, ids_b, rows_a, rows_b = self.encoder.encode(data, offsets)
        ends_a = np.cumsum(self.sizes_a[ids_a], dtype=np.int64)
        ends_b = np.cumsum(self.sizes_b[ids_b], dtype=np.int64)
        groups_a, groups_b = align_rows(ends_a, ends_b, rows_a, rows_b)
        upto = np.searchsorted(groups_a, rows_a, "right")
        digests = [hashlib.sha256(text).hexdigest() if len(text) else ""
                   for text in self.digests(ids_a, ids_b, groups_a, groups_b, rows_a, rows_b)]
        links = ids_a[groups_a - 1] * np.uint32(self.n_b) + ids_b[groups_b - 1]
        places = np.concatenate([[0], 4 * upto]).astype(np.int32)
        packed = pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(places), pa.py_buffer(links.astype("<u4"))])
        n_groups = pa.array(np.diff(upto, prepend=0))
        return [pa.array(np.diff(rows_a, prepend=0)), pa.array(np.diff(rows_b, prepend=0)), n_groups, n_groups,
                pa.array(digests, pa.string()), packed]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links")


def after_space(text_col: str) -> Column:
    """Space and text as bytes; nothing for null and empty texts."""
    text = F.col(text_col)
    return F.when(F.length(text) > 0, F.concat(F.lit(" "), text)).otherwise(F.lit("")).cast("binary")


def alignments(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id`` and the alignment of every row; ``links`` holds 32-bit numbers ``a * size of B + b``, one a link."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept("align", f"{path_a}|{path_b}", lambda: Aligner(path_a, path_b))
        for batch in batches:
            for piece in cut_by_bytes(batch, 1):
                yield pa.record_batch([piece.column(0), *aligner.rows(piece.column(1))], ["id", *COLUMNS])

    plain = docs.select(F.col(id_col).alias("id"), after_space(text_col).alias("t"))
    kind = plain.schema["id"].dataType.simpleString()
    return plain.mapInArrow(run, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary")


# ---------------------------------------------------------------- counts

def added_up(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with the sums of their counts."""
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


def link_counts(aligned: DataFrame) -> DataFrame:
    """``pair, n``: how many links of the corpus are of each pair of ids."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], 0
        for batch in batches:
            for piece in cut_by_bytes(batch, 0, 16 << 20):
                data, _ = flat(piece.column(0))
                key, count = np.unique(np.frombuffer(data.tobytes(), "<u4"), return_counts=True)
                keys.append(key)
                counts.append(count.astype(np.int64))
                held += len(key)
                if held > PENDING:
                    key, count = added_up(keys, counts)
                    keys, counts, held = [key], [count], 0
        key, count = added_up(keys, counts)
        yield pa.record_batch([pa.array(key.astype(np.int64)), pa.array(count)], ["pair", "n"])

    return aligned.select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def with_link_counts(aligned: DataFrame, counts: DataFrame, size_b: int, bound: int) -> DataFrame:
    """The alignments with ``n_best`` and ``count_sum``.

    ``bound`` is the proven number of linkable pairs; more rows in ``counts`` than that
    are an error, so what is broadcast never grows with the corpus.
    """
    table = counts.limit(bound + 1).toArrow()
    if table.num_rows > bound:
        raise ValueError(f"{table.num_rows} pairs where the vocabularies allow {bound}")
    pairs, n = table.column("pair").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(pairs)
    pairs, n = pairs[order].astype(np.uint32), n[order]
    most = np.zeros(size_b, np.int64)
    np.maximum.at(most, pairs % size_b, n)
    names = aligned.columns
    sent = aligned.sparkSession.sparkContext.broadcast((pairs, n, n == most[pairs % size_b]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, n, best = sent.value
        for batch in batches:
            for piece in cut_by_bytes(batch, names.index("links"), 16 << 20):
                data, offsets = flat(piece.column(names.index("links")))
                at = np.searchsorted(pairs, np.frombuffer(data.tobytes(), "<u4"))
                sums = [np.concatenate([[0], np.cumsum(x[at], dtype=np.int64)])[offsets // 4] for x in (best, n)]
                yield pa.record_batch([*piece.columns, *(pa.array(np.diff(s)) for s in sums)], [*names, "n_best", "count_sum"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.schema.fields)
    return aligned.mapInArrow(run, f"{kinds}, n_best long, count_sum long")


def aligned_corpus(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Alignments of all rows, written once, with the corpus-wide counts of their links."""
    done = stored(alignments(docs, path_a, path_b, id_col, text_col), "alignments")
    bound = linkable_pairs(path_a, path_b)
    return with_link_counts(done, link_counts(done), len(token_bytes(path_b)), bound)
