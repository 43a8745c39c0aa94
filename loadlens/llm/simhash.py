"""SimHash near-duplicates by a binary trie self-join.

Fingerprints: ASCII lower case, words between ASCII white space, shingles of
``words`` words (repeats count; a shorter text is one shingle), XXH64 with seed 42,
bit set if set in over half of the hashes.

Join: two fingerprints within ``limit`` bits agree on all but ``limit`` of a number
of bit blocks. So the distinct fingerprints are dealt by each choice of the other
blocks; fingerprints that share such a key form the root of a binary trie. A task
traverses its tries against themselves, pair of nodes by pair of nodes: a pair's
budget is the number of bits in which the nodes' common prefixes differ, and a pair
beyond the limit is cut with all below it. Chains of single children are skipped
(a node is a range of the sorted fingerprints with its common prefix). A key with
many fingerprints is cut into pieces, and pairs of pieces are joined in different
tasks. Tasks return only the links of a spanning forest of what they found, at most
one for each fingerprint, and components are found over those.

Cases: null, empty and white-space texts have fingerprint zero and link like any
other; copies share a fingerprint and are never paired; ties and repeated rows keep
the same component; a null doc_id counts as no candidate for the smallest id (a
component with none but null ids has a null id); an empty table gives no rows; only
the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlens.llm.common import components, shuffle_width, stored

SEED, BITS = 42, 64
#: Most fingerprints of a key in one piece; pairs of nodes joined at once; a node pair of at most so many pairs is compared directly.
PIECE, FRONTIER, LEAF = 4096, 1 << 15, 64


# ------------------------------------------------------------------ fingerprints

def simhash(data: bytes, words: int = 3) -> int:
    """The fingerprint of a text's UTF-8 bytes."""
    parts = data.lower().split()
    if not parts:
        return 0
    n = max(1, len(parts) - words + 1)
    shingles = map(b" ".join, zip(*(parts[i:] for i in range(words)))) if len(parts) >= words else [b" ".join(parts)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 row_key: Column | None = None) -> DataFrame:
    """``<id_col>, row_key, fp`` (the 64 bits as a signed long) of every row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([simhash(t.as_py(), words) for t in batch.column(2)], np.uint64)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], ["id", "row_key", "fp"])

    key = F.lit(0).cast("long") if row_key is None else row_key
    plain = docs.select(F.col(id_col).alias("id"), key.alias("row_key"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    kind = plain.schema["id"].dataType.simpleString()
    return plain.mapInArrow(run, f"id {kind}, row_key long, fp long").withColumnRenamed("id", id_col)


# ------------------------------------------------------------------ trie self-join

def key_masks(limit: int, free: int = 2) -> list[int]:
    """Bit masks such that any two values within ``limit`` bits agree under at least one.

    The bits are cut into ``limit + free`` blocks; a mask takes ``free`` of them.
    """
    blocks = limit + free
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(masks, free)]


def links(fps: DataFrame, limit: int = 3) -> DataFrame:
    """Links ``(a, b)`` that connect distinct fingerprints (column ``fp``) within ``limit`` bits.

    Not all pairs: per task a spanning forest of them, so components are the same.
    """
    spark = fps.sparkSession
    masks = [m - (1 << BITS) if m >> (BITS - 1) else m for m in key_masks(limit)]
    keys = F.array(*[F.struct(F.lit(i).alias("j"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks)])
    dealt = fps.select("fp", F.inline(keys))
    sizes = dealt.groupBy("j", "key").agg(F.count(F.lit(1)).alias("n"))
    hot = sizes.where(F.col("n") > PIECE).select("j", "key", F.ceil(F.col("n") / PIECE).cast("int").alias("pieces"))
    cut = dealt.join(hot, ["j", "key"], "left").withColumns({
        "pieces": F.coalesce("pieces", F.lit(1)), "own": F.pmod(F.xxhash64("fp"), F.coalesce("pieces", F.lit(1))).cast("int")})
    pairs = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select(
        "j", "key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "fp")
    pairs = pairs.repartition(shuffle_width(spark), "j", "key", "p", "q")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)  # a task's share of the keys; a large key is in many tasks
        if held:
            rows = pa.Table.from_batches(held)
            a, b = _join_tries(*(rows[c].to_numpy() for c in ("j", "key", "p", "q", "side", "fp")), limit)
            yield pa.record_batch([pa.array(a), pa.array(b)], ["a", "b"])

    return pairs.mapInArrow(run, "a long, b long").distinct()


def _join_tries(j, key, p, q, side, fp, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of all tries of a task; rows of a trie share j, key, p and q."""
    if not len(fp):
        return fp, fp
    bits = fp.view(np.uint64)
    order = np.lexsort((bits, side, q, p, key, j))
    j, key, p, q, side, bits = (x[order] for x in (j, key, p, q, side, bits))
    new = np.ones(len(bits), bool)
    new[1:] = (j[1:] != j[:-1]) | (key[1:] != key[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(bits))
    parent = np.arange(len(bits))
    split = starts + np.add.reduceat(side == 0, starts)  # where the second piece begins
    same = p[starts] == q[starts]
    first = np.stack([starts, np.where(same, ends, split), np.where(same, starts, split), ends])
    alive = (first[1] > first[0]) & (first[3] > first[2]) & ~(same & (ends - starts < 2))
    stack = [first[:, alive]]
    while stack:
        pairs = stack.pop()
        if pairs.shape[1] > FRONTIER:
            stack += np.array_split(pairs, -(-pairs.shape[1] // FRONTIER), axis=1)
            continue
        below = _step(bits, pairs, limit, parent)
        if below.shape[1]:
            stack.append(below)
    # rows of one fingerprint in different tries of a task need no joining here: components() does it
    root = _find(parent)
    moved = np.flatnonzero(root != np.arange(len(bits)))
    a, b = bits[root[moved]].view(np.int64), bits[moved].view(np.int64)
    return a, b


def _step(bits: np.ndarray, pairs: np.ndarray, limit: int, parent: np.ndarray) -> np.ndarray:
    """One level of the traversal: cut the pairs over budget, compare small ones, split the rest."""
    lo1, hi1, lo2, hi2 = pairs
    same = lo1 == lo2
    deep1, deep2 = _common(bits[lo1], bits[hi1 - 1]), _common(bits[lo2], bits[hi2 - 1])
    deep = np.minimum(deep1, deep2)
    fixed = np.bitwise_count((bits[lo1] ^ bits[lo2]) >> np.minimum(BITS - deep, 63).astype(np.uint64))
    fixed = np.where(deep == 0, 0, fixed)  # bits in which the two nodes surely differ
    n1, n2 = hi1 - lo1, hi2 - lo2
    keep = (fixed <= limit) & ~(same & (n1 == 1))
    leaf = keep & (n1 * n2 <= LEAF)
    if leaf.any():
        _compare(bits, pairs[:, leaf], limit, parent)
    go = keep & ~leaf
    lo1, hi1, lo2, hi2, same, deep1, deep2 = (x[go] for x in (lo1, hi1, lo2, hi2, same, deep1, deep2))
    mid1, mid2 = _middle(bits, lo1, hi1, deep1), _middle(bits, lo2, hi2, deep2)
    cut1 = (deep1 <= deep2) & (hi1 - lo1 > 1) & ~same  # split the node that branches first
    cut2 = ~cut1 & ~same
    out = [np.stack([lo1, mid1, lo2, hi2])[:, cut1], np.stack([mid1, hi1, lo2, hi2])[:, cut1],
           np.stack([lo1, hi1, lo2, mid2])[:, cut2], np.stack([lo1, hi1, mid2, hi2])[:, cut2],
           np.stack([lo1, mid1, lo1, mid1])[:, same], np.stack([mid1, hi1, mid1, hi1])[:, same],
           np.stack([lo1, mid1, mid1, hi1])[:, same]]
    return np.concatenate(out, axis=1)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of two fingerprints, in bits."""
    x = a ^ b
    for shift in (1, 2, 4, 8, 16, 32):
        x = x | (x >> np.uint64(shift))
    return BITS - np.bitwise_count(x).astype(np.int64)


def _middle(bits: np.ndarray, lo: np.ndarray, hi: np.ndarray, deep: np.ndarray) -> np.ndarray:
    """The first place in each sorted range whose bit after the common prefix is set."""
    bit = np.uint64(1) << (np.maximum(BITS - 1 - deep, 0)).astype(np.uint64)
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        one = (bits[np.minimum(mid, len(bits) - 1)] & bit) != 0
        hi = np.where(open_ & one, mid, hi)
        lo = np.where(open_ & ~one, mid + 1, lo)
    return lo


def _compare(bits: np.ndarray, pairs: np.ndarray, limit: int, parent: np.ndarray) -> None:
    """Join in ``parent`` all fingerprints of small node pairs within the limit."""
    lo1, hi1, lo2, hi2 = pairs
    n1, n2 = hi1 - lo1, hi2 - lo2
    total = n1 * n2
    of = np.repeat(np.arange(len(total)), total)
    k = np.arange(len(of)) - np.repeat(np.cumsum(total) - total, total)
    x, y = lo1[of] + k // n2[of], lo2[of] + k % n2[of]
    near = (x != y) & (np.bitwise_count(bits[x] ^ bits[y]) <= limit)
    _union(parent, x[near], y[near])


def _find(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent[:] = up


def _union(parent: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    while len(x):
        _find_some(parent, x, y)
        px, py = parent[x], parent[y]
        open_ = px != py
        x, y, px, py = x[open_], y[open_], px[open_], py[open_]
        np.minimum.at(parent, np.maximum(px, py), np.minimum(px, py))


def _find_some(parent: np.ndarray, *places: np.ndarray) -> None:
    """Point the given places straight at their roots."""
    for at in places:
        while True:
            up = parent[parent[at]]
            if np.array_equal(up, parent[at]):
                break
            parent[at] = up


# ------------------------------------------------------------------ classes

def near_duplicates(docs: DataFrame, words: int = 3, limit: int = 3, id_col: str = "doc_id", text_col: str = "text",
                    row_key: Column | None = None) -> DataFrame:
    """``<id_col>, row_key, fp, root, component_id`` of every row; component_id is the smallest id reachable over links.

    ``root`` is the component's least fingerprint, which stands for it also where no row has an id.

    ``row_key``, a long, comes along as it is (0 if not given).
    """
    marked = stored(fingerprints(docs, words, id_col, text_col, row_key), "fingerprints")
    first = stored(marked.groupBy("fp").agg(F.min(id_col).alias("first")), "distinct-fingerprints")
    roots = components(links(first.select("fp"), limit)).withColumnsRenamed({"node": "fp"})
    rooted = first.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp").select(
        id_col, "row_key", "fp", "root", "component_id")


def hex_digits(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
