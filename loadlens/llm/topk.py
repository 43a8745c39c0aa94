"""Exact top-k search by term-at-a-time accumulation.

Queries and candidates are dealt into blocks of bounded size. One task holds a
block of candidates as postings (for every dimension the rows that are not zero
there, with their weights) and a block of queries as sparse rows. For each
dimension of a query the weighted postings are scattered into a dense score
array; the k best of the block are then selected by partitioning that array, and
the blocks' winners are merged by a window over each query.

Cases: a vector that is null, or holds a null or non-finite component, takes no
part, nor does a row without id; shorter vectors count as padded with zeros (an
empty one scores 0 against all); rows that repeat an id are candidates each, and
as a query the least of them stands for the id; ties go to the smaller id; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Most rows in one block of queries, and of candidates.
QUERY_BLOCK, CANDIDATE_BLOCK, LEAST_BLOCK = 2048, 32768, 1024
#: Most cells of a dense score array held at once.
CELLS = 1 << 15


def integer_codes(vector: str, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(vector: str) -> Column:
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    return x.isNotNull() & ~bad


def top_k(rows: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", codes: str = "codes") -> DataFrame:
    """The k candidates of highest integer inner product for each query row.

    ``is_query`` marks the query rows; every row is a candidate for all queries
    but its own id. Returns ``query_id, rank, <id_col>, score``.
    """
    spark = rows.sparkSession
    base = rows.select(F.col(id_col).cast("long").alias("id"), F.col(codes).alias("codes"), is_query.alias("q")).where("id IS NOT NULL")
    counts = base.agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("q")).first()
    cores = spark.sparkContext.defaultParallelism
    size = min(CANDIDATE_BLOCK, max(LEAST_BLOCK, -(-counts["n"] // (4 * cores))))
    blocks, query_blocks = max(1, -(-counts["n"] // size)), max(1, -(-counts["q"] // QUERY_BLOCK))
    cand = base.select("id", "codes", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).alias("cb"),
                       F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"))
    query = base.where("q").groupBy("id").agg(F.min("codes").alias("codes")).select(
        "id", "codes", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("qb"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")).alias("cb"))

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        return _block_top_k(left, right, k)

    best = query.groupBy("qb", "cb").cogroup(cand.groupBy("qb", "cb")).applyInArrow(
        block, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_col), "score")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks()
    sizes = np.diff(flat.offsets.to_numpy())
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(flat), width), np.int64)
    rows = np.repeat(np.arange(len(flat)), sizes)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def _width(column: pa.ChunkedArray) -> int:
    return max((int(np.diff(c.offsets.to_numpy()).max()) for c in column.chunks if len(c)), default=0)


def _block_top_k(queries: pa.Table, candidates: pa.Table, k: int) -> pa.Table:
    none = {"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())}
    if not len(queries) or not len(candidates):
        return pa.table(none)
    width = max(_width(queries["codes"]), _width(candidates["codes"]))
    q, c = _matrix(queries["codes"], width), _matrix(candidates["codes"], width)
    q_ids, c_ids = queries["id"].to_numpy(), candidates["id"].to_numpy()
    largest = (int(np.abs(q.astype(float)).max(initial=0)) + 1) * (int(np.abs(c.astype(float)).max(initial=0)) + 1) * max(1, width)
    if largest >= 1 << 62:  # whole numbers of any size instead of 64 bits
        q, c = q.astype(object), c.astype(object)
    postings = [np.flatnonzero(c[:, t]) for t in range(width)]
    weights = [np.ascontiguousarray(c[rows, t]) for t, rows in enumerate(postings)]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = max(1, CELLS // len(c_ids))
    for at in range(0, len(q_ids), step):
        part, ids = q[at:at + step], q_ids[at:at + step]
        scores = np.zeros((len(ids), len(c_ids)), q.dtype)
        for t in range(width):
            has = np.flatnonzero(part[:, t])
            if not len(has) or not len(postings[t]):
                continue
            if len(postings[t]) == len(c_ids) and len(has) == len(ids):
                scores += part[:, t, None] * weights[t]
            else:
                scores[np.ix_(has, postings[t])] += part[has, t, None] * weights[t]
        for row, one in enumerate(ids):
            out.append(_select(scores[row], c_ids, one, k))
    score = np.concatenate([s for _, s, _ in out])
    if score.dtype == object:
        score = np.array([min(max(x, -(1 << 63)), (1 << 63) - 1) for x in score], np.int64)
    return pa.table({"query_id": pa.array(np.concatenate([np.full(len(i), one) for i, _, one in out]), pa.int64()),
                     "id": pa.array(np.concatenate([i for i, _, _ in out]), pa.int64()),
                     "score": pa.array(score, pa.int64())})


def _select(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple:
    """The k best by partition selection; ties at the border go to the smaller id."""
    other = ids != own
    if not other.all():
        scores, ids = scores[other], ids[other]
    if len(ids) > k:
        border = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = scores >= border
        scores, ids = scores[near], ids[near]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order], own
