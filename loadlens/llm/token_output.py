"""Token ids written as directly addressable codes.

Every id is cut into chunks of ``CHUNK`` bits. Level 0 holds the lowest chunk of
each id, level 1 the next chunk of those ids that go on, and so forth. A level has
a bitmap that says which of its ids go on, and a rank directory with the number of
set bits before every ``STEP`` bits. Token i is read from level 0 at i; while the
bitmap is set, its place in the next level is the rank of its place in this one.
No other token is decoded.

Files are Parquet: a row is a block of consecutive documents, with their ids and
ends, the number of ids before it in its part and, for every level, the chunks, the bitmap and the rank directory. Documents
lie in ascending order of their id (null first), equal ids by hash of the text.

Cases: null and empty texts hold the end id alone; repeated rows are written each;
an empty table makes an empty set of files; one very long text is one large block;
only the two named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm.common import prefix_totals
from loadlens.llm.pretokens import batch_encoder, kept, whole_tokens
from loadlens.llm.texts import cut_by_bytes

#: Bits of a chunk, bits between two entries of a rank directory, tokens after which a block ends.
CHUNK, STEP, BLOCK_TOKENS = 8, 512, 1 << 18

FILE_SCHEMA = ("part int, before long, n_tokens long, doc_ids array<long>, doc_ends array<long>, "
               "chunks array<binary>, bitmaps array<binary>, ranks array<binary>")


def encode_levels(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Chunks, continuation bitmaps and rank directories, level by level."""
    chunks, bitmaps, ranks = [], [], []
    rest = np.asarray(ids, np.uint32)
    while True:
        chunks.append((rest & ((1 << CHUNK) - 1)).astype(np.uint8).tobytes())
        more = (rest >> CHUNK) > 0
        bitmaps.append(np.packbits(more, bitorder="little").tobytes())
        before = np.add.reduceat(more, np.arange(0, len(more), STEP), dtype=np.uint32) if len(more) else np.zeros(0, np.uint32)
        ranks.append((np.cumsum(before, dtype=np.uint32) - before).astype("<u4").tobytes())
        if not more.any():
            return chunks, bitmaps, ranks
        rest = rest[more] >> CHUNK


def rank(bitmap: bytes, directory: bytes, place: int) -> int:
    """Number of set bits before ``place``: one directory entry and at most ``STEP`` bits."""
    start = place // STEP
    base = int.from_bytes(directory[4 * start:4 * start + 4], "little")
    word = int.from_bytes(bitmap[start * STEP // 8:place // 8 + 1], "little")
    return base + (word & ((1 << (place - start * STEP)) - 1)).bit_count()


def token_at(chunks: list[bytes], bitmaps: list[bytes], ranks: list[bytes], place: int) -> int:
    """The id at ``place`` of a block, without decoding any other."""
    value = 0
    for level, chunk in enumerate(chunks):
        value |= chunk[place] << (CHUNK * level)
        if not bitmaps[level][place // 8] >> (place % 8) & 1:
            break
        place = rank(bitmaps[level], ranks[level], place)
    return value


def decode_levels(chunks: list[bytes], bitmaps: list[bytes]) -> np.ndarray:
    """All ids of a block."""
    value = np.zeros(0, np.uint32)
    for chunk, bitmap in zip(reversed(chunks), reversed(bitmaps), strict=True):
        low = np.frombuffer(chunk, np.uint8).astype(np.uint32)
        more = np.unpackbits(np.frombuffer(bitmap, np.uint8), count=len(low), bitorder="little").astype(bool)
        if more.any():
            low[more] |= value << CHUNK
        value = low
    return value


def with_ends(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts with ``end_id`` behind each text, and where each text then ends."""
    upto = ends + np.arange(1, len(ends) + 1)
    out, own = np.empty(upto[-1] if len(upto) else 0, np.uint32), np.ones(upto[-1] if len(upto) else 0, bool)
    own[upto - 1] = False
    out[own], out[~own] = ids, end_id
    return out, upto


def write_tokens(docs: DataFrame, out: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text with the vocabulary file ``path``, add ``end_id``, write the files to ``out``."""
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = kept("ids", path, lambda: batch_encoder(path, whole.value))
        part, before, names, ends, data, n = TaskContext.get().partitionId(), 0, [], [], [], 0

        def row() -> pa.RecordBatch:
            chunks, bitmaps, ranks = encode_levels(np.concatenate(data))
            one = {"part": part, "before": before, "n_tokens": n, "doc_ids": names, "doc_ends": ends,
                   "chunks": chunks, "bitmaps": bitmaps, "ranks": ranks}
            return pa.RecordBatch.from_pylist([one], _arrow_schema())

        for batch in batches:
            for piece in cut_by_bytes(batch, 1, 8 << 20):
                ids, upto = with_ends(*encode(piece.column(1)), end_id)
                keys, at, base = piece.column(0).to_pylist(), 0, 0
                while at < len(keys):  # documents up to the one that fills the block
                    to = min(int(np.searchsorted(upto, base + BLOCK_TOKENS - n)) + 1, len(keys))
                    names += keys[at:to]
                    ends += (upto[at:to] - base + n).tolist()
                    data.append(ids[base:upto[to - 1]])
                    n, at, base = ends[-1], to, int(upto[to - 1])
                    if n >= BLOCK_TOKENS:
                        yield row()
                        before, names, ends, data, n = before + n, [], [], [], 0
        if names:
            yield row()

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("t"))
    ordered = plain.withColumns({"h": F.xxhash64("t"), "m": F.monotonically_increasing_id()}).repartitionByRange(
        "id", "h", "m").sortWithinPartitions("id", "h", "m").select("id", "t")
    ordered.mapInArrow(run, FILE_SCHEMA).write.option("compression", "zstd").parquet(out)


def _arrow_schema() -> pa.Schema:
    many = pa.list_(pa.binary())
    return pa.schema([("part", pa.int32()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                      ("doc_ends", pa.list_(pa.int64())), ("chunks", many), ("bitmaps", many), ("ranks", many)])


def open_tokens(spark: SparkSession, out: str) -> DataFrame:
    """The blocks of a set of files, with ``start``, the number of ids in all blocks before."""
    blocks = spark.read.schema(FILE_SCHEMA).parquet(out)
    sizes = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = prefix_totals(sizes, "part", "n", "part_start").drop("n")  # a row for each range partition of the writer
    return blocks.join(F.broadcast(parts), "part").withColumn("start", F.col("part_start") + F.col("before")).drop("part_start")


def read_documents(spark: SparkSession, out: str) -> DataFrame:
    """Per document from the files: ``id, start, n_tokens, ids`` (32-bit little-endian bytes)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                ids = decode_levels(block["chunks"], block["bitmaps"]).astype("<u4")
                ends = np.array(block["doc_ends"], np.int64)
                firsts = np.concatenate([[0], ends[:-1]])
                yield pa.record_batch([
                    pa.array(block["doc_ids"], pa.int64()), pa.array(firsts + block["start"], pa.int64()),
                    pa.array(ends - firsts, pa.int64()),
                    pa.array([ids[a:b].tobytes() for a, b in zip(firsts, ends, strict=True)], pa.binary())],
                    ["id", "start", "n_tokens", "ids"])

    blocks = open_tokens(spark, out).select("start", "doc_ids", "doc_ends", "chunks", "bitmaps")
    return blocks.mapInArrow(run, "id long, start long, n_tokens long, ids binary")


def read_tokens(spark: SparkSession, out: str, places: DataFrame) -> DataFrame:
    """The ids at global places (``place`` long): ``place, token``, each by direct access in its block.

    Places outside the files, and null, are left out.
    """
    blocks = open_tokens(spark, out).select("start", "n_tokens", "chunks", "bitmaps", "ranks")
    width = F.lit(BLOCK_TOKENS)
    cells = blocks.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("start") / width), F.floor((F.col("start") + F.col("n_tokens") - 1) / width))))
    asked = places.select(F.col("place").cast("long").alias("place")).where("place >= 0").withColumn(
        "cell", F.floor(F.col("place") / width))
    met = asked.join(cells, "cell").where("place >= start AND place < start + n_tokens").withColumn(
        "at", F.col("place") - F.col("start"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            yield pa.record_batch([
                batch.column(0), pa.array([token_at(r["chunks"], r["bitmaps"], r["ranks"], r["at"]) for r in rows], pa.int64())],
                ["place", "token"])

    return met.select("place", "at", "chunks", "bitmaps", "ranks").mapInArrow(run, "place long, token long")
