"""Sharding by a two-pass external shuffle. DataFrame functions only.

Pass one scatters whole records uniformly into memory-sized buckets by a seeded
hash of their id and writes them. Pass two brings each bucket into one task, puts it
in a fixed order, shuffles it (Spark's ``shuffle`` is a Fisher-Yates shuffle with a
seed) and writes it. The buckets one after another are a random order of all records;
shards are equal runs of it, so their row counts differ by one at most and slots
within a shard have no gaps.

The rows of a bucket that one id overfills are scattered over all buckets by row
number, so no task holds an unbounded group. The bytes of the table and ``bucket_bytes`` alone
give the number of buckets, and every bucket is a partition of its own; so the seed
fixes the result, not the cluster or the number of tasks. Only where an overfull
bucket's rows go depends on how the input is split.

Cases: a null text counts no bytes and crc32 0; null ids hash alike and are
scattered as any overfull bucket; repeated rows are placed each, rows of one id in the order of
their texts' hashes; an empty table gives empty files; all columns of the input, maps
too, are kept in a struct that is never compared, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadlens.llm.common import stored

#: Bytes of a bucket, and fixed bytes that each record counts beside its text.
BUCKET_BYTES, RECORD_BYTES = 16 << 20, 8
OVERFULL = 4
RUN = 4096


def record_size(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + RECORD_BYTES


def write_shards(docs: DataFrame, out: str, shards: int = 24, seed: int = 0, bucket_bytes: int = BUCKET_BYTES,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write whole records to ``out/shard=N``: struct ``row`` and ``slot``, its place in the shard."""
    rows = docs.select(F.col(id_col).alias("id"), record_size(text_col).alias("size"), F.xxhash64(text_col).alias("of_text"),
                       F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    total = rows.agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).first()
    buckets = max(-(-(total["b"] or 0) // bucket_bytes), 1)
    marked = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(buckets)).cast("int"))
    full = stored(marked.groupBy("bucket").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).where(
        (F.col("bytes") > OVERFULL * bucket_bytes) & (F.col("n") > 1)).select("bucket", F.lit(True).alias("full")), "shard-full")
    if not full.isEmpty():
        anew = F.pmod(F.xxhash64(F.lit(seed), "id", F.monotonically_increasing_id()), F.lit(buckets)).cast("int")
        marked = marked.withColumn("anew", anew).join(full, "bucket", "left").withColumn(
            "bucket", F.when(F.col("full"), F.col("anew")).otherwise(F.col("bucket"))).drop("anew", "full")
    scattered = stored(marked.withColumn("key", F.xxhash64(F.lit(~seed), "id")), "shard-buckets")
    starts = _starts(scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")))
    # the start of a bucket travels as one more row of it, so no join moves the records again
    both = scattered.select("bucket", "key", "id", "of_text", "row").unionByName(starts, allowMissingColumns=True)
    gathered = both.repartitionById(int(buckets), "bucket").groupBy("bucket").agg(
        F.max("start").alias("start"), F.collect_list("row").alias("rows"),
        F.collect_list(F.when(F.col("row").isNotNull(), F.struct("key", "id", "of_text"))).alias("keys"))
    ordered = F.sort_array(F.transform("keys", lambda k, i: F.struct(k["key"], k["id"], k["of_text"], i.alias("at"))))
    mixed = gathered.select("start", "rows", F.shuffle(ordered, seed).alias("order")).select(
        "start", F.transform("order", lambda o: F.get("rows", o["at"])).alias("records"))
    placed = mixed.select("start", F.posexplode("records").alias("at", "row"))
    n = max(1, total["n"])
    done = placed.select("row", (F.col("start") + F.col("at")).alias("pos")).withColumn(
        "shard", F.expr(f"cast((pos * {shards}L) div {n}L as int)")).withColumn(
        "slot", F.expr(f"pos - (shard * {n}L + {shards - 1}L) div {shards}L"))
    done.select("row", "slot", "shard").write.option("compression", "zstd").partitionBy("shard").parquet(out)


def _starts(counts: DataFrame) -> DataFrame:
    """First place of every bucket; runs of buckets are added up first, then inside the runs."""
    cut = counts.withColumn("run", F.floor(F.col("bucket") / RUN))
    runs = cut.groupBy("run").agg(F.sum("n").alias("of_run"))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("run", F.coalesce(F.sum("of_run").over(before), F.lit(0)).alias("run_start"))
    inside = Window.partitionBy("run").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return cut.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(runs, "run").select(
        "bucket", (F.col("run_start") + F.col("inside")).alias("start"))


def read_shards(spark: SparkSession, out: str, row_type: str) -> DataFrame:
    """``row, slot, shard`` from the files; ``row_type`` is the struct type of a record."""
    return spark.read.schema(f"row {row_type}, slot long, shard int").parquet(out)
