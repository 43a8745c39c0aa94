"""Mixing sources to target weights by weighted fair queueing. DataFrame functions only.

The documents of each source are put in a random order that a seeded hash of their
id fixes. A document's virtual finish time is the running number of words of its
source, itself included, divided by its source's target; further copies of it queue
behind the whole source. All copies are range-sorted by finish time and taken until
the total budget is reached, so at any point every source has got its share.

Running totals need no group in one task: each source's order is cut into buckets
by hash, a window adds up inside a bucket, and a table with a row for each bucket
holds what came before. The cut is found the same way, over the range partitions.

Cases: a null or empty text has size 0 and is never taken; a null source is one
source, last in order; a null id hashes as the empty text; rows that repeat an id
queue one after another, by size and hash of the text, so reruns agree; if all sizes are 0 nothing is taken; an empty table gives
no rows; other columns travel in one struct, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.llm.common import SPACE, SPACE_CHARS, prefix_totals, stored

#: Documents of a bucket, about.
BUCKET_ROWS = 8192


def word_count(text: str | Column) -> Column:
    """Number of maximal runs of other than ASCII white space; null: 0."""
    trimmed = F.btrim(F.col(text) if isinstance(text, str) else text, F.lit(SPACE_CHARS))
    return F.coalesce(F.length(F.regexp_replace(trimmed, f"[^{SPACE}]+[{SPACE}]*", "x")), F.lit(0)).cast("long")


def shares(sizes: DataFrame, weights: Sequence[int], share: float, cap: int) -> DataFrame:
    """Targets of sources: ``sizes`` has ``source, source_size, n``; adds ``sid, target``.

    Sources by code point, null last, weigh ``weights`` in turn. Together they get
    ``share`` times all words; none gets over ``cap`` times its own, and what that
    frees goes to the others by weight. With sources in order of cap / weight, the
    common level is the largest of those that fill the sources before to the cap.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1).cast("int"))
    s = sizes.withColumn("sid", F.row_number().over(place)).withColumn("w", w).withColumn(
        "most", F.lit(float(cap)) * F.col("source_size"))
    every = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("w"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.lit(float(share)) * F.sum("source_size").over(every).cast("double")
    level = (budget - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (
        F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    return s.withColumn("level", level).withColumn("top", F.max("level").over(every)).select(
        "sid", "source", "source_size", "n", F.least("most", F.col("top") * F.col("w")).alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: float = 1.5, cap: int = 2, seed: str = "mix-0",
        keep_rows: bool = False, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """What the mix takes of every document: ``id, size, source_size, target, copies``.

    ``keep_rows`` adds the whole input row as struct ``row``.
    """
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    sized = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("size"), key.alias("key"),
        F.xxhash64(text_col).alias("of_text"),
        *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if keep_rows else []))
    if not keep_rows:
        sized = stored(sized, "mix-sizes")
    targets = stored(shares(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")),
                            weights, share, cap), "mix-targets")
    budget = share * (targets.agg(F.sum("source_size")).first()[0] or 0)
    part = (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.ceil(F.col("n") / BUCKET_ROWS) / F.lit(1 << 32)).cast("long")
    placed = sized.join(targets, sized["source"].eqNullSafe(targets["source"])).drop(targets["source"]).withColumn("bucket", part)
    totals = placed.groupBy("sid", "bucket").agg(F.sum("size").alias("in_bucket"))
    starts = prefix_totals(totals, "bucket", "in_bucket", "before", ["sid"]).drop("in_bucket")
    queue = Window.partitionBy("sid", "bucket").orderBy("key", "id", "size", "of_text").rowsBetween(Window.unboundedPreceding, 0)
    queued = placed.withColumn("inside", F.sum("size").over(queue)).join(starts, ["sid", "bucket"]).withColumn(
        "words", F.col("before") + F.col("inside")).drop("before", "inside", "bucket", "n", "of_text")
    queued = stored(queued, "mix-queues")
    refused = _first_refused(queued, budget, cap)

    def taken(copy: int) -> Column:
        return (F.lit(True) if refused is None else
                F.struct(_finish(copy), F.col("key"), F.col("sid"), F.lit(copy)) <
                F.struct(F.lit(refused[0]), F.lit(refused[1]), F.lit(refused[2]), F.lit(refused[3])))

    copies = sum((F.when((F.col("size") > 0) & taken(c), 1).otherwise(0) for c in range(cap)), F.lit(0))
    return queued.withColumn("copies", copies).select(
        "id", "size", "source_size", "target", "copies", *(["row"] if keep_rows else []))


def _finish(copy: int) -> Column:
    """Virtual finish time of a copy: words of its source up to it, over the target."""
    return (F.lit(copy) * F.col("source_size") + F.col("words")).cast("double") / F.col("target")


def _first_refused(queued: DataFrame, budget: float, cap: int) -> tuple | None:
    """The first copy, in order of finish time, that no longer fits the budget; None if all fit."""
    entries = queued.where("size > 0").select("size", "key", "sid", F.inline(F.array(*[
        F.struct(_finish(c).alias("finish"), F.lit(c).alias("copy")) for c in range(cap)])))
    order = ["finish", "key", "sid", "copy"]
    ranged = stored(entries.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "mix-order")
    parts = prefix_totals(ranged.groupBy("part").agg(F.sum("size").alias("n")), "part", "n", "before")
    cut = parts.where((F.col("before") + F.col("n") > budget) & (F.col("before") <= budget)).orderBy("part").first()
    if cut is None:
        return None
    upto = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    late = ranged.where(F.col("part") == cut["part"]).withColumn("upto", F.sum("size").over(upto) + F.lit(cut["before"])).where(
        F.col("upto") > budget)
    return tuple(late.agg(F.min(F.struct(*order)).alias("least")).first()["least"])


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The input rows that the mix takes, each as often as it is taken."""
    rows = mix(docs, keep_rows=True, **options).where("copies > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
