"""Helpers shared by the corpus operators: scratch tables, hash tests, prefix sums, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadlens.session import delete_path, scratch_path

#: ASCII white space, the separator of the word-based contracts.
SPACE = r"\x20\x09-\x0D"
SPACE_CHARS = " \t\n\x0b\f\r"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Lineage ends at the files, so a lost executor never recomputes what came
    before, and both reads of a table that is used twice see the same rows.
    """
    return _written(df, scratch_path(df.sparkSession, name))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds`` (null keys: fold 0)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(0))


def prefix_totals(counts: DataFrame, order: str, value: str, out: str, by: list[str] | None = None) -> DataFrame:
    """Exclusive running total of ``value`` in the order of ``order`` (per ``by``).

    ``counts`` holds one row for each partition or bucket, not for each record,
    so the window works on a table of some thousand times fewer rows.
    """
    w = Window.partitionBy(*(by or [])).orderBy(order)
    total = F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return counts.withColumn(out, F.coalesce(total, F.lit(0)).cast("long"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected edge list ``(a, b)`` of longs.

    Alternating large-star and small-star rounds; every round is a group-by with
    map-side minima and one equi-join, written to the shared folder. Returns
    ``(node, root)`` with the smallest node of each component as root, for all
    nodes that have an edge. Null ends and self loops are ignored.
    """
    e = edges.select("a", "b").where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    spark = edges.sparkSession
    path = scratch_path(spark, "edges")
    e = _written(e, path)
    mark = _edge_mark(e)
    while True:
        before, path = path, scratch_path(spark, "edges")
        e = _written(_star(_star(e, large=True), large=False), path)
        delete_path(spark, before)  # a round needs only the one before
        now = _edge_mark(e)
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = now


def _edge_mark(e: DataFrame) -> tuple:
    row = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return (row["n"], row["h"])


def _star(e: DataFrame, large: bool) -> DataFrame:
    """One star round over edges (u > v). Large: larger neighbours move to the least
    of a node and its neighbours; small: a node and its smaller neighbours move there."""
    near = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    both = near.join(least, "u")
    if large:
        out = both.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = both.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
