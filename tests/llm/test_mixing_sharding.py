"""Mixing and sharding: laws, targets, and plans without Python."""

from __future__ import annotations

import re
import zlib

import pytest
from pyspark.sql import functions as F

from llm_helpers import SF
from loadlens.llm import sharding
from loadlens.llm.mixing import mix, mixed_documents, shares, word_count
from loadlens.llm.queries import QUERIES, SQL
from loadlens.session import scratch_path


def water_fill(sizes: list[float], weights: list[float], budget: float, cap: float) -> list[float]:
    """Share by weight, stop at the cap, share the excess again until none is above."""
    target, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = budget
    while open_:
        level = left / sum(weights[i] for i in open_)
        over = {i for i in open_ if level * weights[i] >= cap * sizes[i]}
        if not over:
            for i in open_:
                target[i] = level * weights[i]
            break
        for i in over:
            target[i] = cap * sizes[i]
            left -= target[i]
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [[100, 200, 300, 50, 1], [10, 10, 10], [1000, 1, 1, 1], [0, 5, 0], [0, 0], [7]])
def test_targets_are_the_water_level(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", s, 1) for i, s in enumerate(sizes)], "source string, source_size long, n long")
    got = {r["source"]: r["target"] for r in shares(df, (3, 1, 2), 1.5, 2).collect()}
    expected = water_fill([float(s) for s in sizes], [(3, 1, 2)[i % 3] for i in range(len(sizes))], 1.5 * sum(sizes), 2)
    assert [got[f"s{i}"] for i in range(len(sizes))] == pytest.approx(expected)


def test_word_count_is_the_number_of_runs(spark, odd_docs):
    got = odd_docs.select("text", word_count("text").alias("size")).collect()
    assert all(r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in got)


def test_mix_takes_near_its_targets(spark):
    rows = QUERIES["op5_mixing"](spark, SF).collect()
    again = QUERIES["op5_mixing"](spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    taken, target, largest = {}, {}, max(r["size"] for r in rows)
    for r in rows:
        k = (r["source_size"], r["target"])
        taken[k] = taken.get(k, 0) + r["taken"]
        target[k] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] % max(1, r["size"]) == 0
    assert all(abs(taken[k] - target[k]) <= largest for k in taken)
    assert 0 <= 1.5 * sum(r["size"] for r in rows) - sum(taken.values()) <= largest


def test_op5_has_sql():
    assert "op5_mixing" in SQL


def test_mix_of_odd_rows(spark, odd_docs, no_docs):
    got = mix(odd_docs).collect()
    assert len(got) == odd_docs.count()
    assert all(r["copies"] == 0 for r in got if r["size"] == 0)
    out = mixed_documents(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == sum(r["copies"] for r in got)
    assert mix(no_docs).collect() == [] and mixed_documents(no_docs).collect() == []
    blank = odd_docs.where("text IS NULL OR trim(text) = ''")
    assert {r["copies"] for r in mix(blank).collect()} == {0}


def test_rows_of_one_id_and_size_are_taken_alike_in_reruns(spark):
    docs = spark.range(2000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"),
                                    F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("source"))
    a, b = (sorted(r["text"] for r in mixed_documents(d, weights=(1, 9), share=0.5).collect()) for d in (docs, docs.repartition(5)))
    assert a == b and len(a) == 1000


def shard_rows(spark, docs, **options):
    out = scratch_path(spark, "shards")
    sharding.write_shards(docs, out, **options)
    kind = f"struct<{','.join(f'{f.name}:{f.dataType.simpleString()}' for f in docs.schema.fields)}>"
    return sharding.read_shards(spark, out, kind)


def check_law(rows, shards, n):
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(s, ())) for s in range(shards)]
    assert sum(counts) == n and max(counts) - min(counts) <= 1


def test_op6_equal_counts_without_gaps(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op6_sharding"](spark, SF).collect()
    check_law(rows, 24, len(docs))
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {
        d: (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs.items()}
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]
    rising = sum(a < b for a, b in zip(order, order[1:]))
    assert 0.42 < rising / len(order) < 0.58  # no order of ids is left
    again = {r["doc_id"]: (r["shard"], r["slot"]) for r in QUERIES["op6_sharding"](spark, SF).collect()}
    assert again == {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}


def test_shards_do_not_depend_on_shuffle_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = {r["row"]["doc_id"]: (r["shard"], r["slot"]) for r in shard_rows(spark, docs, seed=3).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        b = {r["row"]["doc_id"]: (r["shard"], r["slot"]) for r in shard_rows(spark, docs.repartition(3), seed=3).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b and a != {r["row"]["doc_id"]: (r["shard"], r["slot"]) for r in shard_rows(spark, docs, seed=4).collect()}


def test_overfull_bucket_is_cut(spark):
    docs = spark.range(3000).select(F.when(F.col("id") < 2000, 1).otherwise(F.col("id")).alias("doc_id"),
                                    F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    rows = shard_rows(spark, docs, shards=7, bucket_bytes=2000).collect()
    check_law(rows, 7, 3000)
    assert len({r["row"]["text"] for r in rows}) == 3000
    buckets = {r["shard"] for r in rows if r["row"]["doc_id"] == 1}
    assert buckets == set(range(7))


def test_shards_of_odd_rows(spark, odd_docs, no_docs):
    rows = shard_rows(spark, odd_docs, shards=4).collect()
    check_law(rows, 4, odd_docs.count())
    assert sorted(map(repr, (r["row"] for r in rows))) == sorted(map(repr, odd_docs.collect()))
    assert shard_rows(spark, no_docs).collect() == []


@pytest.mark.parametrize("name", ["op5_mixing", "op6_sharding"])
def test_native_plans_hold_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_shards_do_not_depend_on_the_number_of_cores(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    placed = []
    for cores in (2, 4, 8):
        monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda self, n=cores: n))
        placed.append({r["row"]["doc_id"]: (r["shard"], r["slot"]) for r in shard_rows(spark, docs, bucket_bytes=1 << 18).collect()})
    assert placed[0] == placed[1] == placed[2] and len(placed[0]) == docs.count()


def test_shards_of_rows_with_a_map_column(spark):
    docs = spark.range(500).select(F.lit(1).alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"),
                                   F.create_map(F.lit("k"), F.col("id")).alias("extra"))
    rows = shard_rows(spark, docs, shards=3, bucket_bytes=1 << 20).collect()
    check_law(rows, 3, 500)
    assert sorted(r["row"]["extra"]["k"] for r in rows) == list(range(500))
    assert all(r["row"]["text"] == f"t{r['row']['extra']['k']}" for r in rows)
