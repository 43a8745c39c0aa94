"""The corpus pipeline: five operators in a row, each stage written as Parquet and reread.

Toxic documents go; of each group of near copies the one of smallest doc_id stays;
documents that hold a benchmark item go; what is left is mixed by source weight
(documents are repeated or left out as the mix says); the mix is written as token
ids, and the last stage returns what those files hold for each document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm import queries as q
from loadlens.llm.common import stored
from loadlens.llm.decontaminate import contaminated
from loadlens.llm.mixing import mixed_documents
from loadlens.llm.simhash import near_duplicates
from loadlens.llm.token_output import write_tokens
from loadlens.llm.toxicity import densities
from loadlens.session import scratch_path


def row_key() -> Column:
    """Stands for a row by its id and whole text, also where the id is null or repeats."""
    return F.xxhash64("doc_id", "text")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.7."""
    row = F.struct(*[docs[c] for c in docs.columns])
    scored = densities(docs.select(row.alias("row"), "text"), q.toxicity_model(spark, sf_dir), "row")
    return scored.where("score < 0.7").select("row.*")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 3 or fewer differing bits connect: the smallest doc_id.

    Of rows that repeat that id, or of a group without any id, the one of least row key stays.
    """
    marked = stored(near_duplicates(docs, words=3, limit=3, row_key=row_key()), "near-duplicates")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")
    first = marked.groupBy("root").agg(F.min(order).alias("least")).select("least.row_key")
    gone = marked.select("row_key").distinct().join(first, "row_key", "left_anti")  # by row, not by group: no key is hot
    repeated = stored(marked.groupBy("row_key").count().where("count > 1").select("row_key"), "repeated")
    left = docs.withColumn("row_key", row_key()).join(gone, "row_key", "left_anti")
    if not repeated.isEmpty():
        left = left.join(repeated, "row_key", "left_anti").unionByName(left.join(repeated, "row_key", "left_semi").dropDuplicates(["row_key"]))
    return left.select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = stored(contaminated(docs, q.table(spark, sf_dir, "benchmark")).select("row_key").distinct(), "contaminated")
    return docs.withColumn("row_key", row_key()).join(found, "row_key", "left_anti").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token files, then per document what they hold."""
    out = scratch_path(spark, "pipeline-tokens")
    write_tokens(docs, out, q.vocabulary(), 2)
    return q.token_digest(spark, out)


STAGES = [
    ("toxicity", toxicity),
    ("simhash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mixing),
    ("token-id / binary output", token_output),
]

#: Compression, hashing and tokenizing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)
