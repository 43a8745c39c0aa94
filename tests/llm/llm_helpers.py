"""Inputs shared by the tests of the corpus operators."""

from __future__ import annotations

from pyspark.sql import types as T

SF = "/root/testdata/sf0.01"
SF_TINY = "/root/testdata/sf0.001"

#: Names that the operators use inside.
CLASHING = ["id", "t", "size", "key", "row", "fp", "w", "n", "path", "host", "score", "shard", "slot", "bucket", "copies", "row_key"]

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in CLASHING]])

LONG = "lorem ipsum dolor sit amet, consectetur 12 km " * 20_000


def documents(sf: str = SF) -> list[tuple]:
    import duckdb
    return duckdb.connect().sql(f"SELECT doc_id, text, lang, source FROM '{sf}/documents.parquet' ORDER BY doc_id").fetchall()
