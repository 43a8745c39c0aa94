"""The registered query of each corpus operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlens.llm import langid
from loadlens.llm.alignment import aligned_corpus
from loadlens.llm.common import crc_fold
from loadlens.llm.decontaminate import contaminated
from loadlens.llm.ledger import POLICIES, rejected, with_policy, write_ledger
from loadlens.llm.mixing import mix
from loadlens.llm.sharding import read_shards, record_size, write_shards
from loadlens.llm.simhash import hex_digits, near_duplicates
from loadlens.llm.spelling import text_variants
from loadlens.llm.styletree import main_text
from loadlens.llm.token_count import token_counts
from loadlens.llm.token_output import read_documents, write_tokens
from loadlens.llm.toxicity import densities, learn
from loadlens.llm.topk import integer_codes, top_k, usable
from loadlens.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def token_digest(spark: SparkSession, out: str) -> DataFrame:
    return read_documents(spark, out).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def toxicity_model(spark: SparkSession, sf_dir: str):
    """Learnt from all labelled documents but those held out (crc32 of the id modulo 3 is 1)."""
    return learn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_fold(F.col("doc_id"), 3) != 1)


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document by the learnt lexicon."""
    scored = densities(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))
    return scored.select("doc_id", (crc_fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_words", "n_matches", "density")


@query
def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best inner products of every 50th vector against all others."""
    rows = table(spark, sf_dir, "embeddings").where(usable("embedding")).select(
        "vec_id", integer_codes("embedding").alias("codes"))
    return top_k(rows, F.col("vec_id") % 50 == 0, 5)


@query
def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as directly addressable codes in files, then per document what the files hold."""
    out = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), out, vocabulary(), 2)
    return token_digest(spark, out)


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it is over 2048 tokens."""
    return token_counts(table(spark, sf_dir, "documents"), vocabulary()).withColumn(
        "over_limit", F.col("n_tokens") > 2048)


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents by source weight takes from each."""
    return mix(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shuffled shards of equal row counts, as the shard files hold them."""
    docs, out = table(spark, sf_dir, "documents"), scratch_path(spark, "shards")
    write_shards(docs, out, shards=24)
    text = F.coalesce(F.col("row.text"), F.lit(""))
    row_type = f"struct<{','.join(f'{f.name}:{f.dataType.simpleString()}' for f in docs.schema.fields)}>"
    return read_shards(spark, out, row_type).select(
        F.col("row.doc_id").alias("doc_id"), record_size("row.text").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learnt from all but those held out (crc32 of the id modulo 4 is 2)."""
    docs = table(spark, sf_dir, "documents")
    model = langid.learn(docs, crc_fold(F.col("doc_id"), 4) != 2)
    return langid.languages(docs, model).select(
        "doc_id", (crc_fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score", "margin", "rejected")


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, re-parameterised or not, with the item."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "n_windows", "n_found", "containment", "new_values")


@query
def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; links at 3 or fewer differing bits."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, limit=3).select(
        "doc_id", hex_digits().alias("fingerprint"), "component_id")


@query
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measurements and verdict, from a written ledger of rule bits."""
    out = scratch_path(spark, "ledger")
    write_ledger(table(spark, sf_dir, "documents"), out)
    base = rejected(POLICIES["base", 1])
    return with_policy(spark.read.parquet(out), POLICIES["clean", 1]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", "failed", "n_lines", "n_capital_words", "n_marks", "n_letter_words", "n_echo_words")


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers over every document."""
    done = aligned_corpus(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    return done.select(F.col("id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                       "groups_sha256")


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents with their near words, written forms and roots."""
    return text_variants(table(spark, sf_dir, "documents"))


SQL["op2_exact_topk"] = """
WITH codes AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.c, c.c) AS BIGINT) AS score
  FROM codes q JOIN codes c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""

SQL["op5_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         md5('mix-0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
s AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM s),
w AS (SELECT *, CAST([3, 1, 2][(sid - 1) % 3 + 1] AS DOUBLE) AS w, 2 * CAST(source_size AS DOUBLE) AS most FROM r),
l AS (
  SELECT *, (1.5::DOUBLE * CAST((SELECT sum(source_size) FROM w) AS DOUBLE) - coalesce(sum(most) OVER o, 0))
            / ((SELECT sum(w) FROM w) - coalesce(sum(w) OVER o, 0)) AS level
  FROM w WINDOW o AS (ORDER BY most / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT sid, source, source_size, least(most, (SELECT max(level) FROM l) * w) AS target FROM l),
q AS (
  SELECT d.*, t.sid, t.source_size, t.target,
         sum(size) OVER (PARTITION BY sid ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS words
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (
  SELECT *, CAST(copy * source_size + words AS DOUBLE) / target AS finish
  FROM q CROSS JOIN (SELECT unnest([0, 1]) AS copy) WHERE size > 0),
g AS (
  SELECT *, sum(size) OVER (ORDER BY finish, key, sid, copy ROWS UNBOUNDED PRECEDING) AS upto FROM e),
k AS (
  SELECT doc_id, key, source_size, size, words, CAST(sum(CASE WHEN CAST(upto AS DOUBLE)
         <= 1.5::DOUBLE * CAST((SELECT sum(size) FROM d) AS DOUBLE) THEN 1 ELSE 0 END) AS INTEGER) AS copies
  FROM g GROUP BY ALL)
SELECT q.doc_id, CAST(q.size AS BIGINT) AS size, CAST(q.source_size AS BIGINT) AS source_size, q.target,
       CAST(q.size * coalesce(k.copies, 0) AS BIGINT) AS taken, coalesce(k.copies, 0) AS copies
FROM q LEFT JOIN k ON q.key = k.key AND q.source_size = k.source_size AND q.words = k.words AND q.size = k.size AND q.size > 0
"""

SQL["op11_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT r, doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         length(regexp_replace(t, '[^!?]+', '', 'g')) AS n_marks,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
u AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM m),
win AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c, x, e) AS n
  FROM (SELECT r, i, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c, lead(word, 3) OVER o AS x,
               lead(word, 4) OVER o AS e
        FROM u WINDOW o AS (PARTITION BY r ORDER BY i)) WHERE e IS NOT NULL),
rep AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words
  FROM win, (SELECT unnest(range(5)) AS k) WHERE n >= 2 GROUP BY r),
f AS (
  SELECT m.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         coalesce(list_max(list_transform(w, lambda x: length(x))), 0) AS longest_word,
         len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_letter_words,
         len(list_filter(w, lambda x: regexp_matches(x, '[A-Z].*[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_capital_words,
         n_symbols, n_marks, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echo_words
  FROM m LEFT JOIN rep USING (r)),
j AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
    CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END + CASE WHEN n_dup_lines > 2 AND 100 * n_dup_lines > 30 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words) THEN 16 ELSE 0 END
    + CASE WHEN 100 * n_capital_words > 50 * n_words THEN 32 ELSE 0 END + CASE WHEN 100 * n_marks > 50 * n_words THEN 64 ELSE 0 END
    + CASE WHEN 100 * n_letter_words < 50 * n_words THEN 128 ELSE 0 END
    + CASE WHEN longest_word > 1000 THEN 256 ELSE 0 END + CASE WHEN 100 * n_echo_words > 30 * n_words THEN 512 ELSE 0 END AS failed
  FROM f)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       failed & 751 = 0 AS kept, failed::BIGINT AS failed, n_lines::BIGINT AS n_lines,
       n_capital_words::BIGINT AS n_capital_words, n_marks::BIGINT AS n_marks, n_letter_words::BIGINT AS n_letter_words,
       n_echo_words::BIGINT AS n_echo_words
FROM j
"""

SQL["op13_spelling_variants"] = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
         lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
  FROM documents),
once AS (SELECT id, run, count(*) AS k, hex(id || ':' || run) AS x FROM runs WHERE length(run) >= 5 GROUP BY id, run),
hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(1, length(x), 2), lambda i:
             (strpos('0123456789ABCDEF', x[i]) * 16 + strpos('0123456789ABCDEF', x[i + 1]) - 17)::BIGINT)),
           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) AS h
  FROM once, tab),
v AS (
  SELECT word, sum(k)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
gap AS (SELECT word, n, i, left(word, i) AS a, substr(word, i + 2) AS b FROM (SELECT *, unnest(range(length(word))) AS i FROM v)),
pairs AS (
  SELECT x.word, y.word AS near, y.n AS near_n FROM gap x JOIN gap y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT g.word, v.word, v.n FROM gap g JOIN v ON v.word = g.a || g.b
  UNION SELECT v.word, g.word, g.n FROM gap g JOIN v ON v.word = g.a || g.b),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS m, arg_min(near, (-near_n, near)) AS near FROM pairs GROUP BY word),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * v.n THEN near END AS form, CASE WHEN m >= 2 * v.n THEN m END AS form_n
  FROM v LEFT JOIN best USING (word)),
walk(word, spot) AS (
  SELECT word, word FROM f UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.spot WHERE f.form IS NOT NULL),
ends AS (SELECT walk.word, walk.spot AS root FROM walk JOIN f ON f.word = walk.spot WHERE f.form IS NULL)
SELECT f.word, f.form, ends.root, f.n, f.n_near, f.form_n FROM f JOIN ends ON ends.word = f.word
"""
