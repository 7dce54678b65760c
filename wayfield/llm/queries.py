"""The numbered queries: thin digests of the operators over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (fingerprints, hard_negatives, html_text, jaccard, langid, mixing, packing, search, sharding,
               spelling, toxicity, vector_links, word_scoring)
from .common import remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


def held_out(modulus: int, rest: int):
    return F.coalesce(remainder("doc_id", modulus) == rest, F.lit(False)).alias("held_out")


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = langid.fit(docs.filter(remainder("doc_id", 4) != 2))
    return (langid.predict(docs.select("doc_id", "text"), net)
            .select("doc_id", held_out(4, 2), "lang_pred", "score"))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(docs, vocabulary).withColumnRenamed("doc", "doc_id").drop("source")


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out(5, 0), "score", "predicted")


@query
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.similarity_classes(docs).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"))


oracle("op4_ngram_jaccard_join", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (
  SELECT doc_id AS d, doc_id AS r FROM w
  UNION
  SELECT reach.d, link.b FROM reach JOIN link ON link.a = reach.r)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id
JOIN (SELECT d, min(r) AS c FROM reach GROUP BY d) m ON m.d = w.doc_id""")


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return (mixing.mix(docs).withColumn("row", F.explode(F.expr("sequence(1, copies_of)")))
            .select(F.col("doc").alias("doc_id"), "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).alias("taken")))


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    own, edited, following = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return fingerprints.fingerprinted(docs).select(
        F.col("id").alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        fingerprints.as_text(own).alias("fingerprint"),
        fingerprints.as_text(edited).alias("edited_fingerprint"),
        fingerprints.resemblance(own, edited).alias("near_edited"),
        fingerprints.resemblance(own, following).alias("near_next"))


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, 40).select(
        F.col("doc").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", "n_chars")


@query
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is what the labels call good."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return word_scoring.score(docs, good).select("doc_id", "n_tokens", "loss_target", "loss_background", "score")


@query
def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose id is divisible by 20 against all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return search.search(docs, docs.filter("doc_id % 20 = 0"), 10).select(
        F.col("query").alias("query_id"), "rank", F.col("doc").alias("doc_id"), "score")


oracle("op10_topk_search", r"""
WITH w AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) AS t FROM documents),
tf AS (SELECT doc_id, t, count(*) AS tf FROM w GROUP BY ALL),
len AS (SELECT doc_id, sum(tf) AS n FROM tf GROUP BY ALL),
g AS (SELECT count(*) AS n, (SELECT count(*) FROM w) / count(*) AS mean FROM documents),
df AS (SELECT t, count(*) AS df FROM tf GROUP BY ALL),
s AS (
  SELECT q.doc_id AS query_id, d.doc_id, round(sum(
    q.tf * ln(1 + (g.n - df.df + 0.5) / (df.df + 0.5))
    * d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * len.n / g.mean))), 6) AS score
  FROM tf q JOIN tf d ON q.t = d.t JOIN df ON df.t = q.t JOIN len ON len.doc_id = d.doc_id, g
  WHERE q.doc_id % 20 = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 10""")


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.spelling_groups(docs).select("word", "form", "root", "n", "n_near", "form_n")


oracle("op11_spelling_variants", r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM range(256) r(b)),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-zÀ-ÿ]+')) AS run FROM documents WHERE text IS NOT NULL),
counted AS (
  SELECT run, count(*) AS c, hex(encode(CAST(doc_id AS VARCHAR) || ':' || run)) AS x FROM runs GROUP BY doc_id, run),
hashed AS (
  SELECT run, c, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, len(x) // 2),
      lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
    lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1])), 4294967295) AS h FROM counted, crc_table),
edited AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2)
    ELSE run END AS word, c FROM hashed),
words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n FROM edited WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
shorter AS (
  SELECT DISTINCT word, n, i, left(word, i - 1) || substr(word, i + 1) AS d
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN shorter b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM shorter a JOIN words b ON a.d = b.word
  UNION
  SELECT b.word, a.word, a.n FROM shorter a JOIN words b ON a.d = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS best_n FROM pairs GROUP BY word),
named AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.best_n >= 10 * w.n THEN b.best_n END AS form_n,
    CASE WHEN b.best_n >= 10 * w.n THEN (SELECT min(p.near) FROM pairs p WHERE p.word = w.word AND p.near_n = b.best_n) END AS form
  FROM words w LEFT JOIN best b ON b.word = w.word),
walk AS (
  SELECT word, form, word AS at FROM named WHERE form IS NULL
  UNION ALL
  SELECT f.word, f.form, walk.at FROM walk JOIN named f ON f.form = walk.word)
SELECT n.word, n.form, k.at AS root, n.n, n.n_near, n.form_n FROM named n JOIN walk k ON k.word = n.word""")


@query
def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return vector_links.near_vectors(vectors, 0.98).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


oracle("op12_embedding_near_dedup", r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id AS d, vec_id AS r FROM embeddings
  UNION
  SELECT reach.d, link.b FROM reach JOIN link ON link.a = reach.r),
component AS (SELECT d, min(r) AS c FROM reach GROUP BY d),
linked AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, k.c AS component_id, e.vec_id = k.c AS kept
FROM embeddings e JOIN component k ON k.d = e.vec_id LEFT JOIN linked n ON n.a = e.vec_id""")


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    component = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    rows = vectors.filter(component).select("vec_id", moved.alias("label"), whole.alias("embedding"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
        F.col("negative").alias("negative_id"), "positive_score", "negative_score")


oracle("op13_hard_negatives", r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
n AS (
  SELECT p.a AS anchor_id, p.b AS positive_id, s.b AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.b) AS rank
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5""")
