"""The corpus pipeline: one stage per operator, each on what its predecessor kept.

Every stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read
again as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfield.llm import jaccard, langid, mixing, packing, toxicity
from wayfield.llm.common import remainder, table, written

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LEAST_LANGUAGE_SCORE = 0.4


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half; NULL texts have no toxic word and stay."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, prefix="__").filter("__predicted = 0").select(*docs.columns)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters for which some language has a score of 0.4 or more."""
    net = langid.fit(docs.filter(remainder("doc_id", 4) != 2))
    good = (F.col("__lang_pred") != langid.UNKNOWN) & (F.col("__score") >= LEAST_LANGUAGE_SCORE)
    return langid.predict(docs, net, prefix="__").filter(good).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every similarity class, that of the smallest id (NULL last). Rows are told apart by a
    number of their own, so rows that share an id, or have none, are judged by their texts like all
    others. Rows without words are in no class and stay."""
    numbered = written(docs.withColumn("__row", F.monotonically_increasing_id()), "pipeline-rows")
    classes = jaccard.similarity_classes(numbered, id_col="__row")
    ids = numbered.select(F.col("__row").alias("doc"), F.col("doc_id").isNull().alias("without"), "doc_id")
    least = F.min(F.struct("without", "doc_id", "doc")).alias("least")
    kept = classes.join(ids, "doc").groupBy("component").agg(least).select(F.col("least.doc").alias("__row"))
    return numbered.join(kept, "__row", "left_semi").drop("__row")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of the sources takes it."""
    return mixing.apply_mix(docs, mixing.mix(docs))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2,048 tokens, see ``op2_packing``."""
    return packing.pack(docs, VOCABULARY).withColumnRenamed("doc", "doc_id").drop("source")


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", keep_languages),
    ("n-gram Jaccard join", keep_one_of_each),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_windows),
]

# trained models decide which rows stay, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
