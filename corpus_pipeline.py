"""Corpus pipeline: documents to packed training sequences.

Every stage takes the documents that its predecessor kept, with the columns
of ``documents``; the last one returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leakwatch.llm import language_mixture, ngram_join, packing, quality_rules, substring_dedup
from leakwatch.llm.queries import tokenizer
from leakwatch.llm.tables import written

#: Language models, packing and the removal of passages have no SQL form.
ORACLE_SQL = None
#: A text whose main language has a smaller share is rejected.
MIN_SHARE = 0.5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.accepted(docs, "text", "lang")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with one main language, which becomes their ``lang``; the
    languages are learned from the documents that name one."""
    model = language_mixture.learn(docs, "text", "lang")
    found = language_mixture.predict(docs, model, "text")
    found = found.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SHARE))
    return found.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    groups = ngram_join.jaccard_groups(docs, "doc_id", "text", k=5, percent=75)
    return ngram_join.keep_first(docs, groups, "doc_id", "text")


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 13 words and more that stand in an earlier one."""
    cut = substring_dedup.remove_repeated(docs, "doc_id", "text", window=13)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens, one row per piece."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), "doc_id", "text", capacity=4096)


STAGES = [
    ("quality rules", quality),
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", passages),
    ("packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
