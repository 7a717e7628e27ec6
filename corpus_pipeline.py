"""A corpus pipeline: each stage calls one operator on all that its predecessor kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm import decontaminate, langid, mixing, neardup, sharding
from rasterloom.llm.shared import dropped, written

#: Below this calibrated probability a language counts as not recognised.
MIN_SCORE = 0.5
SHARDS = 40


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go: null and empty texts, those without letters, and those of a low score.

    Repeated rows share their fate, ties go to the first language by name; without labelled rows, or without rows, none stay.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "text", "lang")
    named = langid.identified(rows)
    return named.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE)).select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: five words a shingle, similarity 0.8.

    It is that of the least doc_id (null last), of equal ids that of the least text hash, of rows alike in both any one.
    Null, empty and blank texts are linked with nothing and stay; no rows give none.
    """
    return neardup.one_of_each(docs, shingle_words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go; null and empty texts stay, and all do where the benchmark is empty. Each row is
    judged by its own text, repeated rows alike."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10, k=5)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order: repeated rows each for itself, texts without words (null
    and empty ones) never, no rows give none."""
    return mixing.mixed_documents(docs, weights=(5, 2, 1), share=1.5, most=2.0)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its slot in it; null texts and ids are rows like any other, rows alike in id and text take
    their places among themselves in any order, no rows give none."""
    return sharding.sharded_documents(docs, shards=SHARDS, law="bytes")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_sources),
    ("sharding", shards),
]

#: The stages' models and signatures can't be expressed in SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; an empty table gives an empty one, further columns come along."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        dropped(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
