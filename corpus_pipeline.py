"""A corpus pipeline: quality, language, near copies, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows of the stage before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarryline.llm import language_id, near_copies, packing, quality
from quarryline.llm.common import pinned

# Mean probability of the best language over a document's letters. Chance is 0.25 with four languages; clean documents
# with lines in another learned language reach 0.43 and more.
LEAST_LANGUAGE_FIT = 0.4


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels beside the documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.train(docs, labels))


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; it learns from the documents' own language column."""
    return language_id.accepted(docs, language_id.train(docs), LEAST_LANGUAGE_FIT)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_copies.one_of_each(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bins of the remaining documents."""
    return packing.best_fit(docs)


STAGES = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_copies", drop_near_copies),
    ("packing", pack_documents),
]

# Trained models and fingerprints are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pinned(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
