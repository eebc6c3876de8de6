"""From raw documents to packed training sequences.

Language ID and the quality classifier drop the documents that they reject, the n-gram Jaccard
join leaves one document of each near-duplicate group, and packing turns the rest into token
sequences. Each stage works on everything its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyfold.llm import jaccard, language, quality, queries
from tallyfold.llm.common import prepared, table
from tallyfold.session import tune, written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: not null, with letters, and not rejected by the models."""
    prepared(tune(spark))
    return language.accepted(docs, language.fitted(docs))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score above the classifier's cutoff, learned from ``labels``."""
    prepared(tune(spark))
    return quality.accepted(docs, quality.fitted(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: shingles of five words, similarity of 0.8 or more."""
    prepared(tune(spark))
    return jaccard.one_each(docs, jaccard.join(docs, words=5, p=8, q=10))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, as in the query for all documents."""
    prepared(tune(spark))
    return queries.packed_pieces(docs)


STAGES = [
    ("language_id", language_stage),
    ("quality_classifier", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

#: The models have no SQL form; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
