"""Corpus pipeline: quality classifier, quality rules, near-duplicate removal, packing.

Each stage takes and returns documents with all their columns; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vintora.llm import ngram_join, packing, quality_knn, quality_rules
from vintora.llm.common import read
from vintora.sources.workspace import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones."""
    return quality_knn.keep_documents(docs, read(spark, sf_dir, "labels"))


def line_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the word, repetition and template-line rules, without their template lines."""
    return quality_rules.clean_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word shingle sets with a similarity of 0.8 or more."""
    return ngram_join.keep_representatives(docs, n=5, percent=80)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, placed in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", line_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("best_fit_packing", best_fit_packing),
]

#: The classifier and the tokenizer have no SQL form; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written before the next one reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
