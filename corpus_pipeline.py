"""Corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

quality classifier: documents that it rejects go. n-gram Jaccard join: of each group of similar
documents the one with the least id stays. PII: personal data is replaced by marks. Mixing:
documents are sampled towards even sources, languages and topics. Packing: the last stage gives
a row for each packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from engagelake.llm import mixing, ngram_join, packing, pii, quality, shared


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality.kept_by_quality(docs, quality.train(docs, shared.table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of similar ones."""
    return ngram_join.one_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by marks."""
    shared.small_batches(spark)
    return pii.redacted(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples three quarters of the tokens towards the target mix."""
    return mixing.sampled(docs, token_share=0.75)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the rest into sequences of at most 1024 tokens."""
    return packing.best_fit_pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("PII", pii_stage),
    ("mixing sources to target weights", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: SQL cannot express the stages; tests/llm/test_pipeline.py holds them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared.table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        before, since = docs, shared.mark()
        docs = shared.written(stage(spark, before, sf_dir))
        shared.sweep(spark, since, keep=docs)  # a stage's own tables, and its input, are not read again
        if vars(before).get("written_to"):
            shared.dropped(spark, before)
    return docs
