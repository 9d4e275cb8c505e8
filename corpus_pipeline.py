"""A corpus made ready for training: rules, classifier, near-duplicates, secrets, packing.

Each stage takes a session, the documents that the stage before it kept, and the
data folder. All but the last give documents with the columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import nearduplicates, packing, qualitymodel, repetition, secretscan
from tallyworks.llm.queries import table, tokenizer_path
from tallyworks.llm.words import free_name
from tallyworks.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repetition rules and base rules keep."""
    return repetition.passing(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier, trained on the labelled ones among them, does not call bad."""
    return qualitymodel.accepted(docs, qualitymodel.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8 or more."""
    return nearduplicates.representatives(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; ``n_chars`` follows the text."""
    name = free_name(docs, "_clean")
    clean = secretscan.with_redacted(docs, secretscan.discovery_limit(docs), name)
    if "n_chars" in docs.columns:
        changed = F.coalesce(F.col(name) != F.col("text"), F.lit(False))
        clean = clean.withColumn("n_chars", F.when(changed, F.length(name).cast("long")).otherwise(F.col("n_chars")))
    return clean.withColumn("text", F.col(name)).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces, with their ids and their places in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path(), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

# Suffix arrays, a trained model, MinHash and a tokenizer can't be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace("_", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
