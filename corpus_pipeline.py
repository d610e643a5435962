"""A corpus for training: documents through quality rules, language ID, near-dedup, secret redaction and packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns
of ``documents``.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from changeflow.llm import certified_packing, language_mixture, secret_forest, simhash_mih, weak_rules
from changeflow.llm.common import stored, table
from changeflow.session import configure


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base or are more likely bad than good go."""
    return weak_rules.good_rows(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language, or in which none leads, go."""
    return language_mixture.rows_with_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest id."""
    return simhash_mih.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by a mark."""
    return secret_forest.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens: a row per piece of a document with its sequence and place there."""
    return certified_packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))[0]


STAGES = [
    ("quality_rules", quality),
    ("language_id", language),
    ("simhash_near_dedup", near_dedup),
    ("secret_scans", secrets),
    ("best_fit_packing", packing),
]

# Fitted models and packing are not expressible in SQL; the tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
