"""Documents to training sequences: each stage works on all that the one before it kept.

Stages are functions of (spark, docs, sf_dir). A stage's result is written as Parquet and
read again as the next one's docs, so that a lost executor costs one stage's work at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterflow.llm import jaccard_groups, language_ecoc, packing_mixture, quality_gbt, secrets_entropy
from meterflow.llm.common import kept, table, tokenizer_file


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that boosted trees, learned from labels, don't reject."""
    return quality_gbt.keep_good(docs, quality_gbt.train(docs, table(spark, sf_dir, "labels")))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose language is found, not ambiguous, and better told than an empty text's."""
    model = language_ecoc.train(docs)
    return language_ecoc.keep_known(docs, model, lead=language_ecoc.LEAD, loss=model.blank_loss())


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near copies."""
    return jaccard_groups.one_of_each(docs)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts by a mark; every document stays."""
    return secrets_entropy.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all texts into sequences with the sources' proportions."""
    return packing_mixture.pack(docs, tokenizer_file("word_bpe_49k.json"), run=packing_mixture.RUN)


STAGES = [
    ("quality classifier", good_quality),
    ("language id", known_language),
    ("n-gram Jaccard join", one_of_near_copies),
    ("secret scans", no_secrets),
    ("packing", packed),
]

#: Trained models and tokens have no SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = kept(docs, name.replace(" ", "-"))
    return docs
