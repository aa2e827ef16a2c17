"""The registered queries of this package: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterflow.llm import (
    bpe_prefix,
    html_blocks,
    jaccard_groups,
    knn_kdtree,
    language_ecoc,
    merkle_manifest,
    packing_mixture,
    pii_bootstrap,
    quality_divergence,
    quality_gbt,
    secrets_entropy,
    token_alignment,
    warc_captures,
)
from meterflow.llm.common import table, tokenizer_file


def op1_language_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_ecoc.predict(docs, language_ecoc.train(docs))


def op2_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(table(spark, sf_dir, "pages"))


def op3_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_bootstrap.find(table(spark, sf_dir, "documents"))


def op4_secrets_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_entropy.find(table(spark, sf_dir, "documents"))


def op5_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_divergence.judged(table(spark, sf_dir, "documents")).drop("js_classes", "js_words")


def op6_packing_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_mixture.pack(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), run=packing_mixture.RUN)


def op7_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups.linked(table(spark, sf_dir, "documents"), k=4, num=85, den=100)


def op8_bpe_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_prefix.digests(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op9_knn_kdtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn_kdtree.search(table(spark, sf_dir, "embeddings"))


def op10_quality_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_gbt.score(docs, quality_gbt.train(docs, table(spark, sf_dir, "labels")))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.link_scores(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.documents_manifest(table(spark, sf_dir, "documents"))


def op13_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_captures.round_trip(table(spark, sf_dir, "pages"))


QUERIES = (
    op1_language_ecoc, op2_html_blocks, op3_pii_bootstrap, op4_secrets_entropy, op5_quality_divergence,
    op6_packing_mixture, op7_jaccard_groups, op8_bpe_prefix, op9_knn_kdtree, op10_quality_gbt,
    op11_token_alignment, op12_merkle_manifest, op13_warc_captures,
)


def catalogue() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle() -> dict[str, str]:
    return {"op5_quality_divergence": quality_divergence.ORACLE, "op7_jaccard_groups": jaccard_groups.ORACLE,
            "op9_knn_kdtree": knn_kdtree.ORACLE, "op12_merkle_manifest": merkle_manifest.ORACLE,
            "op13_warc_captures": warc_captures.ORACLE}
