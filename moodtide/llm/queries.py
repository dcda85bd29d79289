"""The corpus operators as registered queries over the given tables, with production settings."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.llm import (
    credentials,
    mixing,
    mtree,
    neighbours,
    pieces,
    pii,
    quality_model,
    reversed_search,
    rules,
    simhash,
    templates,
    toxicity,
    zones,
)
from moodtide.llm.common import table
from moodtide.llm.oracle import SQL

__all__ = ["QUERIES", "SQL"]


def piece_model(name: str = pieces.MODEL) -> str:
    """Where the installed tokenizer files keep a model; the operators take any path."""
    return importlib.import_module("public_tokenizers").path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.secrets_found(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_verdicts(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_counts(table(spark, sf_dir, "documents"), piece_model())


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.page_texts(table(spark, sf_dir, "pages"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reversed_search.ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return zones.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii, op2_quality_classifier, op3_source_mix, op4_secret_scan, op5_toxicity, op6_simhash_dedup,
        op7_quality_rules, op8_sentencepiece, op9_html_text, op10_embedding_dedup,
        op11_ranked_search, op12_hard_negatives, op13_exact_top_k,
    )
}
