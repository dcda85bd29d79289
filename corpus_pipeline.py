"""A corpus prepared for training: five stages over ``documents``, each on all that the one before kept.

Quality rules drop what they reject; of near-duplicates the smallest id of a group stays; personal data
is masked; sources are mixed to their targets, documents repeating as often as they are taken; what is
left is encoded, and decoded again for the check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.llm import mixing, pieces, pii, rules, simhash
from moodtide.llm.common import stored, table
from moodtide.llm.queries import piece_model

# SQL has neither the hash of the fingerprints nor the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules."""
    return rules.keep_good(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one whose id names the group. Of rows that share
    that id all stay, and so do those of groups without an id."""
    return simhash.without_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return pii.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each document: id, source, number of pieces, digest of their ids, whether they decode to the text, and
    the ids: what a model trains on."""
    return pieces.piece_counts(docs, piece_model(), keep=("source",))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
