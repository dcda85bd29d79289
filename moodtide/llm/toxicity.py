"""Toxicity by logistic regression over hashed word n-grams and skip-grams, fitted with FTRL-proximal.

A document's features are which words, pairs of neighbours and pairs with one word between occur
in it, hashed into ``FEATURES`` places. Every place has its own learning rate and the L1 term
keeps those that explain nothing at exactly zero: what is sent to the scoring tasks is the few places
left, at most ``FEATURES`` in any case.

Fitting takes documents one after the other, so it runs in one task over a bounded sample.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import held_out, learnable, stored
from moodtide.llm.tokens import Hashes, hashed, texts

FEATURES = 1 << 20
ALPHA, BETA, L1, L2 = 2.0, 1.0, 3.0, 0.1
PASSES = 2
SAMPLE = 20_000
THRESHOLD = 0.5
# Letters of any script and digits; ASCII case is lowered.
TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+")
# Odd multipliers that tell the kinds of features apart.
WORD, PAIR, SKIP = 2654435761, 2246822519, 3266489917


def features(text: str | None, hashes: Hashes) -> np.ndarray:
    """The different places of a text's features."""
    words = hashed(text, TOKEN, hashes, lower=True).astype(np.uint64)

    def places(values: np.ndarray, kind: int) -> np.ndarray:
        mixed = values * np.uint64(kind)
        mixed ^= mixed >> np.uint64(29)
        return (mixed * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)) & np.uint64(FEATURES - 1)

    shift = np.uint64(32)
    parts = [places(words, WORD)]
    if len(words) > 1:
        parts.append(places(words[:-1] << shift | words[1:], PAIR))
    if len(words) > 2:
        parts.append(places(words[:-2] << shift | words[2:], SKIP))
    return np.unique(np.concatenate(parts)).astype(np.int64)


class Ftrl:
    """Per-coordinate FTRL-proximal for logistic loss; the last place is the bias, which pays no L1."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == FEATURES, 0.0, L1)
        free = np.maximum(np.abs(z) - l1, 0)
        return -np.sign(z) * free / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, label: int) -> None:
        at = np.append(at, FEATURES)
        w = self.weights(at)
        slope = 1 / (1 + np.exp(-np.clip(w.sum(), -500, 500))) - label
        n = self.n[at]
        self.z[at] += slope - (np.sqrt(n + slope * slope) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + slope * slope


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    model, hashes, seen = Ftrl(), Hashes(), False
    for batch in batches:
        labels = batch.column(1).to_pylist()
        for at, part in texts(batch, 0):
            for i, text in enumerate(part):
                model.learn(features(text, hashes), labels[at + i])
                seen = True
    if seen:
        w = model.weights(np.arange(FEATURES + 1))
        some = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(w[some])], names=["place", "weight"])


def fitted(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, sample: int = SAMPLE) -> DataFrame:
    """``place, weight`` of every weight that is not zero; none without labels."""
    texts_by_id = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # Rows that share an id share its label, and give one text.
    rows = stored(learnable(texts_by_id, labels, label_col, sample), "toxicity-sample")
    rows = rows.groupBy("doc_id", "label", "place").agg(F.min("text").alias("text"))
    passes = F.explode(F.sequence(F.lit(1), F.lit(PASSES))).alias("pass")
    # One task by intent: at most ``sample`` documents, read one by one.
    ordered = rows.select("*", passes).repartition(1).sortWithinPartitions("pass", "place", "doc_id")
    return ordered.select("text", "label").mapInArrow(_fit, "place bigint, weight double")


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, score, predicted``: one row per row of ``docs``.

    Null and blank texts get the bias alone. Without any label every score is 0.5. Repeated rows
    are scored each; a null id counts as not held out and has no label; an empty table gives no
    rows. Nothing but the text enters a score.
    """
    kept = fitted(docs, labels, label_col, id_col, text_col).toPandas().sort_values("place")
    places, weights = kept["place"].to_numpy(dtype=np.int64), kept["weight"].to_numpy(dtype=np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, hashes = np.zeros(FEATURES + 1), Hashes()
        dense[places] = weights
        for batch in batches:
            for at, part in texts(batch, 1):
                sums = np.array([dense[features(text, hashes)].sum() for text in part]) + dense[FEATURES]
                score = 1 / (1 + np.exp(-np.clip(sums, -500, 500)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), pa.array(score)], names=["doc_id", "score"]
                )

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, score double").select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
