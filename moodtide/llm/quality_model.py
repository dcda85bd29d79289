"""Document quality from random-indexing word vectors and a small network.

Every word bucket has a fixed sparse random index vector; a word's vector is the sum of the index
vectors around all its occurrences in the whole corpus. Tasks add up one bounded matrix each
(buckets x dimensions), Spark sums them, and the result, bounded by the same size, is sent back.
A document is its words' mean vector, their spread about it and its length, how alike the vectors of
neighbours are, and how many words there are. A two-layer network over that is fitted on a bounded sample of labelled rows and its
temperature on a part of the sample set aside.
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

BUCKETS = 1 << 13
DIM = 32
NONZERO = 4
WINDOW = 2
SEED = 11
# Frequent words count less in a mean: RARE / (RARE + share of all words).
RARE = 1e-3
# Tokens that a task counts at a time, and labelled documents learnt from at most.
TOKENS = 1 << 19
SAMPLE = 20_000
HIDDEN = 16
EPOCHS = 40
BATCH = 256
RATE = 0.01
DECAY = 1e-4
THRESHOLD = 0.3
# Letters of any script, digits, or marks; case stays.
TOKEN = re.compile(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\x80-\xff\x00-\x20]+")


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Where each bucket's index vector is not zero, and its signs; the bucket after the last,
    which stands between documents, has none."""
    rng = np.random.default_rng(SEED)
    place = rng.integers(0, DIM, (BUCKETS + 1, NONZERO))
    sign = rng.choice([-1.0, 1.0], (BUCKETS + 1, NONZERO))
    sign[BUCKETS] = 0
    return place, sign


def _buckets(text: str | None, hashes: Hashes) -> np.ndarray:
    return (hashed(text, TOKEN, hashes) & np.uint32(BUCKETS - 1)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, sign = index_vectors()
    sums, seen = np.zeros((BUCKETS + 1) * DIM), np.zeros(BUCKETS + 1, dtype=np.int64)
    hashes, between = Hashes(), np.full(WINDOW, BUCKETS)
    held, size, before = [], 0, between

    def add(parts: list[np.ndarray], before: np.ndarray) -> np.ndarray:
        # Pairs whose later word is new; the last words go along for the pairs that follow.
        ids = np.concatenate([before, *parts])
        seen[:] += np.bincount(ids[WINDOW:], minlength=BUCKETS + 1)
        for away in range(1, WINDOW + 1):
            later, earlier = ids[WINDOW:], ids[WINDOW - away : -away]
            for word, near in ((earlier, later), (later, earlier)):
                for k in range(NONZERO):
                    sums[:] += np.bincount(word * DIM + place[near, k], sign[near, k], len(sums))
        return ids[-WINDOW:]

    for batch in batches:
        for _, part in texts(batch, 0):
            for text in part:
                ids = _buckets(text, hashes)
                for at in range(0, len(ids), TOKENS):
                    held.append(ids[at : at + TOKENS])
                    size += len(held[-1])
                    if size >= TOKENS:
                        before = add(held, before)
                        held, size = [], 0
                held.append(between)
    if held:
        add(held, before)
    some = np.flatnonzero(seen[:BUCKETS])
    table = sums.reshape(-1, DIM)[some]
    yield pa.RecordBatch.from_arrays(
        [pa.array(some), pa.array(seen[some]), *[pa.array(table[:, i]) for i in range(DIM)]],
        names=["bucket", "n", *[f"v{i}" for i in range(DIM)]],
    )


def word_vectors(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors per bucket, and how much a word of it counts. Over all of ``docs``."""
    columns = ", ".join(f"v{i} double" for i in range(DIM))
    counted = docs.select(F.col(text_col).cast("string")).mapInArrow(_count, f"bucket bigint, n bigint, {columns}")
    summed = counted.groupBy("bucket").agg(F.sum("n").alias("n"), *[F.sum(f"v{i}").alias(f"v{i}") for i in range(DIM)])
    vectors, weight = np.zeros((BUCKETS, DIM), dtype=np.float32), np.zeros(BUCKETS, dtype=np.float32)
    rows = summed.toPandas()  # at most BUCKETS rows
    if len(rows):
        rows = rows.sort_values("bucket")
        table = rows[[f"v{i}" for i in range(DIM)]].to_numpy(dtype=np.float64)
        length = np.linalg.norm(table, axis=1, keepdims=True)
        vectors[rows["bucket"]] = table / np.where(length > 0, length, 1)
        n = rows["n"].to_numpy(dtype=np.float64)
        weight[rows["bucket"]] = RARE / (RARE + n / n.sum())
    return vectors, weight


def pooled(docs: DataFrame, vectors: np.ndarray, weight: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, features``: mean, spread, length of the mean, likeness of neighbours, logarithm of the
    number of words; zeros for texts without words."""

    def one(ids: np.ndarray) -> np.ndarray:
        total, square, mass, alike = np.zeros(DIM), np.zeros(DIM), 0.0, 0.0
        for at in range(0, len(ids), TOKENS):
            part = ids[at : at + TOKENS + 1]
            v, w = vectors[part], weight[part]
            alike += float(np.einsum("ij,ij->", v[:-1], v[1:]))
            v, w = v[:TOKENS], w[:TOKENS]
            total += w @ v
            square += w @ (v * v)
            mass += float(w.sum())
        if not mass:
            return np.zeros(2 * DIM + 3)
        mean = total / mass
        spread = np.sqrt(np.maximum(square / mass - mean * mean, 0))
        return np.concatenate([mean, spread, [np.linalg.norm(mean), alike / max(len(ids) - 1, 1), np.log1p(len(ids))]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for batch in batches:
            for at, part in texts(batch, 1):
                features = [one(_buckets(text, hashes)).astype(np.float32) for text in part]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), pa.array(features, pa.list_(pa.float32()))],
                    names=["doc_id", "features"],
                )

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, features array<float>")


class Network:
    """Two layers over standardised features; probabilities after a temperature."""

    def __init__(self, features: np.ndarray, labels: np.ndarray, fit: np.ndarray) -> None:
        """Learns from the rows marked ``fit`` and takes its temperature from the others."""
        self.mean = features.mean(axis=0)
        self.scale = np.maximum(features.std(axis=0), 1e-6)
        rng = np.random.default_rng(SEED)
        x, y = (features[fit] - self.mean) / self.scale, labels[fit].astype(np.float64)
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        self.weights = [
            rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]),
            np.zeros(HIDDEN),
            rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN),
            np.array(np.log(share / (1 - share))),
        ]
        self.temperature = 1.0
        first, second = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]
        step = 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for at in range(0, len(order), BATCH):
                rows = order[at : at + BATCH]
                step += 1
                for i, slope in enumerate(self._slopes(x[rows], y[rows])):
                    first[i] = 0.9 * first[i] + 0.1 * slope
                    second[i] = 0.999 * second[i] + 0.001 * slope * slope
                    move = first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
                    self.weights[i] = self.weights[i] - RATE * (move + DECAY * self.weights[i])
        if (~fit).any():
            logit, truth = self.logits(features[~fit]), labels[~fit]
            tried = np.geomspace(0.25, 8, 61)
            self.temperature = float(tried[np.argmin([_loss(logit / t, truth) for t in tried])])

    def _slopes(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        a, b, c, d = self.weights
        hidden = np.tanh(x @ a + b)
        miss = (_sigmoid(hidden @ c + d) - y) / len(y)
        back = np.outer(miss, c) * (1 - hidden * hidden)
        return [x.T @ back, back.sum(axis=0), hidden.T @ miss, miss.sum()]

    def logits(self, features: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh((features - self.mean) / self.scale @ a + b) @ c + d

    def scores(self, features: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(features) / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _loss(logit: np.ndarray, truth: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, np.where(truth == 1, -logit, logit))))


def learnt(features: DataFrame, labels: DataFrame, label_col: str, sample: int = SAMPLE) -> Network | None:
    """The network, from at most ``sample`` rows; None without any label to learn from."""
    # Rows that share an id are told apart by their features: the order, and so the network, is the same in every run.
    order = ("place", "doc_id", F.xxhash64("features"))
    rows = learnable(features, labels, label_col, sample).orderBy(*order).limit(sample).toPandas()
    if not len(rows):
        return None
    x = np.stack(rows["features"].to_numpy()).astype(np.float64)
    aside = np.arange(len(x)) % 5 == 4
    return Network(x, rows["label"].to_numpy(), ~aside)


def quality_scores(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, score, predicted``: one row per row of ``docs``.

    Null and blank texts are scored from zeros. Without any label every score is 0.5. Repeated rows are
    scored each; a null id counts as not held out and has no label; an empty table gives no
    rows. Nothing but the text enters a score.
    """
    vectors, weight = word_vectors(docs, text_col)
    features = stored(pooled(docs, vectors, weight, id_col, text_col), "quality-features")
    network = learnt(features, labels, label_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            score = network.scores(flat.astype(np.float64)) if network else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    scored = features.mapInArrow(run, "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
