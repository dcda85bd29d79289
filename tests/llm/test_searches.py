"""The searches against brute force: ranked documents, hard negatives, exact top k."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from moodtide.llm import mtree, reversed_search, zones
from moodtide.llm.reversed_search import ranked_documents

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute_ranks(docs, items, top=10):
    docs = [(i, terms_of(t)) for i, t in docs]
    docs = [(i, t) for i, t in docs if t]
    n, length = len(docs), sum(len(t) for _, t in docs)
    out = []
    for item, text in items:
        scored = []
        for doc, terms in docs:
            m = 100 - 90 + 90 * len(terms) * n // length
            score = 0
            for term in set(terms_of(text)):
                df, tf = sum(term in t for _, t in docs), terms.count(term)
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc))
        scored.sort(key=lambda e: e[:2] + (e[2] or 0,))
        out += [(item, rank + 1, doc, -score) for rank, (score, _, doc) in enumerate(scored[:top])]
    return sorted(map(str, out))


@pytest.mark.parametrize("postings", [5, 1 << 20])
def test_ranked_documents_equal_brute_force(spark, monkeypatch, postings):
    """Ties, repeated rows and ids, nulls, case beyond ASCII, one index or many."""
    monkeypatch.setattr(reversed_search, "CELLS", 7)
    rng = random.Random(8)
    words = ["Ab", "ab", "É", "é", "x1", "日本", "the", "the", "the", "rare", "-", "😀"]
    text = lambda k: " ".join(rng.choices(words, k=k))
    docs = [(i, text(rng.randrange(0, 40))) for i in range(60)] + [(None, "rare ab"), (7, "the rare"), (7, "the rare"), (90, None), (91, " - ")]
    docs += [(100 + i, "same words here the ab") for i in range(20)]
    items = [(1, "ab rare the"), (2, "É"), (2, "nowhere"), (3, None), (4, ""), (None, "same words"), (5, "rare Rare RARE 日本😀")]
    frames = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5), spark.createDataFrame(items, "item_id bigint, text string")
    got = ranked_documents(*frames, postings=postings)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(str, map(tuple, got.collect()))) == brute_ranks(docs, items)
    assert ranked_documents(frames[0].limit(0), frames[1]).collect() == [] == ranked_documents(frames[0], frames[1].limit(0)).collect()


def test_ranked_documents_of_odd_texts(spark, odd, none):
    items = spark.createDataFrame([(1, "on and words", 3)], "item_id bigint, text string, doc_id int")
    rows = [(row.doc_id, row.text) for row in odd.collect()]
    assert sorted(map(str, map(tuple, ranked_documents(odd, items).collect()))) == brute_ranks(rows, [(1, "on and words")])
    assert ranked_documents(none, items).collect() == []


def made_vectors(spark, n=400, dim=6, seed=1):
    """Clusters, copies under many ids, other lengths, and what takes no part; clashing column names."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(7, dim))
    rows = [(i, (centers[i % 7] + rng.normal(size=dim) * 0.2).tolist(), i % 4) for i in range(n)]
    rows += [(n + i, rows[3][1], 3) for i in range(60)] + [(2000 + i, [0.5, 0.25], i % 2) for i in range(12)]
    nan, inf = float("nan"), float("inf")
    rows += [(3000, None, 1), (3050, [], 1), (3100, [nan] * dim, 1), (3150, [inf] * dim, 1), (3200, [None] * dim, 1), (None, rows[0][1], 1)]
    rows += [(3300, [0.0] * dim, 1), (3400, rows[5][1], None), rows[50], (100, rows[9][1], 2)]
    frame = spark.createDataFrame([(*r, 5, "x") for r in rows], "vec_id bigint, embedding array<double>, label int, score int, k1 string")
    return rows, frame.repartition(6)


def whole(rows, labelled=False):
    fit = lambda v: v and all(x is not None and math.isfinite(x) for x in v)
    return [
        (i, tuple(math.floor(256 * x) for x in v), g) for i, v, g in rows
        if i is not None and fit(v) and (g is not None or not labelled)
    ]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True))


def test_nearest_equals_brute_force(spark, monkeypatch):
    for chunk, page in [(1 << 15, 256), (50, 8)]:
        monkeypatch.setattr(mtree, "PAGE", page)
        monkeypatch.setattr(mtree, "BLOCK", 5)
        rows, frame = made_vectors(spark)
        good, want = whole(rows), []
        asked = {(i, v) for i, v, _ in good if i % 10 == 0}
        for i, v in asked:
            others = [(-dot(v, w), j) for j, w, _ in good if len(w) == len(v)]
            others.remove((-dot(v, v), i))
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(others)[:5])]
        got = mtree.nearest(frame, F.col("vec_id") % 10 == 0, chunk=chunk)
        assert sorted(map(tuple, got.collect())) == sorted(want)
    assert mtree.nearest(frame.limit(0), F.lit(True)).collect() == []


def test_tree_bounds_hold_and_save_distances():
    rng = np.random.default_rng(2)
    vectors = np.unique(np.floor(256 * (rng.normal(size=(20, 8))[rng.integers(20, size=3000)] + rng.normal(size=(3000, 8)) * 0.02)), axis=0).astype(int)
    tree = mtree.Tree.made(vectors, [[i] for i in range(len(vectors))]).ready()
    for node, kids in enumerate(tree.kids):
        for kid in kids:
            assert np.isclose(tree.parted[kid], np.linalg.norm(tree.center[kid] - tree.center[node]))
        rows = tree.rows[node]
        assert (np.linalg.norm(vectors[rows] - tree.center[node], axis=1) <= tree.reach[node] + 1e-6).all()
    visited = []
    visit = tree._visit
    tree._visit = lambda rows, *rest: (visited.append(len(rows)), visit(rows, *rest))
    (best,) = tree.search(vectors[:1], 5, [None])
    assert sorted(s for s, *_ in best) == sorted((vectors @ vectors[0]).tolist())[-5:]
    assert sum(visited) < len(vectors) / 2


def test_hard_negatives_equal_brute_force(spark):
    rows, frame = made_vectors(spark)
    good, want = whole(rows, labelled=True), []
    for i, v, g in {r for r in good if r[0] % 10 == 0}:
        same = [(-dot(v, w), j) for j, w, h in good if h == g and len(w) == len(v)]
        same.remove((-dot(v, v), i))
        for s, p in sorted(same)[:5]:
            fits = [(-dot(v, w), j) for j, w, h in good if h != g and len(w) == len(v)]
            fits = [(t, j) for t, j in fits if 80 * -s <= 100 * -t <= 100 * -s]
            want += [(i, p, r + 1, j, -s, -t) for r, (t, j) in enumerate(sorted(fits)[:5])]
    for block in (8, 1024):
        got = zones.hard_negatives(frame, F.col("vec_id") % 10 == 0, F.col("label"), block=block)
        assert want and sorted(map(tuple, got.collect())) == sorted(want)
    assert zones.hard_negatives(frame.limit(0), F.lit(True), F.col("label")).collect() == []


def test_neighbours_on_the_curve_are_neighbours_in_space():
    for dims, bits in [(2, 3), (3, 2), (8, 1)]:
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        place = zones.hilbert(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(1) == 1).all()


def test_intervals_hold_every_product():
    rng = np.random.default_rng(3)
    anchors, rows = rng.integers(-300, 300, (5, 9)), rng.integers(-300, 300, (40, 9))
    low, high = zones.intervals(anchors, rows.min(0)[None], rows.max(0)[None])
    scores = anchors @ rows.T
    assert (low <= scores).all() and (scores <= high).all()
