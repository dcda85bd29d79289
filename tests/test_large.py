"""Large lexicons, folds and keyed storage against plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from moodtide.operators import folds, lexicon, windows
from moodtide.operators.windows import Hop
from moodtide.plans import pipeline
from moodtide.sources import keyed
from moodtide.sources.tables import chat

HOP = Hop(86_400_000, 43_200_000, 43_200_000)


def first_hit(text, terms):
    low = (text or "").lower()
    ranks = [(rank, score, label) for term, rank, score, label in terms if term and term.lower() in low]
    return min(ranks)[1:] if ranks else (0.0, "Neutral")


@pytest.mark.parametrize("small", [0, 1 << 25])
@pytest.mark.parametrize("shortest", [1, 3, 5])
def test_large_lexicon_equals_a_scan(spark, monkeypatch, shortest, small):
    """Terms across the edges of blocks, characters beyond the basic plane, nulls, repeated rows and shared keys."""
    monkeypatch.setattr(lexicon, "SMALL", small)
    rng = random.Random(shortest)
    letters = "abc好难😀 É\n"
    word = lambda k: "".join(rng.choices(letters, k=k))
    terms = [(word(rng.randrange(shortest, 9)), i // 2, 0.8 if i % 4 < 2 else -0.6, "Positive" if i % 4 < 2 else "Negative") for i in range(60)]
    terms += [("", 0, 0.8, "Positive"), (None, 0, 0.8, "Positive"), (terms[7][0].upper(), *terms[7][1:]), ("x" * 200, 99, 0.8, "Positive")]
    texts = [None, "", "x" * 300, "x" * 199, *[word(k) for k in (1, 2, 5, 126, 127, 128, 129, 130, 255, 256, 257, 2000)]]
    rows = [(i % 12, text) for i, text in enumerate(texts)] + [(3, texts[3]), (3, texts[3])]
    frame = spark.createDataFrame(rows, "id INT, message STRING")
    known = spark.createDataFrame(terms, "term STRING, rank INT, score DOUBLE, label STRING")
    got = lexicon.score_by_lexicon(frame, ["id"], known)
    assert sorted(map(tuple, got.collect())) == sorted((i, *first_hit(text, terms)) for i, text in rows)
    none = lexicon.score_by_lexicon(frame, ["id"], known.limit(0))
    assert {tuple(r)[1:] for r in none.collect()} == {(0.0, "Neutral")} and none.count() == len(rows)
    assert lexicon.score_by_lexicon(frame.limit(0), ["id"], known).count() == 0


def test_terms_that_begin_alike_are_told_apart(spark):
    """A place asks for one term of each length, not for all that begin like it."""
    terms = [("there" + chr(97 + i // 26) + chr(97 + i % 26) + "x" * (i % 3), i, 0.8, "Positive") for i in range(300)]
    index, *_ = lexicon.term_index(spark.createDataFrame(terms, "term STRING, rank INT, score DOUBLE, label STRING"))
    assert index.groupBy("key").count().agg(F.max("count")).first()[0] == 1


@pytest.mark.parametrize("small", [300, 3000])
def test_large_lexicon_by_its_lowest_ranks_first(spark, monkeypatch, small):
    """Some texts are settled by the terms that fit, some by the others; more lengths and characters than are told apart."""
    monkeypatch.setattr(lexicon, "SMALL", small)
    monkeypatch.setattr(lexicon, "LEVELS", 3)
    monkeypatch.setattr(lexicon, "RANGES", 2)
    rng = random.Random(small)
    word = lambda k: "".join(rng.choices("aceg好", k=k))
    terms = [(word(rng.randrange(2, 9)), rng.randrange(100), 0.8, "Positive") for _ in range(100)]
    terms = [(t, r, *((0.8, "Positive") if r % 2 else (-0.6, "Negative"))) for t, r, *_ in terms]
    rows = [(i, " ".join(word(rng.randrange(1, 9)) for _ in range(rng.randrange(4)))) for i in range(60)] + [(60, word(400)), (60, None)]
    frame = spark.createDataFrame(rows, "id INT, message STRING")
    known = spark.createDataFrame(terms, "term STRING, rank INT, score DOUBLE, label STRING")
    got = lexicon.score_by_lexicon(frame, ["id"], known)
    assert sorted(map(tuple, got.collect())) == sorted((i, *first_hit(text, terms)) for i, text in rows)


def test_a_sieve_holds_back_what_is_not_asked_for(spark):
    """Every row with one of the keys, and few others, by one column or two."""
    rows = spark.range(20_000).selectExpr("cast(id AS STRING) AS word", "id % 7 AS part")
    rows = rows.unionByName(rows.limit(50)).unionByName(spark.sql("SELECT cast(NULL AS STRING) AS word, 0L AS part"))
    keys = spark.range(0, 20_000, 40).selectExpr("cast(id AS STRING) AS word", "id % 7 AS part")
    for cols in (["word"], ["word", "part"]):
        met = lexicon._sifted(rows, keys, *cols)
        assert met.columns == rows.columns
        assert met.join(keys, cols).count() == rows.join(keys, cols).count() == 502
        assert met.count() < 1000
    assert lexicon._sifted(rows, keys.limit(0), "word").count() == 0


def test_fold_equals_a_plain_loop(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([0.8, -0.6]), rng.randrange(5000)) for _ in range(3000)]
    frame = spark.createDataFrame(rows, "user_id STRING, score DOUBLE, age BIGINT").repartition(7)
    want = {}
    for user, score, age in rows:
        if user:
            a, b = want.get(user, (0, 0))
            want[user] = a + score * 0.5 ** (age / 1000), b + 0.5 ** (age / 1000)
    for held in (1, folds.HELD):
        got = folds.folded(frame, ["user_id"], ["score", "age"], folds.decayed_mean(1000), held).collect()
        assert {r.user_id: round(r.decayed_score, 9) for r in got} == {u: round(a / b, 9) for u, (a, b) in want.items()}
    assert folds.folded(frame.limit(0), ["user_id"], ["score", "age"], folds.decayed_mean(1000)).count() == 0


def test_a_fold_of_ones_own(spark):
    longest = folds.Fold(
        "length BIGINT, text STRING", "longest STRING", lambda: (-1, ""),
        lambda state, texts: max([state, *((len(t), t) for t in texts)]), max, lambda state: (state[1],),
    )
    frame = spark.createDataFrame([("a", "x"), ("a", "xyz"), ("b", "q"), ("a", "zz")], "k STRING, t STRING")
    got = folds.folded(frame, ["k"], ["t"], longest)
    # What is shuffled is states: rows are folded on both sides of the one exchange.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("MapInArrow") < plan.index("Exchange") < plan.rindex("MapInArrow")
    assert {(r.k, r.longest) for r in got.collect()} == {("a", "xyz"), ("b", "q")}


@pytest.mark.parametrize("made", [keyed.keyed_means, keyed.keyed_join])
def test_nothing_is_exchanged_over_scores_stored_by_user(spark, sf_dir, tmp_path, made):
    scored = pipeline.scores(chat(spark, sf_dir))
    unnamed = scored.limit(1).withColumn("user_id", F.lit(None).cast("string"))
    stored = keyed.store_by_user(scored.unionByName(unnamed), f"by_user_{made.__name__}", 4, str(tmp_path / "scores"))
    # However large both sides of the join are.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = made(stored, HOP)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    rows = sorted((r.user_id, r.window_start, r.n, round(r.average_score, 6)) for r in got.collect())
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    want = windows.flatten_window(windows.window_mean(windows.assign_windows(scored, HOP)))
    assert rows == sorted((r.user_id, r.window_start, r.n, round(r.average_score, 6)) for r in want.collect())
