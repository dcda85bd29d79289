from __future__ import annotations

import datetime as dt
import json
from functools import reduce
from operator import or_

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moodtide.functions import checks
from moodtide.functions.codec import decode_json, encode_json, snake_case, split_windowed_key, windowed_key
from moodtide.functions.sentiment import DEFAULT_RULES, Lexicon, Rule, negative_messages, score_sentiment
from moodtide.functions.timecols import epoch_millis, event_time
from moodtide.schemas import CHAT_MESSAGE, SENTIMENT_SCORE

# Message, expected score, expected label.
GOLDEN = [
    ("今天天气真不错！", 0.8, "Positive"),
    ("这个项目进展得很顺利。", 0.0, "Neutral"),
    ("有点累了，需要休息一下。", 0.0, "Neutral"),
    ("刚刚完成了一个重要功能。", 0.0, "Neutral"),
    ("遇到了一些技术难题。", 0.0, "Neutral"),
    ("心情有点低落。", 0.0, "Neutral"),
    ("很高兴能和大家一起工作。", 0.8, "Positive"),
    ("周末有什么计划吗？", 0.0, "Neutral"),
    ("这个想法很不错！", 0.8, "Positive"),
    ("需要进一步优化。", 0.0, "Neutral"),
    ("今天感觉很沮丧。", -0.6, "Negative"),
    ("工作压力好大。", 0.8, "Positive"),
    ("太难过了", -0.6, "Negative"),
    ("不好", 0.8, "Positive"),
    ("糟糕", -0.6, "Negative"),
    ("", 0.0, "Neutral"),
]


def test_golden_scores(spark):
    df = spark.createDataFrame([(m,) for m, _, _ in GOLDEN], "message STRING")
    scored = score_sentiment(df)
    assert scored.columns == ["message", "sentiment_score", "sentiment_label"]
    assert sorted(map(tuple, scored.collect())) == sorted(GOLDEN)


def test_rules_are_a_parameter(spark):
    df = spark.createDataFrame([("不好",), ("好",), ("GOOD",)], "message STRING")
    rules = (Rule("Negative", -0.6, ("不好",)), Rule("Praise", 0.5, ("good",)), *DEFAULT_RULES)
    got = {r.message: (r.sentiment_label, r.sentiment_score) for r in score_sentiment(df, scorer=Lexicon(rules)).collect()}
    assert got == {"不好": ("Negative", -0.6), "好": ("Positive", 0.8), "GOOD": ("Praise", 0.5)}
    with pytest.raises(ValueError):
        Lexicon([Rule("Positive", 1.0, ())])


def test_scorer_may_be_a_model(spark):
    @F.pandas_udf("score double, label string")
    def model(text: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"score": text.str.len() / 10.0, "label": "Length"})

    df = spark.createDataFrame([("abcd",)], "message STRING")
    assert score_sentiment(df, scorer=model).first()[1:] == (0.4, "Length")


def test_lower_casing_is_left_out_only_where_it_cannot_matter(spark):
    """No character turns into one of the default terms' when lower-cased, nor do theirs change."""
    assert not Lexicon().case_matters
    terms = {char for rule in DEFAULT_RULES for term in rule.terms for char in term}
    characters = [(i, chr(i)) for i in range(0x110000) if not 0xD800 <= i <= 0xDFFF]
    df = spark.createDataFrame(pd.DataFrame(characters, columns=["i", "c"])).withColumn("low", F.lower("c"))
    hits = df.filter(reduce(or_, (F.col("low").contains(t) for t in terms))).collect()
    assert {r.c for r in hits} == terms and all(r.low == r.c for r in hits)
    for word in ("Good", "好a", "i\u0307", "ǅ", "好 "):
        assert Lexicon((Rule("x", 1.0, (word,)),)).case_matters


def test_scoring_stays_in_the_jvm(spark, sf_dir):
    from moodtide.sources.tables import chat

    plan = score_sentiment(chat(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert plan.count("lower(") == 0
    cased = Lexicon((Rule("Praise", 0.5, ("good", "great")), Rule("Blame", -0.5, ("bad",))))
    assert score_sentiment(chat(spark, sf_dir), scorer=cased)._jdf.queryExecution().executedPlan().toString().count("lower(") == 1
    assert "value" not in plan.split("ReadSchema")[1]


def test_negative_messages(spark):
    df = spark.createDataFrame([("u1", "太难过了"), ("u2", "好"), ("u3", "x")], "user_id STRING, message STRING")
    assert [tuple(r) for r in negative_messages(score_sentiment(df)).collect()] == [("u1", -0.6, "太难过了")]


# Value, then user, timestamp, message, code. Timestamp and fields only where it decodes.
DECODED = [
    ('{"userId":"U1","message":"a"}', ("U1", 0, "a", None)),
    ('{"userId":"U1","timestamp":null,"message":"a","x":1}', ("U1", 0, "a", None)),
    ('{"userId":"U1","timestamp":"123"}', ("U1", 123, None, None)),
    ('{"userId":"U1","timestamp":1.9}', ("U1", 1, None, None)),
    ('{"userId":"U1","timestamp":""}', ("U1", 0, None, None)),
    ('{"userId":5,"timestamp":9007199254740993,"message":true}', ("5", 9007199254740993, "true", None)),
    ('{"userId":"a","userId":"b"}', ("b", 0, None, None)),
    ("{}", (None, 0, None, None)),
    ("{bad", "2002"),
    ("", "2002"),
    ("5", "2002"),
    ('[{"userId":"U1"}]', "2002"),
    ("{'userId':'U1'}", "2002"),
    ('{"userId":"U1","timestamp":"abc"}', "2002"),
    ('{"userId":"U1","timestamp":true}', "2002"),
    ('{"userId":"U1","timestamp":99999999999999999999}', "2002"),
    ('{"userId":"cut', "2002"),
    ('{"userId":"U1","timestamp":"12d"}', "2002"),
    ('{"userId":"U1","timestamp":"1.9"}', "2002"),
    ('{"userId":"U1","timestamp":1.9}', ("U1", 1, None, None)),
    ('{"userId":"U1","timestamp":" 12 "}', ("U1", 12, None, None)),
    (None, "3000"),
    ("null", "3000"),
]


def test_decode(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(DECODED)], "i INT, value STRING")
    rows = decode_json(df, CHAT_MESSAGE).orderBy("i").collect()
    for row, (value, expected) in zip(rows, DECODED, strict=True):
        if isinstance(expected, str):
            assert row.error_code == expected, value
        else:
            assert (row.user_id, row.timestamp, row.message, row.error_code) == expected, value


def test_decode_strict_fails_the_job(spark):
    good = spark.createDataFrame([('{"userId":"U1"}',)], "value STRING")
    assert decode_json(good, CHAT_MESSAGE, mode="strict").count() == 1
    bad = spark.createDataFrame([('{"userId":"U1"}',), ("{bad",)], "value STRING")
    with pytest.raises(Exception, match="2002"):
        decode_json(bad, CHAT_MESSAGE, mode="strict").count()
    with pytest.raises(ValueError):
        decode_json(bad, CHAT_MESSAGE, mode="lenient")


def test_decode_parses_once(spark):
    df = spark.createDataFrame([("{}",)], "value STRING")
    plan = decode_json(df, SENTIMENT_SCORE)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_encode_writes_nulls_and_order(spark):
    df = spark.createDataFrame([(None, 5, "a\"b\n好")], "user_id STRING, timestamp BIGINT, message STRING")
    text = df.select(encode_json(CHAT_MESSAGE)).first()[0]
    assert text == '{"userId":null,"timestamp":5,"message":"a\\"b\\n好"}'


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.text(st.characters(blacklist_categories=("Cs",)), max_size=20),
            st.integers(-(2**63), 2**63 - 1),
            st.floats(allow_nan=False, allow_infinity=False),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_encode_decode_round_trip(spark, rows):
    ddl = "i INT, user_id STRING, timestamp BIGINT, sentiment_score DOUBLE, sentiment_label STRING"
    df = spark.createDataFrame([(i, u, t, s, u[::-1]) for i, (u, t, s) in enumerate(rows)], ddl)
    sent = df.select("i", encode_json(SENTIMENT_SCORE).alias("value"))
    assert all(json.loads(r.value)["userId"] == rows[r.i][0] for r in sent.collect())
    back = decode_json(sent, SENTIMENT_SCORE)
    assert back.filter("error_code IS NOT NULL").count() == 0
    assert sorted(map(tuple, back.drop("error_code").collect())) == sorted(map(tuple, df.collect()))


def test_snake_case():
    assert [snake_case(n) for n in ("userId", "windowEnd", "sentimentScore", "k")] == [
        "user_id", "window_end", "sentiment_score", "k",
    ]


def test_windowed_key(spark):
    df = spark.createDataFrame([("U001", 1700000000000), ("用户", 0), ("", 60000)], "u STRING, s BIGINT")
    keyed = df.select("u", "s", windowed_key(F.col("u"), F.col("s")).alias("k"))
    assert keyed.first().k.hex() == "553030310000018bcfe56800"
    text, start = split_windowed_key(F.col("k"))
    assert keyed.filter((text != F.col("u")) | (start != F.col("s"))).count() == 0


def _codes(spark, ddl, values, check):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {ddl}")
    return [r[0] for r in df.orderBy("i").select(check(F.col("v")).alias("c")).collect()]


def test_checks(spark):
    assert _codes(spark, "STRING", [None, "", " "], lambda c: checks.not_null(c, "x")) == ["x", None, None]
    assert _codes(spark, "STRING", [None, "", " "], lambda c: checks.not_empty_string(c, "x")) == ["x", "x", None]
    assert _codes(spark, "ARRAY<INT>", [None, [], [None]], lambda c: checks.not_empty_collection(c, "x")) == ["x", "x", None]
    assert _codes(spark, "MAP<STRING,INT>", [None, {}, {"a": 1}], lambda c: checks.not_empty_collection(c, "x")) == ["x", "x", None]
    values = [-1.0, 1.0, -1.01, 1.01, float("nan"), float("inf"), float("-inf")]
    assert _codes(spark, "DOUBLE", values, lambda c: checks.in_range(c, -1, 1, "x")) == [None, None, "x", "x", None, "x", "x"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Shanghai"])
def test_epoch_millis_in_any_zone(spark, zone):
    """The second time does not exist in New York, the third is before the epoch."""
    times = [dt.datetime(2024, 1, 1, 0, 0, 7, 179999), dt.datetime(2024, 3, 10, 2, 30, 0, 123900), dt.datetime(1969, 12, 31, 23, 59, 59, 999500)]
    expected = [1704067207179, 1710037800123, -1]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in times], "ts TIMESTAMP_NTZ").select(epoch_millis(F.col("ts")).alias("ms"))
        assert [r.ms for r in df.collect()] == expected
        assert [r[0] for r in df.select(F.unix_millis(event_time(F.col("ms")))).collect()] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_lexicon_is_a_scorer_that_ignores_case(spark):
    mixed = Lexicon((Rule("Up", 1.0, ("GrEaT",)), Rule("Down", -1.0, ("sad",))))
    rows = spark.createDataFrame([("it is GREAT",), ("so Sad",), ("x",)], "message STRING")
    bare = rows.select(mixed(F.col("message"))["label"]).collect()
    scored = score_sentiment(rows, scorer=mixed).select("sentiment_label").collect()
    assert [r[0] for r in bare] == [r[0] for r in scored] == ["Up", "Down", "Neutral"]
