"""Every registered query over the given tables, by name.

Windows are one day long and start every half day: at the tables' density the 60 s default would
hold one row per window. Scores and means are rounded to six digits, as float sums depend on the
order of adding.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moodtide.functions import checks, sentiment
from moodtide.functions.codec import decode_json, encode_json, windowed_key
from moodtide.functions.sentiment import DEFAULT_RULES, Lexicon, Rule, score_sentiment
from moodtide.operators import alerts, changelog, duplicates, folds, lateness, lexicon, quality, windows
from moodtide.operators.windows import Hop
from moodtide.plans import pipeline
from moodtide.schemas import (
    ALERT_TOPIC,
    CHAT_MESSAGE,
    CHAT_TOPIC,
    PARAMETER_INVALID,
    REJECTED_TOPIC,
    SCORE_TOPIC,
    WARNING_ALERT,
    record,
)
from moodtide.session import work_dir
from moodtide.sources import keyed, records, topics
from moodtide.sources.tables import DAY_MS, chat, chat_stream_of, in_slices, table
from moodtide.streaming import exact, metrics, state
from moodtide.streaming import queries as streams

Query = Callable[[SparkSession, str], DataFrame]

DAY_HOP = Hop(size_ms=DAY_MS, advance_ms=DAY_MS // 2, grace_ms=DAY_MS // 2)
LATE_EVERY = 7
CREATED_AT = dt.datetime(2024, 2, 1)

# Rule parameters for text that is not chat: words that stand in the text tables.
TEXT_RULES = (
    Rule("Positive", 0.8, ("great", "best", "gut ", "bueno", "bien")),
    Rule("Negative", -0.6, ("hate", "sad", "nicht", "pas ", "sin ")),
)
# The default rules with negation looked at first.
NEGATION_FIRST = (Rule("Negative", -0.6, ("不好",)), *DEFAULT_RULES)

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _six(name: str) -> Column:
    return F.round(F.col(name), 6).alias(name)


def _scored(spark: SparkSession, sf_dir: str, hold_back_every: int | None = None) -> DataFrame:
    return pipeline.scores(chat(spark, sf_dir, hold_back_every))


def _windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.assign_windows(_scored(spark, sf_dir), DAY_HOP)


# Sources, codec


@query
def src_chat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = topics.chat_messages(topics.chat_records(chat(spark, sf_dir)))
    return decoded.select("key", "partition", "offset", "user_id", "timestamp", "message")


@query
def src_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = topics.sentiment_scores(topics.score_records(_scored(spark, sf_dir)))
    return decoded.select("key", "offset", "user_id", "timestamp", "sentiment_score", "sentiment_label")


@query
def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "props")
    return decode_json(events, record(k=T.IntegerType()), "props").select("event_id", "k", "error_code")


@query
def json_decode_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some records cut short, some null: told apart by their code."""
    sent = chat(spark, sf_dir).select("offset", encode_json(CHAT_MESSAGE).alias("value"))
    cut = F.substr(F.col("value"), F.lit(1), F.length("value") - 1)
    broken = F.when(F.col("offset") % 11 == 0, cut).when(F.col("offset") % 13 != 0, F.col("value"))
    decoded = decode_json(sent.withColumn("value", broken), CHAT_MESSAGE)
    good = F.col("error_code").isNull()
    return decoded.select(
        "offset",
        F.when(good, F.col("user_id")).alias("user_id"),
        F.when(good, F.col("timestamp")).alias("timestamp"),
        F.when(good, F.col("message")).alias("message"),
        "error_code",
    )


@query
def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = topics.chat_records(chat(spark, sf_dir))
    return sent.select("offset", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


# Scoring


@query
def sentiment_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir).select("offset", "user_id", "timestamp", "sentiment_score", "sentiment_label")


@query
def sentiment_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_label = _scored(spark, sf_dir).groupBy("sentiment_label")
    return by_label.agg(F.count("*").alias("n"), F.round(F.avg("sentiment_score"), 6).alias("mean_score"))


@query
def negation_first_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = pipeline.scores(chat(spark, sf_dir), Lexicon(NEGATION_FIRST))
    return scored.groupBy("sentiment_label").agg(F.count("*").alias("n"))


@query
def document_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_sentiment(documents, "text", Lexicon(TEXT_RULES)).drop("text")


@query
def conversation_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return score_sentiment(turns, "text", Lexicon(TEXT_RULES)).drop("text")


@query
def lexicon_any_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lexicon as a bare scorer, its terms in mixed case."""
    mixed = Lexicon([rule._replace(terms=[term.swapcase() for term in rule.terms]) for rule in TEXT_RULES])
    mood = table(spark, sf_dir, "conversations").withColumn("mood", mixed(F.upper("text")))
    return mood.select(
        "conv_id", "turn", "role", F.col("mood.score").alias("sentiment_score"), F.col("mood.label").alias("sentiment_label")
    )


@query
def negative_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentiment.negative_messages(_scored(spark, sf_dir))


# Validation


@query
def validate_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _doubtful(spark, sf_dir).select("event_id", checks.not_null(F.col("user_id"), "3002").alias("error_code"))


@query
def validate_not_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = checks.not_empty_string(F.col("message"), "3000")
    return _doubtful(spark, sf_dir).select("event_id", code.alias("error_code"))


@query
def validate_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with no component above a quarter fail."""
    high = F.filter("embedding", lambda x: x > 0.25)
    code = checks.not_empty_collection(high, PARAMETER_INVALID)
    return table(spark, sf_dir, "embeddings").select("vec_id", code.alias("error_code"))


@query
def validate_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property maps with no value of 50 or more fail."""
    props = F.from_json("props", "MAP<STRING, INT>")
    code = checks.not_empty_collection(F.map_filter(props, lambda _, v: v >= 50), PARAMETER_INVALID)
    return table(spark, sf_dir, "events").select("event_id", code.alias("error_code"))


@query
def validate_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = checks.in_range(F.col("value"), 0, 100, PARAMETER_INVALID)
    return table(spark, sf_dir, "events").select("event_id", code.alias("error_code"))


def _doubtful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table with users, texts and scores that are partly missing or out of range."""
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(event % 13 != 0, F.col("user_id").cast("string")).alias("user_id"),
        F.when(event % 5 == 0, F.lit("")).when(event % 7 != 0, F.col("event_type")).alias("message"),
        (F.col("value") / 100 - 1).alias("sentiment_score"),
    )


def _row_checks() -> list[Column]:
    return [
        *quality.chat_checks(),
        *quality.score_checks(),
        checks.not_null(F.col("user_id"), "3002"),
        # A code of the caller's own, which the catalogue does not know.
        F.when(F.col("message") == "signup", F.lit("9001")),
    ]


@query
def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = quality.valid_rows(_doubtful(spark, sf_dir), _row_checks())
    return good.select("event_id", "user_id", "message", _six("sentiment_score"))


@query
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = quality.quarantine(_doubtful(spark, sf_dir), _row_checks())
    return bad.select("event_id", F.concat_ws(",", "errors").alias("errors"))


@query
def error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.error_summary(spark, quality.quarantine(_doubtful(spark, sf_dir), _row_checks()))


# Windows


@query
def hopping_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.flatten_window(_windowed(spark, sf_dir)).select("offset", "user_id", "window_start", "window_end")


@query
def hopping_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = windows.flatten_window(windows.window_sum(_windowed(spark, sf_dir)))
    return sums.select("user_id", "window_start", "window_end", _six("score_sum"))


@query
def hopping_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.flatten_window(windows.window_count(_windowed(spark, sf_dir)))


def _means(means: DataFrame) -> DataFrame:
    return means.select("user_id", "window_start", "window_end", "n", _six("average_score"))


@query
def hopping_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _means(pipeline.window_means(_scored(spark, sf_dir), DAY_HOP))


@query
def hopping_avg_60s(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _means(pipeline.window_means(_scored(spark, sf_dir)))


@query
def sum_count_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    windowed = _windowed(spark, sf_dir)
    joined = windows.join_sum_count(windows.window_sum(windowed), windows.window_count(windowed))
    return _means(windows.flatten_window(joined))


# Alerts


def _alert_rows(rows: DataFrame) -> DataFrame:
    return rows.select("user_id", "window_end", _six("average_score"), "alert_message")


@query
def warning_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_rows(pipeline.warning_alerts(chat(spark, sf_dir), DAY_HOP))


@query
def low_mood_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A threshold off the grid the means lie on, so that rounding cannot decide."""
    return _alert_rows(pipeline.warning_alerts(chat(spark, sf_dir), DAY_HOP, threshold=-0.0003))


@query
def alert_sink_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pipeline.warning_alerts(chat(spark, sf_dir), DAY_HOP)
    key = windowed_key(F.col("user_id"), F.col("window_start"))
    return rows.select("user_id", "window_end", F.hex(key).alias("sink_key"))


@query
def alert_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _record_rows(alerts.to_records(pipeline.warning_alerts(chat(spark, sf_dir), DAY_HOP), CREATED_AT))


def _record_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumn("average_score", F.col("average_score").cast("double"))


@query
def alert_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pipeline.warning_alerts(chat(spark, sf_dir), DAY_HOP)
    metrics = alerts.alert_metrics(rows.withColumn("average_score", _six("average_score")))
    return metrics.select("alerts", "low_alerts", "min_average", "max_average", "last_window_end")


# Late rows and the update log


@query
def late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lateness.windowed_in_time(_scored(spark, sf_dir, LATE_EVERY), DAY_HOP)
    return kept.select("user_id", "partition", "offset", "window_start")


@query
def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = lateness.windowed_late(_scored(spark, sf_dir, LATE_EVERY), DAY_HOP)
    return late.select("user_id", "partition", "offset", "window_start", "stream_time")


@query
def late_drop_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alert_rows(pipeline.replayed_alerts(chat(spark, sf_dir, LATE_EVERY), DAY_HOP))


def _updates(updates: DataFrame) -> DataFrame:
    return updates.select("user_id", "window_start", "window_end", "offset", "seq", "n", _six("average_score"))


@query
def alert_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _updates(pipeline.replayed_changelog(chat(spark, sf_dir, LATE_EVERY), DAY_HOP))


@query
def alert_changelog_transient(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _updates(pipeline.replayed_changelog(chat(spark, sf_dir, LATE_EVERY), DAY_HOP, include_transient=True))


@query
def alert_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _means(changelog.current_table(pipeline.replayed_changelog(chat(spark, sf_dir, LATE_EVERY), DAY_HOP)))


# The same over many buckets, whose edges windows cross, with users missing


BUCKET_BITS = 6
NO_USER_EVERY = 11


def _some_unnamed(spark: SparkSession, sf_dir: str, hold_back_every: int | None = None) -> DataFrame:
    rows = chat(spark, sf_dir, hold_back_every)
    unnamed = F.col("offset") % NO_USER_EVERY == 0
    return rows.withColumn("user_id", F.when(~unnamed, F.col("user_id")))


@query
def late_drop_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = pipeline.scores(_some_unnamed(spark, sf_dir, LATE_EVERY))
    kept = lateness.windowed_in_time(scored, DAY_HOP, BUCKET_BITS)
    return kept.select("user_id", "partition", "offset", "window_start")


@query
def alert_changelog_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _some_unnamed(spark, sf_dir, LATE_EVERY)
    return _updates(pipeline.replayed_changelog(rows, DAY_HOP, True, BUCKET_BITS))


@query
def alert_changelog_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _updates(pipeline.replayed_changelog(_some_unnamed(spark, sf_dir), DAY_HOP, bucket_bits=BUCKET_BITS))


@query
def alert_current_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _some_unnamed(spark, sf_dir, LATE_EVERY)
    return _means(changelog.current_table(pipeline.replayed_changelog(rows, DAY_HOP, bucket_bits=BUCKET_BITS)))


# Record time and record key, where the payload tells others


def _payload_off(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload times missing on every fifth record and a day ahead on the others."""
    rows = chat(spark, sf_dir, LATE_EVERY)
    return rows.withColumn("timestamp", F.when(F.col("offset") % 5 != 0, F.col("timestamp") + DAY_MS).otherwise(0))


@query
def late_drop_record_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lateness.windowed_in_time(pipeline.scores(_payload_off(spark, sf_dir)), DAY_HOP)
    return kept.select("user_id", "partition", "offset", "window_start")


@query
def alert_changelog_record_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _updates(pipeline.replayed_changelog(_payload_off(spark, sf_dir), DAY_HOP))


@query
def alerts_by_record_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose payload names another user than their key, and some without a key."""
    sent = topics.chat_records(chat(spark, sf_dir).withColumns({"key": F.col("user_id"), "user_id": F.lit("someone")}))
    unkeyed = F.col("offset") % NO_USER_EVERY == 0
    read = topics.chat_messages(sent.withColumn("key", F.when(~unkeyed, F.col("key"))))
    return _alert_rows(pipeline.warning_alerts(read, DAY_HOP))


# Topics kept as files


@query
def topic_mixed_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch, a stream and another batch write to one topic."""
    out = work_dir(spark, "mixed")
    kept = topics.FileTopics(f"{out}/topics")
    sent = topics.chat_records(chat(spark, sf_dir))
    third = F.col("offset") % 3
    kept.write(sent.filter(third == 0), CHAT_TOPIC)
    kept.write(sent.filter(third == 1), "source")
    again = kept.read(spark, "source", streaming=True)
    kept.write(again, CHAT_TOPIC, f"{out}/checkpoint", streams.wire.ALL_AVAILABLE).awaitTermination()
    kept.write(sent.filter(third == 2), CHAT_TOPIC)
    return kept.read(spark, CHAT_TOPIC).groupBy("partition").agg(
        F.count("*").alias("n"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )


@query
def topic_without_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that come with a payload only take its time along."""
    kept = topics.FileTopics(work_dir(spark, "plain"))
    kept.write(topics.chat_records(chat(spark, sf_dir).select("user_id", "timestamp", "message")), CHAT_TOPIC)
    return _alert_rows(pipeline.warning_alerts(topics.chat_messages(kept.read(spark, CHAT_TOPIC)), DAY_HOP))


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good records come out of scoring, cut and null ones out beside it, with their code."""
    out = work_dir(spark, "rejected")
    kept = topics.FileTopics(f"{out}/topics")
    sent = topics.chat_records(chat(spark, sf_dir))
    cut = F.when(F.col("offset") % 11 == 0, F.substring(F.col("value"), 1, 9))
    broken = cut.when(F.col("offset") % 13 != 0, F.col("value"))
    kept.write(sent.withColumn("value", broken), CHAT_TOPIC)
    every = streams.wire.ALL_AVAILABLE
    streams.start_scoring(spark, kept, f"{out}/scoring", every).awaitTermination()
    streams.start_rejected(spark, kept, f"{out}/rejected", every).awaitTermination()
    good = kept.read(spark, SCORE_TOPIC).select("partition", "offset", F.lit(None).cast("string").alias("error_code"))
    value = F.from_json(F.col("value").cast("string"), "errorCode STRING, value STRING")
    bad = kept.read(spark, REJECTED_TOPIC).select("partition", "offset", value["errorCode"].alias("error_code"))
    return good.unionByName(bad)


@query
def observed_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts taken while the alerts pass to their sink, without a pass of their own."""
    rows = pipeline.warning_alerts(chat(spark, sf_dir), DAY_HOP)
    rows, seen = alerts.observe_alerts(rows.withColumn("average_score", _six("average_score")))
    rows.write.parquet(work_dir(spark, "observed"))
    kinds = "alerts BIGINT, low_alerts BIGINT, min_average DOUBLE, max_average DOUBLE, last_window_end BIGINT"
    return spark.createDataFrame([seen.get], kinds)


# Streams: run over the whole event table in SLICES slices, one a micro-batch; results read back from where
# they landed


SLICES = 8


def _chat_stream(spark: SparkSession, sf_dir: str, out: str, hold_back_every: int | None = None, repeats: int = 0) -> DataFrame:
    events = table(spark, sf_dir, "events")
    each = in_slices(events, f"{out}/events", SLICES, repeats)
    return chat_stream_of(spark, events.schema, f"{out}/events", each, hold_back_every)


def _alert_stream(spark: SparkSession, sf_dir: str, out: str, hold_back_every: int | None = None) -> DataFrame:
    return streams.alert_stream(pipeline.scores(_chat_stream(spark, sf_dir, out, hold_back_every)), DAY_HOP)


def _logged(spark: SparkSession, stream: DataFrame, out: str) -> DataFrame:
    every = streams.wire.ALL_AVAILABLE
    streams.start_change_log(stream, f"{out}/log", f"{out}/checkpoint", every, CREATED_AT).awaitTermination()
    return _record_rows(records.latest_records(records.read_changes(spark, f"{out}/log")))


@query
def alerts_stream_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "alerts-update")
    return _logged(spark, _alert_stream(spark, sf_dir, out), out)


@query
def alerts_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows later than the watermark that the batch before last left behind do not count."""
    out = work_dir(spark, "alerts-late")
    return _logged(spark, _alert_stream(spark, sf_dir, out, LATE_EVERY), out)


@query
def alerts_stream_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "alerts-final")
    stream = _alert_stream(spark, sf_dir, out)
    streams.start_final(stream, f"{out}/alerts", f"{out}/checkpoint", streams.wire.ALL_AVAILABLE).awaitTermination()
    return _alert_rows(spark.read.parquet(f"{out}/alerts"))


@query
def alerts_stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "alerts-upsert")
    stream = _alert_stream(spark, sf_dir, out)
    every = streams.wire.ALL_AVAILABLE
    streams.start_upsert(stream, f"{out}/table", f"{out}/checkpoint", every, CREATED_AT).awaitTermination()
    return _record_rows(records.read_records(spark, f"{out}/table"))


@query
def alerts_through_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three streams joined by topics kept as files: ingest, scoring, alerting."""
    out = work_dir(spark, "topics")
    kept = topics.FileTopics(f"{out}/topics", max_files_per_trigger=1)
    every = streams.wire.ALL_AVAILABLE
    ingest = topics.chat_records(_chat_stream(spark, sf_dir, out))
    kept.write(ingest, CHAT_TOPIC, f"{out}/ingest", every).awaitTermination()
    streams.start_scoring(spark, kept, f"{out}/scoring", every).awaitTermination()
    streams.start_alerting(spark, kept, f"{out}/alerting", DAY_HOP, trigger=every, mode="append").awaitTermination()
    return _alert_rows(decode_json(kept.read(spark, ALERT_TOPIC), WARNING_ALERT))


@query
def alerts_fused_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat topic to alert topic in one query."""
    out = work_dir(spark, "fused")
    kept = topics.FileTopics(f"{out}/topics", max_files_per_trigger=1)
    every = streams.wire.ALL_AVAILABLE
    kept.write(topics.chat_records(_chat_stream(spark, sf_dir, out)), CHAT_TOPIC, f"{out}/ingest", every).awaitTermination()
    streams.start_alerts(spark, kept, f"{out}/alerts", DAY_HOP, trigger=every, mode="append").awaitTermination()
    return _alert_rows(decode_json(kept.read(spark, ALERT_TOPIC), WARNING_ALERT))


# Streams as exact as replay


def _exact_updates(spark: SparkSession, sf_dir: str, out: str) -> DataFrame:
    every = streams.wire.ALL_AVAILABLE
    scored = pipeline.scores(_chat_stream(spark, sf_dir, out, LATE_EVERY))
    exact.start_pairs(scored, f"{out}/marked", f"{out}/marking", DAY_HOP, trigger=every, bucket_bits=BUCKET_BITS).awaitTermination()
    pairs = exact.read_pairs(spark, f"{out}/marked", streaming=True)
    exact.start_updates(pairs, f"{out}/updates", f"{out}/updating", DAY_HOP, every).awaitTermination()
    return spark.read.schema(exact.UPDATES).parquet(f"{out}/updates")


@query
def alert_changelog_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One update per record out of the state store, late records dropped by exact stream time."""
    return _updates(_exact_updates(spark, sf_dir, work_dir(spark, "changelog-stream")))


@query
def late_rows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the stream drops, with the stream time that closed it."""
    out = work_dir(spark, "late-stream")
    scored = pipeline.scores(_chat_stream(spark, sf_dir, out, LATE_EVERY))
    every = streams.wire.ALL_AVAILABLE
    exact.start_pairs(scored, f"{out}/marked", f"{out}/marking", DAY_HOP, trigger=every).awaitTermination()
    late = exact.read_pairs(spark, f"{out}/marked", late=True)
    return late.select("user_id", "partition", "offset", "window_start", "stream_time")


@query
def late_drop_alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the stream's update log ends."""
    log = _exact_updates(spark, sf_dir, work_dir(spark, "late-alerts-stream"))
    return _alert_rows(alerts.to_alerts(changelog.current_table(log)))


# Joined tables, repeated records and the state store


def _final(spark: SparkSession, stream: DataFrame, out: str) -> DataFrame:
    streams.start_final(stream, f"{out}/alerts", f"{out}/checkpoint", streams.wire.ALL_AVAILABLE).awaitTermination()
    return _alert_rows(spark.read.parquet(f"{out}/alerts"))


@query
def alerts_stream_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and counts aggregated apart and joined, in one query."""
    out = work_dir(spark, "alerts-joined")
    return _final(spark, streams.joined_alert_stream(pipeline.scores(_chat_stream(spark, sf_dir, out)), DAY_HOP), out)


@query
def alerts_stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record comes twice, the second time a micro-batch later, and counts once."""
    out = work_dir(spark, "alerts-once")
    twice = pipeline.scores(_chat_stream(spark, sf_dir, out, repeats=1))
    return _final(spark, streams.alert_stream_once(twice, DAY_HOP), out)


@query
def alerts_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch form: a topic that holds every record twice."""
    rows = chat(spark, sf_dir)
    return _alert_rows(pipeline.warning_alerts(duplicates.once(rows.unionByName(rows), DAY_HOP.grace), DAY_HOP))


EARLIER = 4


def _state_of(spark: SparkSession, sf_dir: str, batch_id: int | None) -> DataFrame:
    out = work_dir(spark, "state")
    _logged(spark, _alert_stream(spark, sf_dir, out), out)
    return _means(state.open_means(spark, f"{out}/checkpoint", batch_id))


@query
def alert_state_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows that the stopped query still holds open, out of its checkpoint."""
    return _state_of(spark, sf_dir, None)


@query
def alert_state_earlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after an earlier micro-batch."""
    return _state_of(spark, sf_dir, EARLIER)


# Own aggregates, keyed storage, large lexicons


@query
def hopping_decayed_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fold of the user's own: scores count half as much for every quarter of a day before the window's end."""
    pairs = windows.explode_windows(_scored(spark, sf_dir), DAY_HOP)
    pairs = pairs.withColumn("age", F.col("window_end") - F.unix_millis("event_time"))
    mean = folds.decayed_mean(DAY_MS // 4)
    decayed = folds.folded(pairs, ["user_id", "window_start", "window_end"], ["sentiment_score", "age"], mean)
    return decayed.withColumn("decayed_score", F.round("decayed_score", 6))


def _kept_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "by-user")
    name = f"scores_{path[-32:]}"
    return keyed.store_by_user(_scored(spark, sf_dir), name, SLICES, path)


@query
def hopping_avg_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means over scores stored by user: no exchange behind the table."""
    return _means(keyed.keyed_means(_kept_by_user(spark, sf_dir), DAY_HOP))


@query
def sum_count_join_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and counts over them, joined: no exchange either."""
    return _means(keyed.keyed_join(_kept_by_user(spark, sf_dir), DAY_HOP))


def _large_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run of five letters or more in the documents as a term, the first in the alphabet first; longer than eight
    letters they are positive."""
    found = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{5,}"), F.lit(0))
    terms = table(spark, sf_dir, "documents").select(F.explode(found).alias("term")).distinct()
    good = F.length("term") > 8
    ranked = terms.select(
        "term",
        # The first eight letters as a number; terms that share them share score or not by their whole length.
        F.conv(F.hex(F.rpad(F.substring("term", 1, 7), 7, "\x00")), 16, 10).cast("bigint").alias("place"),
        F.when(good, F.lit(0.8)).otherwise(F.lit(-0.6)).alias("score"),
        F.when(good, F.lit("Positive")).otherwise(F.lit("Negative")).alias("label"),
    ).select("term", (F.col("place") * 2 + (~good).cast("int")).alias("rank"), "score", "label")
    path = work_dir(spark, "lexicon")
    ranked.write.parquet(path)
    return spark.read.parquet(path)


@query
def document_sentiment_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by a lexicon of tens of thousands of terms."""
    documents = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    return lexicon.score_by_lexicon(documents, ["doc_id"], _large_lexicon(spark, sf_dir), "text")


@query
def conversation_sentiment_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return lexicon.score_by_lexicon(turns, ["conv_id", "turn", "role"], _large_lexicon(spark, sf_dir), "text")


# Nothing vanishes: what streams counted, and what they left out


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = topics.chat_records(chat(spark, sf_dir))
    cut = F.when(F.col("offset") % 11 == 0, F.substring(F.col("value"), 1, 9))
    return sent.withColumn("value", cut.when(F.col("offset") % 13 != 0, F.col("value")))


@query
def fused_stream_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-query form over a damaged topic: what it counted, from the table of metrics, and what was kept beside it."""
    out = work_dir(spark, "accounts")
    kept = topics.FileTopics(f"{out}/topics")
    kept.write(_damaged(spark, sf_dir), CHAT_TOPIC)
    log, every = metrics.MetricsLog(spark, f"{out}/metrics"), streams.wire.ALL_AVAILABLE
    spark.streams.addListener(log)
    try:
        alerting = streams.start_alerts(spark, kept, f"{out}/alerts", DAY_HOP, trigger=every, mode="append")
        alerting.awaitTermination()
        log.wait_for(alerting)
    finally:
        spark.streams.removeListener(log)
    streams.start_rejected(spark, kept, f"{out}/rejected", every).awaitTermination()
    counted = metrics.read_metrics(spark, f"{out}/metrics")
    total = lambda name: F.sum(F.when(F.col("metric") == name, F.col("value"))).cast("bigint").alias(name)
    sums = counted.agg(total("records"), total("rejected"), total("messages"), total("negative_messages"))
    return sums.crossJoin(kept.read(spark, REJECTED_TOPIC).agg(F.count("*").alias("kept")))


@query
def score_topic_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A damaged score topic: what alerting takes and what is kept beside it are every record."""
    out = work_dir(spark, "score-rejected")
    kept = topics.FileTopics(f"{out}/topics")
    sent = topics.score_records(_scored(spark, sf_dir))
    cut = F.when(F.col("offset") % 11 == 0, F.substring(F.col("value"), 1, 9)).otherwise(F.col("value"))
    kept.write(sent.withColumn("value", cut), SCORE_TOPIC)
    every = streams.wire.ALL_AVAILABLE
    streams.start_rejected(spark, kept, f"{out}/rejected", every, source=SCORE_TOPIC).awaitTermination()
    good = topics.sentiment_scores(kept.read(spark, SCORE_TOPIC)).filter("error_code IS NULL")
    value = F.from_json(F.col("value").cast("string"), "errorCode STRING, value STRING")
    bad = kept.read(spark, REJECTED_TOPIC).select("partition", "offset", value["errorCode"].alias("error_code"))
    return good.select("partition", "offset", "error_code").unionByName(bad)
