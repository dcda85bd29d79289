"""The dataflow as streaming queries.

Lateness: Spark drops by one watermark over all partitions, taken from the batch before, so a
stream is at least as tolerant as the exact per-partition rule of ``operators.lateness``, which
batch replay applies. Updates come per micro-batch, not per record.

The number of state partitions is fixed by ``spark.sql.shuffle.partitions`` when a query first
starts; set it for the expected state, as later changes need a new checkpoint.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from moodtide.functions.sentiment import Scorer
from moodtide.operators.alerts import observe_alerts, observe_records, observe_scores, to_alerts, to_records
from moodtide.operators.duplicates import once
from moodtide.operators.windows import (
    DEFAULT_HOP,
    Hop,
    assign_windows,
    flatten_window,
    join_sum_count,
    window_count,
    window_sum,
)
from moodtide.plans.pipeline import scores, window_means
from moodtide.schemas import ALERT_TOPIC, CHAT_TOPIC, REJECTED_TOPIC, SCORE_TOPIC
from moodtide.sources import topics as wire
from moodtide.sources.records import KEPT, sweep, upsert_records, write_changes

# Every batch of an upsert rewrites what it touches: seconds would pile up rewrites.
EVERY_MINUTES = {"processingTime": "5 minutes"}


def alert_stream(scored: DataFrame, hop: Hop = DEFAULT_HOP, threshold: float | None = None) -> DataFrame:
    """Streaming scores -> streaming alerts. Sum and count share one stateful aggregation; its
    state is bounded by the watermark: a window leaves once its end plus the grace has passed."""
    return to_alerts(window_means(scored.withWatermark("event_time", hop.grace), hop), threshold)


def joined_alert_stream(scored: DataFrame, hop: Hop = DEFAULT_HOP, threshold: float | None = None) -> DataFrame:
    """The same as ``alert_stream`` from two tables joined: sums and counts are aggregated apart and meet on user and
    window (J1). Three stateful operators in one query, for append mode alone: a window's sum and count leave
    their state when the watermark closes it, and the join's state with them."""
    windowed = assign_windows(scored.withWatermark("event_time", hop.grace), hop)
    return to_alerts(flatten_window(join_sum_count(window_sum(windowed), window_count(windowed))), threshold)


def alert_stream_once(scored: DataFrame, hop: Hop = DEFAULT_HOP, threshold: float | None = None) -> DataFrame:
    """``alert_stream`` of a topic that may deliver records again: each counts once. For append mode."""
    return to_alerts(window_means(once(scored, hop.grace), hop), threshold)


def start_change_log(
    alerts: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    created_at: dt.datetime | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Update mode: each micro-batch logs the alerts that changed in it."""

    def log(batch: DataFrame, batch_id: int) -> None:
        write_changes(to_records(batch, created_at), path, batch_id)

    return _start(alerts, log, checkpoint, trigger, name)


def start_upsert(
    alerts: DataFrame,
    base: str,
    checkpoint: str,
    trigger: dict | None = None,
    created_at: dt.datetime | None = None,
    name: str | None = None,
    keep: int = KEPT,
) -> StreamingQuery:
    """Update mode: each micro-batch is merged into the alert table by key, a version of the table each. The
    aggregation gives one row per key and batch, so a batch needs no dedupe of its own. Each batch rewrites
    the parts of the table that it touches, every five minutes by default; a change log writes less.
    Versions before the last ``keep`` are swept every so many batches."""

    def merge(batch: DataFrame, batch_id: int) -> None:
        upsert_records(batch.sparkSession, to_records(batch, created_at), base, checkpoint, batch_id)
        if batch_id % keep == keep - 1:
            sweep(batch.sparkSession, base, keep)

    return _start(alerts, merge, checkpoint, trigger or EVERY_MINUTES, name)


def start_final(
    alerts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, name: str | None = None
) -> StreamingQuery:
    """Append mode: one final alert per window, written exactly once after the watermark."""
    writer = alerts.writeStream.format("parquet").outputMode("append").option("path", path)
    return wire.start(writer, checkpoint, trigger, name)


def read_chat(spark: SparkSession, topics: wire.Topics) -> DataFrame:
    """The chat topic as a stream, decoded; bad records with their code and raw value."""
    return wire.chat_messages(topics.read(spark, CHAT_TOPIC, streaming=True))


def _usable(decoded: DataFrame) -> DataFrame:
    """Good records; how many there were in all, and how many bad ones, comes with the progress (metrics
    ``records``)."""
    counted, _ = observe_records(decoded)
    return counted.filter(F.col("error_code").isNull())


def start_scoring(
    spark: SparkSession,
    topics: wire.Topics,
    checkpoint: str,
    trigger: dict | None = None,
    scorer: Scorer | None = None,
    name: str | None = SCORE_TOPIC,
) -> StreamingQuery:
    """Chat topic to score topic, counts of messages and negative ones in each progress report (metrics
    ``scores``). Records that do not decode and null messages go to ``start_rejected``."""
    scored, _ = observe_scores(scores(_usable(read_chat(spark, topics)), scorer))
    return topics.write(wire.score_records(scored), SCORE_TOPIC, checkpoint, trigger, name=name)


def start_rejected(
    spark: SparkSession,
    topics: wire.Topics,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = REJECTED_TOPIC,
    source: str = CHAT_TOPIC,
) -> StreamingQuery:
    """A topic's records that its next stage cannot use, to a topic of their own: of the chat topic what scoring leaves
    out, of the score topic what alerting does. Together with what that stage takes it is every record."""
    decode = {CHAT_TOPIC: wire.chat_messages, SCORE_TOPIC: wire.sentiment_scores}[source]
    rejected = wire.rejected_records(decode(topics.read(spark, source, streaming=True)))
    return topics.write(rejected, REJECTED_TOPIC, checkpoint, trigger, name=name)


def read_scores(spark: SparkSession, topics: wire.Topics) -> DataFrame:
    """The score topic as a stream for ``alert_stream``. The user is the record's key."""
    return _usable(wire.sentiment_scores(topics.read(spark, SCORE_TOPIC, streaming=True)))


def _alert_topic(
    scored: DataFrame, topics: wire.Topics, checkpoint: str, hop: Hop, threshold: float | None,
    trigger: dict | None, mode: str, name: str | None,
) -> StreamingQuery:
    alerts, _ = observe_alerts(alert_stream(scored, hop, threshold))
    return topics.write(wire.alert_records(alerts), ALERT_TOPIC, checkpoint, trigger, mode, name)


def start_alerting(
    spark: SparkSession,
    topics: wire.Topics,
    checkpoint: str,
    hop: Hop = DEFAULT_HOP,
    threshold: float | None = None,
    trigger: dict | None = None,
    mode: str = "update",
    name: str | None = ALERT_TOPIC,
) -> StreamingQuery:
    """Score topic to alert topic: every update of a window's mean, or with ``mode="append"`` the final
    alerts. What does not decode is counted, and kept by ``start_rejected`` of the score topic. Counts come with each progress report (metrics ``alerts``)."""
    return _alert_topic(read_scores(spark, topics), topics, checkpoint, hop, threshold, trigger, mode, name)


def start_alerts(
    spark: SparkSession,
    topics: wire.Topics,
    checkpoint: str,
    hop: Hop = DEFAULT_HOP,
    threshold: float | None = None,
    trigger: dict | None = None,
    scorer: Scorer | None = None,
    mode: str = "update",
    name: str | None = f"{CHAT_TOPIC}-to-{ALERT_TOPIC}",
) -> StreamingQuery:
    """The whole dataflow as one query, chat topic to alert topic: no score topic, one hop less, and
    record time kept on any topics. What it cannot use is counted (metrics ``records``); ``start_rejected`` beside it
    keeps it."""
    scored, _ = observe_scores(scores(_usable(read_chat(spark, topics)), scorer))
    return _alert_topic(scored, topics, checkpoint, hop, threshold, trigger, mode, name)


def start_topology(
    spark: SparkSession,
    topics: wire.Topics,
    checkpoint: str,
    hop: Hop = DEFAULT_HOP,
    threshold: float | None = None,
    trigger: dict | None = None,
    scorer: Scorer | None = None,
    mode: str = "update",
) -> tuple[StreamingQuery, StreamingQuery, StreamingQuery, StreamingQuery]:
    """All stages, side by side: scoring, what it rejects, alerting on what it writes, and what that rejects. If one
    cannot start, those started before it are stopped."""
    if mode not in topics.modes:
        raise ValueError(f"{type(topics).__name__} take {', '.join(topics.modes)}, not {mode}")
    started: list[StreamingQuery] = []
    try:
        started.append(start_scoring(spark, topics, f"{checkpoint}/{SCORE_TOPIC}", trigger, scorer))
        started.append(start_rejected(spark, topics, f"{checkpoint}/{REJECTED_TOPIC}", trigger))
        started.append(
            start_alerting(spark, topics, f"{checkpoint}/{ALERT_TOPIC}", hop, threshold, trigger, mode)
        )
        rejecting = f"{checkpoint}/{SCORE_TOPIC}-{REJECTED_TOPIC}"
        started.append(start_rejected(spark, topics, rejecting, trigger, f"{SCORE_TOPIC}-{REJECTED_TOPIC}", SCORE_TOPIC))
    except Exception:
        for query in started:
            query.stop()
        raise
    return tuple(started)


def _start(alerts: DataFrame, on_batch, checkpoint: str, trigger: dict | None, name: str | None) -> StreamingQuery:
    return wire.start(alerts.writeStream.outputMode("update").foreachBatch(wire.brief(on_batch)), checkpoint, trigger, name)
