"""Alerts from window means, alert records, and metrics on the way."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from moodtide.schemas import ALERT_MESSAGE, ALERT_RECORD


def to_alerts(means: DataFrame, threshold: float | None = None, message: str = ALERT_MESSAGE) -> DataFrame:
    """``user_id, window_start, window_end, average_score, alert_message`` from flat window means.

    By default every window gives an alert; with a ``threshold`` only those whose mean lies
    below it do.
    """
    if threshold is not None:
        means = means.filter(F.col("average_score") < F.lit(float(threshold)))
    return means.select("user_id", "window_start", "window_end", "average_score", F.lit(message).alias("alert_message"))


def to_records(
    alerts: DataFrame, created_at: dt.datetime | Column | None = None, with_id: bool = False
) -> DataFrame:
    """Alerts in the shape of the alert table. The key is (user_id, window_end_ts); ``with_id``
    adds a 64-bit hash of it instead of a sequence number, which would need one writer."""
    if created_at is None:
        created = F.current_timestamp().cast("timestamp_ntz")
    elif isinstance(created_at, Column):
        created = created_at
    else:
        # By way of text: a datetime literal would go through the session zone.
        created = F.lit(created_at.isoformat(" ")).cast("timestamp_ntz")
    values = {
        "user_id": F.col("user_id"),
        "window_end_ts": F.col("window_end"),
        "average_score": F.col("average_score"),
        "alert_message": F.col("alert_message"),
        "created_at": created,
    }
    fields = [values[f.name].cast(f.dataType).alias(f.name) for f in ALERT_RECORD]
    if with_id:
        fields.insert(0, F.xxhash64("user_id", "window_end").alias("id"))
    return alerts.select(*fields)


def metric_columns() -> list[Column]:
    """What is counted about alerts as they pass."""
    score = F.col("average_score")
    return [
        F.count("*").alias("alerts"),
        F.count_if(score < 0).alias("low_alerts"),
        F.min(score).alias("min_average"),
        F.max(score).alias("max_average"),
        F.max("window_end").alias("last_window_end"),
    ]


def score_metric_columns() -> list[Column]:
    """What is counted about scored messages as they pass."""
    return [F.count("*").alias("messages"), F.count_if(F.col("sentiment_score") < 0).alias("negative_messages")]


def record_metric_columns(decoded: DataFrame) -> list[Column]:
    """What is counted about decoded records before any is left out: all, and those that no stage can use."""
    bad = F.col("error_code").isNotNull()
    if "message" in decoded.columns:
        bad |= F.col("message").isNull()
    return [F.count("*").alias("records"), F.count_if(bad).alias("rejected")]


def observe(df: DataFrame, name: str, metrics: list[Column]) -> tuple[DataFrame, Observation | None]:
    """The same rows with metrics taken while they pass, without a pass of their own.

    Batch: read them off the returned ``Observation`` after the first action. Streaming: they
    arrive in each progress report (``observedMetrics``) under ``name``; no Observation then.
    """
    if df.isStreaming:
        return df.observe(name, *metrics), None
    observation = Observation(name)
    return df.observe(observation, *metrics), observation


def observe_alerts(alerts: DataFrame, name: str = "alerts") -> tuple[DataFrame, Observation | None]:
    return observe(alerts, name, metric_columns())


def observe_scores(scored: DataFrame, name: str = "scores") -> tuple[DataFrame, Observation | None]:
    """Counts of all and of negative messages: the audit count without the audit list."""
    return observe(scored, name, score_metric_columns())


def observe_records(decoded: DataFrame, name: str = "records") -> tuple[DataFrame, Observation | None]:
    """Counts of all decoded records and of rejected ones."""
    return observe(decoded, name, record_metric_columns(decoded))


def alert_metrics(alerts: DataFrame) -> DataFrame:
    """The metrics as a one-row table."""
    return alerts.agg(*metric_columns())
