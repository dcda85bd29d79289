"""The whole dataflow as one composition: messages -> scores -> window means -> alerts (T4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.functions.sentiment import Scorer, score_sentiment
from moodtide.operators.alerts import to_alerts
from moodtide.operators.changelog import alert_changelog
from moodtide.operators.lateness import windowed_in_time
from moodtide.operators.running import BUCKET_BITS
from moodtide.operators.windows import DEFAULT_HOP, FLAT, Hop, assign_windows, flatten_window, window_mean


def scores(chat: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """Messages with a text, scored. An empty text is neutral; a null one is for quarantine."""
    return score_sentiment(chat.filter(F.col("message").isNotNull()), scorer=scorer)


def window_means(scored: DataFrame, hop: Hop = DEFAULT_HOP, time_col: str = "event_time") -> DataFrame:
    """``user_id, window_start, window_end, score_sum, n, average_score``; batch or streaming."""
    return flatten_window(window_mean(assign_windows(scored, hop, time_col)))


def warning_alerts(
    chat: DataFrame,
    hop: Hop = DEFAULT_HOP,
    threshold: float | None = None,
    scorer: Scorer | None = None,
    time_col: str = "event_time",
) -> DataFrame:
    """The alert of every (user, window), all rows counted: one scan, one shuffle."""
    return to_alerts(window_means(scores(chat, scorer), hop, time_col), threshold)


def replayed_means(
    scored: DataFrame, hop: Hop = DEFAULT_HOP, bucket_bits: int = BUCKET_BITS, time_col: str = "event_time"
) -> DataFrame:
    """``window_means`` of the rows record-by-record processing would not have dropped as late:
    where its update log ends, without working out the log. State is per source partition, as in the
    log: a user whose records lie in two partitions, which no key does by itself, has a mean in each."""
    in_time = windowed_in_time(scored, hop, bucket_bits, time_col)
    return window_mean(in_time, keys=("partition", "user_id"), window=FLAT)


def replayed_alerts(
    chat: DataFrame,
    hop: Hop = DEFAULT_HOP,
    threshold: float | None = None,
    scorer: Scorer | None = None,
    bucket_bits: int = BUCKET_BITS,
    time_col: str = "event_time",
) -> DataFrame:
    """The last alert of every (user, window), late rows dropped."""
    return to_alerts(replayed_means(scores(chat, scorer), hop, bucket_bits, time_col), threshold)


def replayed_changelog(
    chat: DataFrame,
    hop: Hop = DEFAULT_HOP,
    include_transient: bool = False,
    bucket_bits: int = BUCKET_BITS,
    time_col: str = "event_time",
) -> DataFrame:
    """Every update record-by-record processing would emit, late rows dropped as it would."""
    return alert_changelog(windowed_in_time(scores(chat), hop, bucket_bits, time_col), hop, include_transient)
