"""The per-record update log of the window means, and back to the current table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.operators.lateness import spans_buckets
from moodtide.operators.running import with_running_sums
from moodtide.operators.windows import DEFAULT_HOP, Hop, mean_of


def alert_changelog(in_time: DataFrame, hop: Hop = DEFAULT_HOP, include_transient: bool = False) -> DataFrame:
    """One row per update of a (user, window) mean, as record-by-record processing emits them.

    Input: ``windowed_in_time`` rows with a ``sentiment_score``. ``offset`` orders the records of a
    ``partition``, ``seq`` the updates of one record: 1 is the mean after the record. With
    ``include_transient`` every record but a window's first also gives a seq-0 row, the new sum
    over the old count: what a join of two separately updated tables shows in between, 2n-1 rows
    for n records.

    The sums run inside the (partition, bucket) shuffle that stream time came from. Only windows
    that lie across a bucket's edge go through a second one, keyed by user and window and split
    by bucket, so that no user's history is ever one task.
    """
    pairs = in_time.select(
        "partition", "bucket", "user_id", "window_start", "offset",
        F.col("sentiment_score").alias("_score"), spans_buckets().alias("_across"),
    )
    sums = {"score_sum": F.col("_score"), "n": F.lit(1).cast("bigint")}
    updates = with_running_sums(
        pairs, ["partition", "user_id", "window_start"], "offset", sums, "bucket", F.col("_across")
    )
    total, n = F.col("score_sum"), F.col("n")
    update = F.struct(F.lit(1).alias("seq"), n.alias("n"), mean_of(total, n).alias("average_score"))
    if include_transient:
        halfway = F.struct(F.lit(0).alias("seq"), (n - 1).alias("n"), mean_of(total, n - 1).alias("average_score"))
        update = F.explode(F.when(n > 1, F.array(halfway, update)).otherwise(F.array(update)))
    window_end = (F.col("window_start") + F.lit(hop.size_ms)).alias("window_end")
    return updates.select(
        "partition", "offset", "user_id", "window_start", window_end, update.alias("_update")
    ).select("partition", "offset", "user_id", "window_start", "window_end", "_update.*")


def current_table(changelog: DataFrame) -> DataFrame:
    """The last update per partition, user and window, folded map-side by hash: the order is one
    number and every value is one ``max_by``, as a struct would need a sort."""
    order = F.col("offset") * 2 + F.col("seq")
    return changelog.groupBy("partition", "user_id", "window_start", "window_end").agg(
        F.max_by("n", order).alias("n"), F.max_by("average_score", order).alias("average_score")
    )
