"""Scores stored by user, so that what is aggregated per user needs no shuffle (A1).

A topic is partitioned by key before it reaches the dataflow, so the windowed aggregates there never
repartition. The same on Spark: a table bucketed by user. Window sums, counts and means over it, and the join of
these, read each bucket in one task and exchange nothing.

A bucket is one task's work: store with as many buckets as the aggregation should have tasks. Where one user holds
much of the rows, ``pipeline.window_means`` over plain files is the better plan: its partial sums split the user.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moodtide.operators.windows import DEFAULT_HOP, FLAT, Hop, explode_windows, join_sum_count, window_count, window_mean, window_sum

USER = "user_id"


def store_by_user(scored: DataFrame, table: str, buckets: int, path: str | None = None) -> DataFrame:
    """Write scores as the catalog table ``table``, one file a bucket, and read it back. Rows without a user are left
    out, as no aggregate counts them."""
    dealt = scored.filter(scored[USER].isNotNull()).repartition(buckets, USER)
    writer = dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, USER).sortBy(USER)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return by_user(scored.sparkSession, table)


def by_user(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def keyed_means(stored: DataFrame, hop: Hop = DEFAULT_HOP, time_col: str = "event_time") -> DataFrame:
    """``user_id, window_start, window_end, score_sum, n, average_score``, without an exchange: windows by ``explode``,
    as the plan behind ``window`` forgets how its input is stored."""
    return window_mean(explode_windows(stored, hop, time_col), window=FLAT)


def keyed_join(stored: DataFrame, hop: Hop = DEFAULT_HOP, time_col: str = "event_time") -> DataFrame:
    """The same from sums and counts joined (J1): both sides and the join stay in their buckets."""
    windowed = explode_windows(stored, hop, time_col)
    return join_sum_count(window_sum(windowed, window=FLAT), window_count(windowed, window=FLAT), window=FLAT)
