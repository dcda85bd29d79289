"""Hopping windows and their sum, count and mean per key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Hop:
    """A hopping window: its size, how far apart windows start, and the lateness allowed."""

    size_ms: int = 60_000
    advance_ms: int = 30_000
    grace_ms: int = 30_000

    def __post_init__(self) -> None:
        if not 0 < self.advance_ms <= self.size_ms:
            raise ValueError("need 0 < advance_ms <= size_ms")
        if self.grace_ms < 0:
            raise ValueError("grace_ms is not negative")

    @property
    def grace(self) -> str:
        return f"{self.grace_ms} milliseconds"

    def column(self, time: Column) -> Column:
        return F.window(time, f"{self.size_ms} milliseconds", f"{self.advance_ms} milliseconds")


DEFAULT_HOP = Hop()


def assign_windows(df: DataFrame, hop: Hop = DEFAULT_HOP, time_col: str = "event_time") -> DataFrame:
    """One row per (row, window): ``[start, end)``, starts at multiples of the advance from the
    epoch. Windows that would start before the epoch do not exist."""
    windowed = df.withColumn("window", hop.column(F.col(time_col)))
    return windowed.filter(F.col("window.start") >= F.timestamp_millis(F.lit(0)))


def flatten_window(df: DataFrame) -> DataFrame:
    """``window`` struct -> ``window_start``, ``window_end`` in epoch milliseconds."""
    bounds = {"window_start": F.unix_millis("window.start"), "window_end": F.unix_millis("window.end")}
    return df.withColumns(bounds).drop("window")


def millis_of(df: DataFrame, time_col: str) -> Column:
    """A time column in epoch milliseconds, whether it is a timestamp or that already."""
    return F.unix_millis(time_col) if dict(df.dtypes)[time_col] == "timestamp" else F.col(time_col)


def explode_windows(df: DataFrame, hop: Hop = DEFAULT_HOP, time_col: str = "event_time") -> DataFrame:
    """The same windows as ``window_start``, ``window_end``, by exploding.

    For batch work behind a shuffle: ``explode`` keeps the partitioning its input has, which the
    ``Expand`` behind ``window`` does not.
    """
    time = millis_of(df, time_col)
    last = time - F.pmod(time, F.lit(hop.advance_ms))
    earlier = F.floor((F.lit(hop.size_ms - 1) - (time - last)) / hop.advance_ms) * hop.advance_ms
    starts = F.sequence(F.greatest(last - earlier, F.lit(0)), last, F.lit(hop.advance_ms).cast("bigint"))
    exploded = df.filter(time >= 0).withColumn("window_start", F.explode(starts))
    return exploded.withColumn("window_end", F.col("window_start") + F.lit(hop.size_ms))


def mean_of(total: Column, n: Column) -> Column:
    """``total / n``, and 0 for nothing counted."""
    return F.when(n == 0, F.lit(0.0)).otherwise(F.try_divide(total, n))


# How a frame names its windows: as the struct of ``assign_windows``, which a stream needs, or flat.
STRUCT = ("window",)
FLAT = ("window_start", "window_end")


def window_aggregate(
    windowed: DataFrame, *aggregates: Column, keys: Sequence[str] = ("user_id",), window: Sequence[str] = STRUCT
) -> DataFrame:
    """Any aggregates per key and window; rows without a key do not count (U4). Built-in ones
    fold map-side; a grouped-aggregate ``pandas_udf`` does not, and takes each group whole."""
    present = windowed
    for key in keys:
        present = present.filter(F.col(key).isNotNull())
    return present.groupBy(*keys, *window).agg(*aggregates)


def window_sum(
    windowed: DataFrame,
    keys: Sequence[str] = ("user_id",),
    score_col: str = "sentiment_score",
    window: Sequence[str] = STRUCT,
) -> DataFrame:
    """Score total per key and window."""
    return window_aggregate(windowed, F.sum(score_col).alias("score_sum"), keys=keys, window=window)


def window_count(windowed: DataFrame, keys: Sequence[str] = ("user_id",), window: Sequence[str] = STRUCT) -> DataFrame:
    """Rows per key and window."""
    return window_aggregate(windowed, F.count("*").alias("n"), keys=keys, window=window)


def window_mean(
    windowed: DataFrame,
    keys: Sequence[str] = ("user_id",),
    score_col: str = "sentiment_score",
    window: Sequence[str] = STRUCT,
) -> DataFrame:
    """Sum, count and mean in one aggregation: one shuffle of map-side partial sums, so a key
    that holds much of the input still sends one row per task and window. Batch and streaming.
    """
    both = F.sum(score_col).alias("score_sum"), F.count("*").alias("n")
    totals = window_aggregate(windowed, *both, keys=keys, window=window)
    return totals.withColumn("average_score", mean_of(F.col("score_sum"), F.col("n")))


def join_sum_count(
    sums: DataFrame, counts: DataFrame, keys: Sequence[str] = ("user_id",), window: Sequence[str] = STRUCT
) -> DataFrame:
    """The mean as a join of two keyed tables. Both sides hold one row per (key, window) and are
    already partitioned on the join columns. ``window_mean`` gives the same with one aggregation
    and also works on a stream in update mode; this join works on streams in append mode."""
    joined = sums.join(counts, [*keys, *window], "inner")
    return joined.withColumn("average_score", mean_of(F.col("score_sum"), F.col("n")))
