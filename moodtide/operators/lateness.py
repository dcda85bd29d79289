"""Exact late-row handling in batch replay.

Stream time is, per source partition, the highest event time seen so far in offset order, the
row itself included. Event time is the record's own unless ``time_col`` names another column. A (row, window) pair is late once ``window_end + grace <= stream_time``.
Rows without a key neither count nor move stream time.

A topic has few partitions, so nothing runs per partition: offsets are cut into buckets of
``2**bucket_bits``, rows are shuffled by (partition, bucket), and a table with one row per bucket
brings in the highest time of the buckets before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtide.operators.running import BUCKET_BITS, bucket_of
from moodtide.operators.windows import DEFAULT_HOP, Hop, explode_windows, millis_of


def _required(df: DataFrame, column: str) -> Column:
    """The column, failing the job on a NULL: replay needs every record's place in its topic."""
    missing = F.raise_error(F.lit(f"replay needs {column}, which a record does not have"))
    return F.coalesce(F.col(column), missing.cast(dict(df.dtypes)[column]))


def with_stream_time(
    df: DataFrame, bucket_bits: int = BUCKET_BITS, time_col: str = "event_time", carried: DataFrame | None = None
) -> DataFrame:
    """Add ``stream_time`` (ms) to ``partition, offset, user_id, ...``, and what tells how far a row's
    bucket overlaps others in time: ``bucket``, ``earlier_max`` and ``later_min``, the highest event
    time of the partition's earlier buckets and the lowest of its later ones.

    Rows without a key are dropped, by rule; one without partition, offset or time fails the job.
    ``carried`` has the ``partition, stream_time`` that records before these left, a row per partition.
    """
    keyed = df.filter(F.col("user_id").isNotNull())
    placed = keyed.withColumns({name: _required(df, name) for name in ("partition", "offset", time_col)})
    rows = placed.withColumns({"bucket": bucket_of(F.col("offset"), bucket_bits), "_millis": millis_of(placed, time_col)})
    # Said here for every branch that follows; left to Spark, only the inner sides of joins get
    # some of these filters, and their shuffles then differ from the others and are not reused.
    for column in ("partition", "bucket", "_millis"):
        rows = rows.filter(F.col(column).isNotNull())
    # Narrow and map-side: this pass reads four columns and shuffles a row per task and bucket.
    extent = rows.groupBy("partition", "bucket").agg(F.max("_millis").alias("_max"), F.min("_millis").alias("_min"))
    # Both frames look back, the second over the buckets in reverse: a frame that looks forward
    # to the end is worked out anew for every row.
    by_bucket = Window.partitionBy("partition")
    before = by_bucket.orderBy(F.col("bucket").asc()).rowsBetween(Window.unboundedPreceding, -1)
    after = by_bucket.orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    bounds = extent.select(
        "partition",
        "bucket",
        F.max("_max").over(before).alias("earlier_max"),
        F.min("_min").over(after).alias("later_min"),
    )
    if carried is not None:
        left = carried.select("partition", F.col("stream_time").alias("_left"))
        bounds = bounds.join(left, "partition", "left").withColumn("earlier_max", F.greatest("earlier_max", "_left")).drop("_left")
    inside = Window.partitionBy("partition", "bucket").orderBy("offset")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = rows.withColumn("_here", F.max("_millis").over(inside))
    joined = running.join(bounds, ["partition", "bucket"], "left")
    return joined.withColumn("stream_time", F.greatest("earlier_max", "_here")).select(
        *df.columns, "stream_time", "bucket", "earlier_max", "later_min"
    )


def is_late(hop: Hop) -> Column:
    return F.col("window_end") + F.lit(hop.grace_ms) <= F.col("stream_time")


def spans_buckets() -> Column:
    """False only where a (user, window) has no row in any other bucket of its partition: the
    window lies after all that came in earlier buckets and before all that comes in later ones."""
    return (F.col("window_start") <= F.col("earlier_max")) | (F.col("window_end") > F.col("later_min"))


def windowed_in_time(
    df: DataFrame, hop: Hop = DEFAULT_HOP, bucket_bits: int = BUCKET_BITS, time_col: str = "event_time"
) -> DataFrame:
    """The (row, window) pairs that count."""
    return _windowed(df, hop, bucket_bits, time_col).filter(~is_late(hop))


def windowed_late(
    df: DataFrame, hop: Hop = DEFAULT_HOP, bucket_bits: int = BUCKET_BITS, time_col: str = "event_time"
) -> DataFrame:
    """The (row, window) pairs that come too late, with the stream time that closed them."""
    return _windowed(df, hop, bucket_bits, time_col).filter(is_late(hop))


def windowed_with_lateness(
    df: DataFrame, hop: Hop = DEFAULT_HOP, bucket_bits: int = BUCKET_BITS, time_col: str = "event_time", carried: DataFrame | None = None
) -> DataFrame:
    """All (row, window) pairs, with ``late``. ``carried`` as in ``with_stream_time``."""
    pairs = explode_windows(with_stream_time(df, bucket_bits, time_col, carried), hop, time_col)
    return pairs.withColumn("late", is_late(hop))


def stream_times(df: DataFrame, time_col: str = "event_time", carried: DataFrame | None = None) -> DataFrame:
    """``partition, stream_time`` after these records: a map-side maximum, a row per partition."""
    times = df.filter(F.col("user_id").isNotNull()).select("partition", millis_of(df, time_col).alias("stream_time"))
    times = times if carried is None else times.unionByName(carried.select("partition", "stream_time"))
    return times.groupBy("partition").agg(F.max("stream_time").alias("stream_time"))


def _windowed(df: DataFrame, hop: Hop, bucket_bits: int, time_col: str) -> DataFrame:
    return explode_windows(with_stream_time(df, bucket_bits, time_col), hop, time_col)
