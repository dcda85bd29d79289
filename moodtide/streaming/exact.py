"""Streams that are as exact as replay: stream time per source partition, one update per record.

Two queries. ``start_pairs`` follows each partition's stream time from record to record: inside a micro-batch by
the running maximum of ``operators.lateness``, over buckets of offsets, and from batch to batch by a table with a row
per partition. It writes every (record, window) pair, those that come too late apart from the others. ``updates``
reads the pairs in time and keeps sum and count per (partition, user, window) in the state store: each pair
gives the window's mean after its record. The users of ``WINDOWS`` windows in a row lie there in ``GROUPS`` rows by their
hash, as Python asks the store once a row and not once a user and window. A window leaves its row when that is written
again after every partition's stream time has closed the window, and a timer ends the row once that holds for all its
windows, so that none is dropped that may still come.

Spark's watermark decides nothing about lateness here. It follows ``low``, the stream time that all
partitions have passed, and does not lead any pair.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from moodtide.operators.lateness import stream_times, windowed_with_lateness
from moodtide.operators.running import BUCKET_BITS
from moodtide.operators.windows import DEFAULT_HOP, Hop
from moodtide.session import rocksdb_state
from moodtide.sources import files
from moodtide.sources.topics import brief, start

# The processor goes to the executors by itself; none has to have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PAIRS = "late BOOLEAN, partition INT, offset BIGINT, user_id STRING, window_start BIGINT, window_end BIGINT, sentiment_score DOUBLE, stream_time BIGINT, low BIGINT"
UPDATES = "partition INT, offset BIGINT, user_id STRING, window_start BIGINT, window_end BIGINT, seq INT, n BIGINT, average_score DOUBLE"
_TIMES = "partition INT, stream_time BIGINT, low BIGINT"
# Rows of state that the users of a partition's windows are dealt to, and how many windows share them. Fixed when a query
# first starts.
GROUPS = 64
WINDOWS = 16


def _batch(path: str, kind: str, batch_id: int) -> str:
    return f"{path}/{kind}/batch={batch_id:020d}"


def _carried(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """The stream times that the batches before this one left."""
    done = [int(name.removeprefix("batch=")) for name in files.names(spark, f"{path}/times") if name.startswith("batch=")]
    before = [n for n in done if n < batch_id]
    return spark.read.schema(_TIMES).parquet(_batch(path, "times", max(before))) if before else None


def _write(df: DataFrame, path: str, kind: str, batch_id: int, *parts: str) -> None:
    """A batch's folder, whole at once; one that is there stays, as a repeated batch would make the same."""
    spark, folder = df.sparkSession, _batch(path, kind, batch_id)
    if files.exists(spark, folder):
        return
    aside = f"{path}/_aside/{kind}-{batch_id:020d}"
    df.write.mode("overwrite").partitionBy(*parts).parquet(aside)
    files.publish_folder(spark, aside, folder)


def mark_batch(
    scored: DataFrame, path: str, batch_id: int, hop: Hop = DEFAULT_HOP, partitions: int | None = None, bucket_bits: int = BUCKET_BITS
) -> None:
    """One micro-batch of ``start_pairs``."""
    spark = scored.sparkSession
    carried = _carried(spark, path, batch_id)
    rows = scored.select("partition", "offset", "user_id", "event_time", "sentiment_score").persist()
    try:
        low = carried.agg(F.max("low")).first()[0] if carried is not None else 0
        pairs = windowed_with_lateness(rows, hop, bucket_bits, carried=carried)
        known = [name.split()[0] for name in PAIRS.split(", ")]
        _write(pairs.withColumn("low", F.lit(low).cast("bigint")).select(*known), path, "pairs", batch_id, "late")
        # As many rows as the topic has partitions.
        after = [tuple(row) for row in stream_times(rows, carried=carried).collect()]
        if partitions is None or len(after) >= partitions:
            low = max(low, min((time for _, time in after), default=0))
        times = spark.createDataFrame([(*row, low) for row in after], _TIMES)
        _write(times.coalesce(1), path, "times", batch_id)
        for name in files.names(spark, f"{path}/times"):
            # A repeat of this batch needs the one before; no batch needs what is older.
            if name.startswith("batch=") and int(name.removeprefix("batch=")) < batch_id - 1:
                files.delete(spark, f"{path}/times/{name}")
    finally:
        rows.unpersist()


def start_pairs(
    scored: DataFrame,
    path: str,
    checkpoint: str,
    hop: Hop = DEFAULT_HOP,
    partitions: int | None = None,
    trigger: dict | None = None,
    name: str | None = None,
    bucket_bits: int = BUCKET_BITS,
) -> StreamingQuery:
    """Scores to (record, window) pairs under ``path``, marked late or not by exact stream time.

    Records of a partition come in offset order from batch to batch, as topics deliver them. ``partitions`` is how many
    the topic has: until all have been seen no window's state ends. Left out, those of the first batch
    count as all; a partition that joins later, with a stream time behind the others', needs it given.
    """
    writer = scored.writeStream.foreachBatch(brief(lambda batch, i: mark_batch(batch, path, i, hop, partitions, bucket_bits)))
    return start(writer, checkpoint, trigger, name)


def read_pairs(spark: SparkSession, path: str, late: bool = False, streaming: bool = False, files_per_trigger: int | None = None) -> DataFrame:
    """The pairs that count, or the late ones."""
    reader = (spark.readStream if streaming else spark.read).schema(PAIRS)
    if streaming and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.option("basePath", f"{path}/pairs").parquet(f"{path}/pairs").filter(F.col("late") == late)


class Updates(StatefulProcessor):
    """Sum and count of each (partition, user, window) of a group of users and some windows, and an update for each record
    in offset order."""

    def __init__(self, closes_ms: int, row_ends_ms: int) -> None:
        # From a window's start to when it closes, and from that of a row's first window to when the last one does.
        self.closes_ms, self.row_ends_ms = closes_ms, row_ends_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        fields = "window_starts ARRAY<BIGINT>, user_ids ARRAY<STRING>, score_sums ARRAY<DOUBLE>, counts ARRAY<BIGINT>"
        self.totals = handle.getValueState("totals", fields)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        partition, first_start, _ = key
        held = self.totals.get()
        # A window that all partitions have passed gets no more pairs.
        passed = timerValues.getCurrentWatermarkInMs() - self.closes_ms
        totals = {(start, user_id): (total, n) for start, user_id, total, n in zip(*held) if start > passed} if held is not None else {}
        # What a micro-batch has of these windows and group; a record has a pair for every window that it lies in.
        some = pd.concat(list(rows)).sort_values(["offset", "window_start"], kind="stable", ignore_index=True)
        if some["sentiment_score"].isna().any():
            raise ValueError("a pair without a score")
        user, user_ids = pd.factorize(some["user_id"])
        window, starts = pd.factorize(some["window_start"])
        number, places = pd.factorize(window * len(user_ids) + user)
        names = [(int(starts[place // len(user_ids)]), user_ids[place % len(user_ids)]) for place in places]
        before = [totals.get(name, (0.0, 0)) for name in names]
        scores = some["sentiment_score"].groupby(number)
        total = np.array([t for t, _ in before])[number] + scores.cumsum().to_numpy()
        n = np.array([n for _, n in before])[number] + scores.cumcount().to_numpy() + 1
        yield pd.DataFrame(
            {
                "partition": partition, "offset": some["offset"], "user_id": some["user_id"], "window_start": some["window_start"],
                "window_end": some["window_end"], "seq": 1, "n": n, "average_score": total / n,
            }
        )
        # A window's and user's last record comes last.
        last = np.zeros(len(names), dtype=np.int64)
        last[number] = np.arange(len(number))
        totals.update(zip(names, zip(total[last].tolist(), n[last].tolist())))
        if held is None:
            self.handle.registerTimer(int(first_start) + self.row_ends_ms)
        window_starts, held_ids = zip(*totals)
        sums, counts = zip(*totals.values())
        self.totals.update((list(window_starts), list(held_ids), list(sums), list(counts)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.totals.clear()
        return iter(())

    def close(self) -> None:
        pass


def updates(pairs: DataFrame, hop: Hop = DEFAULT_HOP, groups: int = GROUPS, windows: int = WINDOWS) -> DataFrame:
    """Streaming pairs in time -> every update of every mean, as ``operators.changelog`` has them in batch. A micro-batch
    rewrites the open windows in the rows of state that it has records of: more ``groups`` rewrite less, and cost more
    calls; more ``windows`` to a row cost fewer calls where a micro-batch spans many, and more memory of a task."""
    span = hop.advance_ms * windows
    # A row at the watermark counts as too late for Spark: a millisecond ahead of it none ever is.
    timed = pairs.withColumn("_low", F.timestamp_millis(F.col("low") + 1)).withWatermark("_low", "1 millisecond")
    start = F.col("window_start")
    timed = timed.withColumns({"_first": start - F.pmod(start, F.lit(span)), "_group": F.pmod(F.xxhash64("user_id"), F.lit(groups)).cast("int")})
    closes = hop.size_ms + hop.grace_ms
    return timed.groupBy("partition", "_first", "_group").transformWithStateInPandas(
        Updates(closes, span - hop.advance_ms + closes), UPDATES, outputMode="Append", timeMode="EventTime"
    )


def start_updates(
    pairs: DataFrame, path: str, checkpoint: str, hop: Hop = DEFAULT_HOP, trigger: dict | None = None, name: str | None = None
) -> StreamingQuery:
    """Every update to Parquet under ``path``, exactly once."""
    with rocksdb_state(pairs.sparkSession):
        made = updates(pairs, hop)
        return start(made.writeStream.format("parquet").outputMode("append").option("path", path), checkpoint, trigger, name)
