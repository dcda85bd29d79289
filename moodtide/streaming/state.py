"""The current table out of a running or stopped query's state store.

A windowed aggregation keeps one row per (key, window) in its state store until the watermark closes the window;
each commit is a version of that table. Spark reads it from the checkpoint, as of any batch whose state is kept
(``spark.sql.streaming.minBatchesToRetain``), without the query taking part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.operators.windows import mean_of


def state_rows(spark: SparkSession, checkpoint: str, batch_id: int | None = None, operator: int = 0) -> DataFrame:
    """``key, value`` of a stateful operator, the first unless numbered, after that batch or the last one."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    return reader.load(checkpoint)


def open_means(spark: SparkSession, checkpoint: str, batch_id: int | None = None, operator: int = 0) -> DataFrame:
    """``user_id, window_start, window_end, score_sum, n, average_score`` of the windows that are still open: the state of
    ``streaming.queries.alert_stream``, whose one aggregation keeps sum and count."""
    rows = state_rows(spark, checkpoint, batch_id, operator)
    total, n = (F.col("value").getField(name) for name in rows.schema["value"].dataType.names[:2])
    key = rows.schema["key"].dataType.names
    flat = rows.select(
        F.col("key")[key[0]].alias("user_id"),
        F.unix_millis(F.col("key")[key[1]]["start"]).alias("window_start"),
        F.unix_millis(F.col("key")[key[1]]["end"]).alias("window_end"),
        total.alias("score_sum"),
        n.cast("bigint").alias("n"),
    )
    return flat.withColumn("average_score", mean_of(F.col("score_sum"), F.col("n")))


def batches(spark: SparkSession, checkpoint: str, operator: int = 0) -> tuple[int, int]:
    """The first and last batch whose state can be read."""
    meta = spark.read.format("state-metadata").load(checkpoint).filter(F.col("operatorId") == operator)
    row = meta.agg(F.min("minBatchId"), F.max("maxBatchId")).first()
    return row[0], row[1]
