"""The event and text tables as the chat data model sees them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.functions.timecols import epoch_millis, event_time

DAY_MS = 86_400_000

# The message that stands for each event type; any other type has OTHER_MESSAGE.
EVENT_MESSAGES = {
    "purchase": "今天天气真不错！",
    "signup": "很高兴能和大家一起工作。",
    "error": "太难过了",
    "click": "工作压力不好",
}
OTHER_MESSAGE = "需要进一步优化。"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_message(event_type: Column) -> Column:
    message = F.lit(OTHER_MESSAGE)
    for kind, text in EVENT_MESSAGES.items():
        message = F.when(event_type == kind, F.lit(text)).otherwise(message)
    return message


def events_as_chat(events: DataFrame, hold_back_every: int | None = None, hold_back_ms: int = 3 * DAY_MS) -> DataFrame:
    """``user_id, partition, offset, timestamp, event_time, message`` of the event table, batch or
    streaming. ``hold_back_every=7`` dates every seventh event ``hold_back_ms`` earlier while
    leaving its offset alone: late arrivals to test with."""
    millis = epoch_millis(F.col("ts"))
    if hold_back_every:
        late = F.col("event_id") % hold_back_every == 0
        millis = millis - F.when(late, F.lit(hold_back_ms)).otherwise(F.lit(0))
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        millis.alias("timestamp"),
        event_message(F.col("event_type")).alias("message"),
    ).withColumn("event_time", event_time(F.col("timestamp")))


def chat(spark: SparkSession, sf_dir: str, hold_back_every: int | None = None) -> DataFrame:
    return events_as_chat(table(spark, sf_dir, "events"), hold_back_every)


# Rows of a slice of the event table that one file, and so one task, takes at most.
ROWS_PER_FILE = 1 << 20


def in_slices(events: DataFrame, path: str, slices: int, repeats: int = 0) -> int:
    """The event table written under ``path`` as that many slices, one after the other by event id, so that a
    stream takes them in event order: slice ``n`` holds ids ``i`` with ``(i - first) * slices div
    (last - first + 1) = n``, and the first one those without an id. With ``repeats`` each holds the rows of so
    many slices before it again, as a source does that delivers twice. Gives the files of a slice, as many for
    each as the largest needs: what a stream has to take a micro-batch to get them one by one."""
    first, last = events.agg(F.min("event_id"), F.max("event_id")).first()
    slice_of = F.coalesce(F.floor((F.col("event_id") - first) * slices / (last - first + 1)), F.lit(0)) if first is not None else F.lit(0)
    sizes = events.groupBy(slice_of.alias("slice")).count().agg(F.max("count")).first()[0] or 0
    each = max(1, -(-sizes * (1 + repeats) // ROWS_PER_FILE))
    # The table is dealt to a folder a slice in one pass: a filter of its own for every slice would read it all each time.
    aside = f"{path.rstrip('/')}-aside"
    events.withColumn("_slice", slice_of.cast("int")).write.partitionBy("_slice").parquet(aside)
    dealt = events.sparkSession.read.schema(events.withColumn("_slice", F.lit(0)).schema).parquet(aside)
    for n in range(slices):
        some = dealt.filter(F.col("_slice").between(n - repeats, n)).drop("_slice")
        # An empty partition gives no file: rows are dealt evenly, and there are more rows than files.
        some = some.coalesce(1) if each == 1 else some.repartition(each)
        some.write.mode("append").parquet(path)
    return each


def chat_stream_of(
    spark: SparkSession, schema, path: str, files_per_trigger: int = 1, hold_back_every: int | None = None
) -> DataFrame:
    """A folder of event files as a stream, so many files a micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return events_as_chat(reader.parquet(path), hold_back_every)


def chat_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The event table as a stream, whether it is one file or a folder of files."""
    reader = spark.readStream.schema(table(spark, sf_dir, "events").schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # A file source takes a single file only by way of a pattern.
    return events_as_chat(reader.parquet(f"{sf_dir.rstrip('/')}/[e]vents.parquet"))
