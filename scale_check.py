"""How run time grows with the data, with one user holding a third of all rows.

Widens the event table by ``SCALE_FACTORS`` (rows per event) into the working folder, then times the
main jobs over each size. ``python scale_check.py``; prints one line per size and job.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moodtide.operators.windows import Hop
from moodtide.plans import pipeline
from moodtide.session import local_session, work_dir
from moodtide.sources.tables import chat

JOBS = {
    "warning_alerts": lambda df: pipeline.warning_alerts(df),
    "warning_alerts, 1 day": lambda df: pipeline.warning_alerts(df, Hop(86_400_000, 43_200_000, 43_200_000)),
    "replayed_alerts": lambda df: pipeline.replayed_alerts(df),
    "replayed_changelog": lambda df: pipeline.replayed_changelog(df),
}


def widened(spark: SparkSession, sf_dir: str, factor: int) -> DataFrame:
    """Every event ``factor`` times, a second apart, by further users; every third row by one user."""
    copies = chat(spark, sf_dir, hold_back_every=7).withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))
    offset = F.col("offset") * factor + F.col("_copy")
    hot = offset % 3 == 0
    user = F.when(hot, F.lit("hot")).otherwise(F.concat_ws("-", "user_id", F.col("_copy") % 97))
    millis = F.col("timestamp") + F.col("_copy") * 1000
    return copies.select(
        user.alias("user_id"),
        F.when(hot, F.lit(0)).otherwise(F.col("partition")).alias("partition"),
        offset.alias("offset"),
        millis.alias("timestamp"),
        "message",
        F.timestamp_millis(millis).alias("event_time"),
    )


def digest(updates: DataFrame) -> tuple[int, int]:
    """How many rows, and a sum of their hashes that does not depend on their order."""
    mean = F.round("average_score", 6)
    hashed = F.xxhash64("partition", "offset", "user_id", "window_start", "seq", "n", mean).cast("decimal(38, 0)")
    return tuple(updates.agg(F.count("*"), F.sum(hashed)).first())


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    factors = [int(f) for f in os.environ.get("SCALE_FACTORS", "1,10,100").split(",")]
    spark = local_session(cpus, shuffle_partitions=32, app="moodtide-scale")
    for factor in factors:
        path = work_dir(spark, f"events-x{factor}")
        widened(spark, sf_dir, factor).write.parquet(path)
        rows = spark.read.parquet(path).count()
        for name, job in JOBS.items():
            start = time.perf_counter()
            job(spark.read.parquet(path)).write.format("noop").mode("overwrite").save()
            seconds = time.perf_counter() - start
            print(f"{rows:>11,} rows  {name:<24} {seconds:7.2f} s  {rows / seconds:>12,.0f} rows/s", flush=True)
        # Many small buckets and few large ones give the same log.
        few, many = (digest(pipeline.replayed_changelog(spark.read.parquet(path), bucket_bits=bits)) for bits in (20, 12))
        assert few == many, (few, many)
        print(f"{rows:>11,} rows  {few[0]:,} updates, the same with buckets of 2**12 and 2**20 offsets", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
