"""Streams held against replay, the state store, repeated records, metrics."""

from __future__ import annotations

import os
import random
import subprocess
import sys

import pyspark
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from moodtide.operators import changelog, duplicates, lateness
from moodtide.operators.windows import Hop
from moodtide.plans import pipeline
from moodtide.sources import files
from moodtide.sources.topics import ALL_AVAILABLE
from moodtide.streaming import exact, metrics, state
from moodtide.streaming import queries as streams

HOP = Hop(60_000, 30_000, 30_000)
SCHEMA = "partition INT, offset BIGINT, user_id STRING, ms BIGINT, sentiment_score DOUBLE"


def made_rows(n, seed=5):
    """Records of three partitions that jump back and forth in time; some have no user."""
    rng, clock = random.Random(seed), [1_700_000_000_000] * 3
    for i in range(n):
        part = rng.randrange(3)
        clock[part] += rng.randrange(20_000)
        user = None if rng.random() < 0.05 else f"{part}-{rng.randrange(4)}"
        yield part, i, user, clock[part] - rng.randrange(150_000) * (rng.random() < 0.3), rng.choice([0.8, -0.6, 0.0])


def as_scores(df):
    return df.withColumn("event_time", F.timestamp_millis("ms")).drop("ms")


def write(spark, folder, number, rows):
    path = folder / f"{number:03d}"
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(path))
    for name in os.listdir(path):
        os.utime(path / name, (1_700_000_000 + number, 1_700_000_000 + number))


def stream(spark, folder):
    reader = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
    return as_scores(reader.parquet(str(folder)))


def plain(df):
    cols = ["partition", "offset", "user_id", "window_start", "window_end", "seq", "n"]
    return sorted((*(row[c] for c in cols), round(row.average_score, 6)) for row in df.collect())


def test_stream_gives_the_replayed_log_over_restarts(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    rows, done = list(made_rows(400)), 0
    for number, upto in enumerate([90, 100, 250, 400]):
        write(spark, folder, number, rows[done:upto])
        done = upto
        if number in (1, 3):
            # Each run takes up where the one before stopped.
            exact.start_pairs(stream(spark, folder), out, f"{out}/a", HOP, 3, ALL_AVAILABLE, bucket_bits=4).awaitTermination()
            pairs = exact.read_pairs(spark, out, streaming=True)
            query = exact.start_updates(pairs, f"{out}/log", f"{out}/b", HOP, ALL_AVAILABLE)
            query.awaitTermination()
    replayed = as_scores(spark.createDataFrame(rows, SCHEMA))
    in_time = lateness.windowed_in_time(replayed, HOP)
    assert plain(spark.read.schema(exact.UPDATES).parquet(f"{out}/log")) == plain(changelog.alert_changelog(in_time, HOP))
    late = {tuple(r) for r in lateness.windowed_late(replayed, HOP).select("offset", "window_start", "stream_time").collect()}
    assert late and late == {tuple(r) for r in exact.read_pairs(spark, out, late=True).select("offset", "window_start", "stream_time").collect()}
    # Windows that every partition has passed are out of the state.
    held = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    windows = in_time.select("partition", "user_id", "window_start").distinct().count()
    # A window's state is a row of totals and one or two of its timer.
    assert held[-1] < windows


def test_users_of_a_window_share_rows_of_state(spark, tmp_path):
    """As many rows of state as groups, however many users, and still an update a record, over two micro-batches."""
    rng, out, base = random.Random(3), str(tmp_path / "out"), 1_700_000_000_000
    rows = [(0, i, f"u{i % 400}", base + rng.randrange(30_000), rng.choice([0.8, -0.6])) for i in range(1000)]
    folder = tmp_path / "in"
    folder.mkdir()
    write(spark, folder, 0, rows[:600])
    write(spark, folder, 1, rows[600:])
    exact.start_pairs(stream(spark, folder), out, f"{out}/a", HOP, 1, ALL_AVAILABLE).awaitTermination()
    pairs = exact.read_pairs(spark, out, streaming=True, files_per_trigger=1)
    query = exact.start_updates(pairs, f"{out}/log", f"{out}/b", HOP, ALL_AVAILABLE)
    query.awaitTermination()
    in_time = lateness.windowed_in_time(as_scores(spark.createDataFrame(rows, SCHEMA)), HOP)
    assert plain(spark.read.schema(exact.UPDATES).parquet(f"{out}/log")) == plain(changelog.alert_changelog(in_time, HOP))
    held = max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"])
    assert 0 < held < in_time.select("partition", "user_id", "window_start").distinct().count()


def test_windows_in_a_row_share_rows_of_state(spark, tmp_path):
    """Fewer rows of state than windows, over two micro-batches that meet the same windows; what is written again has
    open windows only."""
    base, folder, out = 1_700_000_000_000, tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    rows = [(0, i, "a", base + i * 10_000, 0.8 if i % 3 else -0.6) for i in range(300)]
    for number, (first, last) in enumerate([(0, 130), (130, 135), (135, 300)]):
        write(spark, folder, number, rows[first:last])
    exact.start_pairs(stream(spark, folder), out, f"{out}/a", HOP, 1, ALL_AVAILABLE, bucket_bits=4).awaitTermination()
    pairs = exact.read_pairs(spark, out, streaming=True, files_per_trigger=1)
    query = exact.start_updates(pairs, f"{out}/log", f"{out}/b", HOP, ALL_AVAILABLE)
    query.awaitTermination()
    in_time = lateness.windowed_in_time(as_scores(spark.createDataFrame(rows, SCHEMA)), HOP)
    assert plain(spark.read.schema(exact.UPDATES).parquet(f"{out}/log")) == plain(changelog.alert_changelog(in_time, HOP))
    # A row for the totals of 16 windows, and two or less of its timer.
    held = max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"])
    assert 0 < held <= 3 * (in_time.select("window_start").distinct().count() // exact.WINDOWS + 2)
    kept = spark.read.format("statestore").option("stateVarName", "totals").load(f"{out}/b")
    starts = sorted(start for row in kept.select("value.window_starts").collect() for start in row.window_starts)
    # Batches tell what the ones before have passed, and rows of state that no record comes to wait for their timer.
    assert starts and min(starts) > base


def test_the_processor_needs_no_package_where_it_goes():
    """Workers that cannot import this package take it."""
    lines = f"import pickle; pickle.loads({cloudpickle.dumps(exact.Updates(90_000, 540_000))!r})"
    # Isolated: neither this folder nor PYTHONPATH is searched.
    lines = f"import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(pyspark.__file__))!r}); {lines}"
    subprocess.run([sys.executable, "-I", "-c", lines], check=True, cwd="/")


def test_a_repeated_batch_is_the_same_batch(spark, tmp_path):
    out, rows = str(tmp_path / "out"), list(made_rows(60))
    batches = [as_scores(spark.createDataFrame(part, SCHEMA)) for part in (rows[:20], rows[20:40], rows[40:])]
    for number, batch in enumerate(batches):
        exact.mark_batch(batch, out, number, HOP)
        before = files.names(spark, f"{out}/pairs/batch={number:020d}/late=false")
        # As after a crash that came before the query's own commit, or between the two writes.
        files.delete(spark, f"{out}/times/batch={number:020d}")
        exact.mark_batch(batch, out, number, HOP)
        assert files.names(spark, f"{out}/pairs/batch={number:020d}/late=false") == before
    whole = lateness.windowed_in_time(as_scores(spark.createDataFrame(rows, SCHEMA)), HOP)
    pick = ("offset", "window_start", "stream_time")
    assert sorted(map(tuple, exact.read_pairs(spark, out).select(*pick).collect())) == sorted(map(tuple, whole.select(*pick).collect()))


def test_state_waits_for_every_partition(spark, tmp_path):
    """A partition that is far behind keeps its windows however far the others are."""
    out = str(tmp_path / "out")
    base = 1_700_000_000_000
    parts = [[(0, 0, "a", base + 900_000, 0.8)], [(1, 1, "b", base, 0.8)], [(0, 2, "a", base + 990_000, 0.8)], [(1, 3, "b", base + 1, -0.6)]]
    folder = tmp_path / "in"
    folder.mkdir()
    for number, rows in enumerate(parts):
        write(spark, folder, number, rows)
    exact.start_pairs(stream(spark, folder), out, f"{out}/a", HOP, 2, ALL_AVAILABLE).awaitTermination()
    pairs = exact.read_pairs(spark, out, streaming=True, files_per_trigger=1)
    exact.start_updates(pairs, f"{out}/log", f"{out}/b", HOP, ALL_AVAILABLE).awaitTermination()
    last = spark.read.schema(exact.UPDATES).parquet(f"{out}/log").filter("user_id = 'b' AND n = 2")
    assert {round(r.average_score, 6) for r in last.collect()} == {0.1} and last.count() == 2


def test_records_once(spark):
    rows = [(0, 1, "a", 1, 0.8), (0, 1, "a", 1, 0.8), (1, 1, "a", 1, 0.8), (None, 1, "b", 1, 0.8), (None, 1, "b", 1, 0.8), (0, None, "c", 1, 0.8)]
    got = duplicates.once(as_scores(spark.createDataFrame(rows, SCHEMA)), "30 seconds").collect()
    assert sorted(str(r.partition) for r in got) == ["0", "0", "1", "None", "None"]
    assert duplicates.once(as_scores(spark.createDataFrame([], SCHEMA)), "30 seconds").count() == 0


def test_repeats_cost_state_for_the_delay_only(spark, tmp_path):
    folder, base = tmp_path / "in", 1_700_000_000_000
    folder.mkdir()
    rows = [(0, i, "a", base + i * 60_000, 0.8) for i in range(100)]
    for number in range(10):
        some = rows[number * 10 : number * 10 + 10]
        write(spark, folder, number, some + rows[max(0, number * 10 - 10) : number * 10])
    alerts = streams.alert_stream_once(stream(spark, folder), HOP)
    query = streams.start_final(alerts, str(tmp_path / "out"), str(tmp_path / "cp"), ALL_AVAILABLE)
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    whole = pipeline.window_means(as_scores(spark.createDataFrame(rows, SCHEMA)), HOP)
    final = whole.filter(F.col("window_end") + HOP.grace_ms <= rows[-1][3]).select("window_end", "average_score")
    assert sorted(map(tuple, got.select("window_end", "average_score").collect())) == sorted(map(tuple, final.collect()))
    kept = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"] if s["operatorName"] == "dedupeWithinWatermark"]
    assert kept and kept[-1] <= 3 and max(kept) <= 20


def test_joined_streams_keep_state_within_the_watermark(spark, tmp_path):
    folder, base = tmp_path / "in", 1_700_000_000_000
    folder.mkdir()
    for number in range(6):
        write(spark, folder, number, [(0, i, f"u{i % 3}", base + number * 600_000 + i * 1000, 0.8) for i in range(30)])
    alerts = streams.joined_alert_stream(stream(spark, folder), HOP)
    query = streams.start_final(alerts, str(tmp_path / "out"), str(tmp_path / "cp"), ALL_AVAILABLE)
    query.awaitTermination()
    single = streams.start_final(streams.alert_stream(stream(spark, folder), HOP), str(tmp_path / "one"), str(tmp_path / "cp1"), ALL_AVAILABLE)
    single.awaitTermination()
    pick = ("user_id", "window_end", "average_score")
    got, want = (sorted(map(tuple, spark.read.parquet(str(tmp_path / d)).select(*pick).collect())) for d in ("out", "one"))
    assert got and got == want
    assert max(s["numRowsTotal"] for p in query.recentProgress[-1:] for s in p["stateOperators"]) <= 9


def test_state_store_tells_the_table_after_each_batch(spark, tmp_path):
    folder, base = tmp_path / "in", 1_700_000_000_000
    folder.mkdir()
    rows = [[(0, 0, "a", base, 0.8)], [(0, 1, "a", base + 1, -0.6)], [(0, 2, "b", base + 2, 0.0)]]
    for number, some in enumerate(rows):
        write(spark, folder, number, some)
    checkpoint = str(tmp_path / "cp")
    streams.start_change_log(streams.alert_stream(stream(spark, folder), HOP), str(tmp_path / "log"), checkpoint, ALL_AVAILABLE).awaitTermination()
    first, last = state.batches(spark, checkpoint)
    assert first == 0 and last >= 2
    for batch in (0, 1, 2):
        got = state.open_means(spark, checkpoint, batch)
        upto = as_scores(spark.createDataFrame([row for some in rows[: batch + 1] for row in some], SCHEMA))
        pick = ("user_id", "window_start", "window_end", "n", "average_score")
        assert sorted(map(tuple, got.select(*pick).collect())) == sorted(map(tuple, pipeline.window_means(upto, HOP).select(*pick).collect()))


def test_metrics_of_each_batch_are_logged_once(spark, tmp_path):
    from types import SimpleNamespace

    from pyspark.sql import Row

    log = metrics.MetricsLog(spark, str(tmp_path / "metrics"))
    assert metrics.read_metrics(spark, str(tmp_path / "metrics")).count() == 0
    for batch, n in [(0, 5), (1, 7), (1, 7), (2, None)]:
        progress = SimpleNamespace(id="q", name="mood", batchId=batch, observedMetrics={"scores": Row(messages=n)})
        log.onQueryProgress(SimpleNamespace(progress=progress))
    rows = metrics.read_metrics(spark, str(tmp_path / "metrics")).orderBy("batch_id").collect()
    assert [(r.query_id, r.query_name, r.batch_id, r.metric, r.value) for r in rows] == [
        ("q", "mood", 0, "messages", 5.0), ("q", "mood", 1, "messages", 7.0), ("q", "mood", 2, "messages", None)
    ]


@pytest.mark.parametrize("text", ["", "zwei\nZeilen"])
def test_text_files_are_published_once(spark, tmp_path, text):
    path = f"{tmp_path}/a/file"
    assert files.publish_text(spark, path, text) and not files.publish_text(spark, path, "other")
    assert files.read_text(spark, path) == text and files.names(spark, f"{tmp_path}/a") == ["file"]
