from __future__ import annotations

import datetime as dt
import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from moodtide.functions.codec import split_windowed_key
from moodtide.operators.alerts import observe_alerts
from moodtide.plans import pipeline
from moodtide.session import work_dir
from moodtide.sources import records, topics
from moodtide.streaming import queries as streams

BASE = 1_700_000_040_000
MADE = dt.datetime(2024, 2, 1)
# One micro-batch per line, (seconds after BASE, score).
BATCHES = [
    [(1, 0.8), (2, -0.6)],
    [(120, 0.0)],
    [(119, 0.0)],
    [(3, 0.8), (59, 0.8), (61, 0.8)],
]


def write_batch(folder, number, rows):
    """One file of scores; modification times give the order in which the stream takes files."""
    path = folder / f"{number:03d}.json"
    lines = [json.dumps({"user_id": "u", "ms": BASE + s * 1000, "sentiment_score": score}) for s, score in rows]
    path.write_text("\n".join(lines))
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


def score_stream(spark, folder):
    reader = spark.readStream.schema("user_id STRING, ms BIGINT, sentiment_score DOUBLE").option("maxFilesPerTrigger", 1)
    return reader.json(str(folder)).withColumn("event_time", F.timestamp_millis("ms"))


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def run(query):
    query.awaitTermination()
    return query


def relative(row):
    return ((row.window_end_ts - BASE) // 1000, float(row.average_score))


def test_updates_and_late_rows_batch_by_batch(spark, folder):
    """The late rows of the last batch count only where their window is still open."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for number, rows in enumerate(BATCHES):
        write_batch(folder / "in", number, rows)
    alerts = streams.alert_stream(score_stream(spark, folder / "in"))
    out = str(folder / "log")
    query = run(streams.start_change_log(alerts, out, str(folder / "cp"), topics.ALL_AVAILABLE, MADE))

    changes = records.read_changes(spark, out)
    got = {}
    for row in changes.collect():
        got.setdefault(row.batch_id, set()).add(relative(row))
    assert got[0] == {(30, 0.1), (60, 0.1)}
    assert got[1] == {(150, 0.0), (180, 0.0)}
    assert got[2] == {(120, 0.0), (150, 0.0)}
    # (61 s, window ending 120): 119 s scored 0 before, so the mean is 0.4.
    assert got[3] == {(120, 0.4)}

    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert dropped == 3
    state = query.recentProgress[0]["stateOperators"][0]["customMetrics"]
    assert any(name.startswith("rocksdb") for name in state)
    # The query took RocksDB along, the session keeps what it had.
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_late_filter_lags_one_batch(spark, folder):
    """Rows right behind the batch that moves stream time still count: more tolerant than replay."""
    for number, rows in enumerate([BATCHES[0], BATCHES[1], BATCHES[3]]):
        write_batch(folder / "in", number, rows)
    alerts = streams.alert_stream(score_stream(spark, folder / "in"))
    out = str(folder / "log")
    run(streams.start_change_log(alerts, out, str(folder / "cp"), topics.ALL_AVAILABLE, MADE))
    last = {relative(r) for r in records.read_changes(spark, out).filter("batch_id = 2").collect()}
    assert {end for end, _ in last} >= {30, 60, 90}


def test_final_alerts_once_per_closed_window(spark, folder):
    for number, rows in enumerate(BATCHES):
        write_batch(folder / "in", number, rows)
    alerts = streams.alert_stream(score_stream(spark, folder / "in"))
    out, checkpoint = str(folder / "final"), str(folder / "cp")
    run(streams.start_final(alerts, out, checkpoint, topics.ALL_AVAILABLE, name="final"))
    closed = {((r.window_end - BASE) // 1000, round(r.average_score, 6)) for r in spark.read.parquet(out).collect()}
    assert closed == {(30, 0.1), (60, 0.1)}

    # More input under the same checkpoint goes on where the last run stopped.
    write_batch(folder / "in", 9, [(400, 0.8)])
    run(streams.start_final(alerts, out, checkpoint, topics.ALL_AVAILABLE))
    rows = spark.read.parquet(out).collect()
    ends = sorted((r.window_end - BASE) // 1000 for r in rows)
    assert ends == [30, 60, 120, 150, 180]


def test_upsert_keeps_the_last_mean_per_key(spark, folder):
    for number, rows in enumerate([[(1, 0.8)], [(2, -0.6)], [(40, 0.0)]]):
        write_batch(folder / "in", number, rows)
    alerts = streams.alert_stream(score_stream(spark, folder / "in"))
    base = str(folder / "table")
    run(streams.start_upsert(alerts, base, str(folder / "cp"), topics.ALL_AVAILABLE, MADE))
    got = {relative(r) for r in records.read_records(spark, base).collect()}
    assert got == {(30, 0.1), (60, 0.066667), (90, 0.0)}


def alert_rows(spark, *rows):
    ddl = "user_id STRING, window_end_ts BIGINT, average_score DECIMAL(10,6), alert_message STRING, created_at TIMESTAMP_NTZ"
    full = [(user, day * 86_400_000 + 1, None, text, MADE) for user, day, text in rows]
    return spark.createDataFrame(full, ddl)


def table(spark, base):
    return {(r.user_id, r.window_end_ts // 86_400_000, r.alert_message) for r in records.read_records(spark, base).collect()}


def test_upsert_touches_only_its_dates_and_writers_do_not_collide(spark, tmp_path):
    base = str(tmp_path / "table")
    assert table(spark, base) == set()
    records.upsert_records(spark, alert_rows(spark, ("a", 1, "x"), ("b", 1, "x"), ("a", 2, "x"), ("c", 3, "x")), base, "w", 0)
    first = records.version(spark, base)
    records.upsert_records(spark, alert_rows(spark, ("a", 1, "y"), ("d", 3, "y")), base, "w", 1)
    expected = {("a", 1, "y"), ("b", 1, "x"), ("a", 2, "x"), ("c", 3, "x"), ("d", 3, "y")}
    assert table(spark, base) == expected
    second = records.version(spark, base)
    stayed = {key for key in first.parts if second.parts[key] == first.parts[key]}
    assert {date for date, _ in stayed} >= {"1970-01-03"} and second.number == 2
    # The same batch number from another writer is another batch; an empty batch changes nothing.
    records.upsert_records(spark, alert_rows(spark, ("e", 2, "z")), base, "other", 1)
    records.upsert_records(spark, alert_rows(spark), base, "other", 2)
    records.upsert_records(spark, alert_rows(spark, ("e", 2, "again")), base, "other", 1)
    assert table(spark, base) == expected | {("e", 2, "z")} and records.versions(spark, base) == [1, 2, 3]
    only = records.read_records(spark, base, since=dt.date(1970, 1, 3), until=dt.date(1970, 1, 3))
    assert {(r.user_id, r.alert_message) for r in only.collect()} == {("a", "x"), ("e", "z")}
    assert all("window_date=1970-01-03" in path for path in only.inputFiles())


def test_readers_keep_the_version_they_began_with(spark, tmp_path):
    base = str(tmp_path / "table")
    records.upsert_records(spark, alert_rows(spark, ("a", 1, "x"), ("b", 1, "x")), base, "w", 0)
    began = records.read_records(spark, base)
    seen = []

    def publish(spark_, base_, made, publish=records._publish):
        # All parts of the next version are written, and none of them shows.
        seen.append(table(spark, base))
        done = publish(spark_, base_, made)
        seen.append(table(spark, base))
        return done

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(records, "_publish", publish)
        records.upsert_records(spark, alert_rows(spark, ("a", 1, "y"), ("c", 2, "y")), base, "w", 1)
    assert seen == [{("a", 1, "x"), ("b", 1, "x")}, {("a", 1, "y"), ("b", 1, "x"), ("c", 2, "y")}]
    assert {(r.user_id, r.alert_message) for r in began.collect()} == {("a", "x"), ("b", "x")}
    assert {r.user_id for r in records.read_records(spark, base, 1).collect()} == {"a", "b"}


@pytest.mark.parametrize("step", ["read", "write", "before", "after"])
@pytest.mark.parametrize("writer", ["w", "other"])
def test_upsert_after_a_crash_at_every_step(spark, tmp_path, monkeypatch, step, writer):
    """Whoever comes next, the same writer with the same batch or another with its own, nothing is lost."""
    base = str(tmp_path / "table")
    monkeypatch.setattr(records, "PARTS", 1)
    records.upsert_records(spark, alert_rows(spark, ("a", 1, "x"), ("b", 1, "x"), ("a", 2, "x")), base, "w", 0)
    batch = alert_rows(spark, ("a", 1, "y"))

    def die(*args):
        if step == "after":
            publish(*args)
        raise KeyboardInterrupt

    publish = records._publish
    with monkeypatch.context() as broken:
        if step == "write":
            broken.setattr(records, "uuid", SimpleNamespace(uuid4=die))
        else:
            broken.setattr(records, "_read" if step == "read" else "_publish", die)
        with pytest.raises(KeyboardInterrupt):
            records.upsert_records(spark, batch, base, "w", 1)

    expected = {("b", 1, "x"), ("a", 2, "x")}
    if writer == "w":
        records.upsert_records(spark, batch, base, "w", 1)
        expected |= {("a", 1, "y")}
    else:
        records.upsert_records(spark, alert_rows(spark, ("c", 3, "z")), base, "other", 1)
        expected |= {("a", 1, "y" if step == "after" else "x"), ("c", 3, "z")}
    assert table(spark, base) == expected


def test_of_two_writers_at_once_both_are_kept(spark, tmp_path):
    base = str(tmp_path / "table")
    records.upsert_records(spark, alert_rows(spark, ("a", 1, "x")), base, "w", 0)
    publish, first = records._publish, []

    def overtaken(*args):
        if not first:
            first.append(True)
            records.upsert_records(spark, alert_rows(spark, ("a", 1, "y"), ("b", 1, "y")), base, "other", 0)
        return publish(*args)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(records, "_publish", overtaken)
        records.upsert_records(spark, alert_rows(spark, ("a", 1, "z")), base, "w", 1)
    assert table(spark, base) == {("a", 1, "z"), ("b", 1, "y")} and records.versions(spark, base) == [1, 2, 3]


def test_sweep_keeps_what_kept_versions_name(spark, tmp_path):
    base = str(tmp_path / "table")
    for batch, text in enumerate("vwxyz"):
        records.upsert_records(spark, alert_rows(spark, ("a", 1, text), ("b", batch, "x")), base, "w", batch)
    before = {n: sorted(map(str, records.read_records(spark, base, n).collect())) for n in (4, 5)}
    records.sweep(spark, base, keep=2)
    assert records.versions(spark, base) == [4, 5]
    assert {n: sorted(map(str, records.read_records(spark, base, n).collect())) for n in (4, 5)} == before
    found = {str(p.parent.relative_to(tmp_path / "table")) for p in (tmp_path / "table/data").rglob("*.parquet")}
    wanted = {f.removeprefix(f"{base}/") for n in (4, 5) for f in records.version(spark, base, n).folders(base)}
    assert found == wanted


def test_compacted_log_reads_as_before(spark, tmp_path):
    path = str(tmp_path / "log")
    for batch, rows in enumerate([(("a", 1, "x"), ("b", 1, "x")), (("a", 1, "y"),), (("c", 1, "x"),), (("b", 1, "z"),)]):
        records.write_changes(alert_rows(spark, *rows), path, batch)
    before = sorted(map(str, records.latest_records(records.read_changes(spark, path)).collect()))
    for _ in range(2):
        records.compact_changes(spark, path, 2)
        assert sorted(map(str, records.latest_records(records.read_changes(spark, path)).collect())) == before
    assert records.read_changes(spark, path).count() == 4
    records.write_changes(alert_rows(spark, ("d", 1, "x")), path, 4)
    records.compact_changes(spark, path, 4)
    assert [name.split("=")[0][:10] for name in sorted(os.listdir(path))] == ["_compacted"] * 2 + ["batch_id"] * 2
    assert records.read_changes(spark, path).count() == 4


@pytest.mark.parametrize("written", [0, 1, 2])
def test_compaction_after_a_crash_loses_nothing(spark, tmp_path, monkeypatch, written):
    """Dead before it writes, with a part of it written, and with all of it written but nothing deleted."""
    path = str(tmp_path / "log")
    for batch, rows in enumerate([(("a", 1, "x"), ("b", 1, "x")), (("a", 1, "y"),), (("b", 1, "z"),)]):
        records.write_changes(alert_rows(spark, *rows), path, batch)
    before = sorted(map(str, records.latest_records(records.read_changes(spark, path)).collect()))
    records.compact_changes(spark, path, 0)
    if written:
        records.compact_changes(spark, path, 1)
    if written == 1:
        # The marker of a complete write comes last.
        os.unlink(f"{records._aside(path, 1)}/_SUCCESS")
    for upto in (1, 2, 2):
        assert sorted(map(str, records.latest_records(records.read_changes(spark, path)).collect())) == before
        records.compact_changes(spark, path, upto)
    assert sorted(map(str, records.latest_records(records.read_changes(spark, path)).collect())) == before


def test_change_log_is_idempotent_and_keeps_the_latest(spark, tmp_path):
    path = str(tmp_path / "log")
    records.write_changes(alert_rows(spark, ("a", 1, "x"), ("b", 1, "x")), path, 0)
    for _ in range(2):
        records.write_changes(alert_rows(spark, ("a", 1, "y")), path, 1)
    changes = records.read_changes(spark, path)
    assert changes.count() == 3
    assert {(r.user_id, r.alert_message) for r in records.latest_records(changes).collect()} == {("a", "y"), ("b", "x")}


def test_stream_metrics_arrive_with_the_progress(spark, folder):
    write_batch(folder / "in", 0, BATCHES[0])
    observed, observation = observe_alerts(streams.alert_stream(score_stream(spark, folder / "in")), "mood")
    assert observation is None
    query = run(streams.start_change_log(observed, str(folder / "log"), str(folder / "cp"), topics.ALL_AVAILABLE, MADE))
    metrics = query.recentProgress[0].observedMetrics["mood"]
    assert metrics.alerts == 2 and metrics.low_alerts == 0


def test_one_batch_stream_equals_batch(spark, sf_dir, folder):
    from moodtide.plans.catalog import DAY_HOP
    from moodtide.sources.tables import chat, chat_stream

    alerts = streams.alert_stream(pipeline.scores(chat_stream(spark, sf_dir, max_files_per_trigger=1)), DAY_HOP, threshold=0.2)
    run(streams.start_change_log(alerts, str(folder / "log"), str(folder / "cp"), topics.ALL_AVAILABLE, MADE))
    streamed = records.read_changes(spark, str(folder / "log")).select("user_id", "window_end_ts")
    batch = pipeline.warning_alerts(chat(spark, sf_dir), DAY_HOP, threshold=0.2).select("user_id", "window_end")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_event_files_are_taken_one_a_batch_in_order(spark, sf_dir, folder):
    from moodtide.plans.catalog import DAY_HOP
    from moodtide.sources.tables import chat_stream_of, in_slices, table

    events = table(spark, sf_dir, "events")
    stream = chat_stream_of(spark, events.schema, str(folder / "events"), in_slices(events, str(folder / "events"), 8))
    alerts = streams.alert_stream(pipeline.scores(stream), DAY_HOP)
    query = run(streams.start_change_log(alerts, str(folder / "log"), str(folder / "cp"), topics.ALL_AVAILABLE, MADE, "mood"))
    batches = [p for p in query.recentProgress if p["numInputRows"]]
    assert [p["numInputRows"] for p in batches] == [events.count() // 8] * 8 and query.name == "mood"
    times = [p["eventTime"]["max"] for p in batches]
    assert times == sorted(times)
    assert any(name.startswith("rocksdb") for name in batches[0]["stateOperators"][0]["customMetrics"])


def test_slices_are_dealt_in_one_pass(spark, folder):
    """The table is read for its bounds, its sizes and its rows, not once more for every slice."""
    from moodtide.sources.tables import in_slices

    read = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def seen(event_id):
        read.add(1)
        return event_id

    rows = spark.createDataFrame([(i if i % 50 else None, f"r{i}") for i in range(200)], "n BIGINT, name STRING")
    events = rows.select(seen("n").alias("event_id"), "name")
    in_slices(events, str(folder / "events"), 8, 1)
    assert read.value <= 3 * 200
    kept = sorted(row.name for row in spark.read.parquet(str(folder / "events")).collect())
    # Each slice comes again with the next, the last one has none after it.
    slice_of = lambda i: (i - 1) * 8 // 199 if i % 50 else 0
    assert kept == sorted([f"r{i}" for i in range(200)] + [f"r{i}" for i in range(200) if slice_of(i) < 7])


# Topics


def test_kafka_options():
    source = topics.source_options("chat-messages", minPartitions="64")
    assert source == {
        "kafka.bootstrap.servers": "localhost:9092", "subscribe": "chat-messages",
        "startingOffsets": "earliest", "minPartitions": "64", "includeHeaders": "true",
        "maxOffsetsPerTrigger": str(topics.MAX_OFFSETS),
    }
    replay = topics.replay_options("chat-messages", '{"chat-messages":{"0":9}}')
    assert replay["endingOffsets"] == '{"chat-messages":{"0":9}}' and "maxOffsetsPerTrigger" not in replay
    with pytest.raises(ValueError):
        topics.replay_options("chat-messages", "latest")
    sink = topics.sink_options("warning-alerts", "broker:1")
    assert sink["kafka.bootstrap.servers"] == "broker:1" and sink["topic"] == "warning-alerts"
    assert sink["kafka.acks"] == "1" and sink["kafka.compression.type"] == "snappy" and len(sink) == 9
    assert records.jdbc_options("jdbc:x", "me", batchsize="5")["dbtable"] == "alert_record"
    with pytest.raises(TypeError):
        records.jdbc_options()


def test_record_time_goes_over_a_broker_in_a_header(spark):
    sent, brokered = dt.datetime(2024, 1, 1, 0, 0, 1), dt.datetime(2024, 5, 5)
    rows = spark.createDataFrame([(b"k", b"v", sent), (b"l", b"w", None)], "key BINARY, value BINARY, timestamp TIMESTAMP")
    wire = topics.to_wire(rows)
    assert wire.columns == ["key", "value", "headers"]
    got = wire.withColumns({"timestamp": F.lit(brokered), "partition": F.lit(0), "offset": F.lit(1).cast("bigint")})
    times = {bytes(r.key): r.timestamp for r in topics.from_wire(got).collect()}
    assert times == {b"k": sent, b"l": brokered}


def test_records_carry_key_origin_and_time(spark):
    ddl = "user_id STRING, timestamp BIGINT, message STRING, partition INT, offset BIGINT, event_time TIMESTAMP"
    when = dt.datetime(2024, 1, 1)
    sent = topics.chat_records(spark.createDataFrame([("U1", 5, "好", 2, 9, when), (None, 6, "x", 1, 3, when)], ddl))
    assert sent.columns == ["key", "value", "partition", "offset", "timestamp"]
    read = topics.chat_messages(sent)
    rows = {r.offset: r for r in read.collect()}
    assert (rows[9].key, rows[9].user_id, rows[9].partition, rows[9].event_time, rows[9].timestamp) == ("U1", "U1", 2, when, 5)
    assert rows[3].key is None and rows[3].user_id is None
    assert topics.with_payload_time(read).filter("offset = 9").select(F.unix_millis("event_time")).first()[0] == 5
    scored = topics.sentiment_scores(topics.score_records(pipeline.scores(read)))
    assert {(r.key, r.sentiment_score, r.sentiment_label) for r in scored.collect()} == {("U1", 0.8, "Positive"), (None, 0.0, "Neutral")}


def test_alerts_go_out_under_their_windowed_key(spark):
    ddl = "user_id STRING, window_start BIGINT, window_end BIGINT, average_score DOUBLE, alert_message STRING"
    sent = topics.alert_records(spark.createDataFrame([("U001", 1700000000000, 1700000060000, -0.25, "m")], ddl))
    row = sent.select(*split_windowed_key(F.col("key")), F.col("value").cast("string")).first()
    assert tuple(row) == (
        "U001", 1700000000000,
        '{"userId":"U001","windowEnd":1700000060000,"averageScore":-0.25,"alertMessage":"m"}',
    )


def test_file_topic_batch_and_stream(spark, sf_dir, tmp_path):
    from moodtide.sources.tables import chat

    kept = topics.FileTopics(str(tmp_path / "kept"), max_files_per_trigger=1)
    kept.write(topics.chat_records(chat(spark, sf_dir)), "chat-messages")
    n = chat(spark, sf_dir).count()
    assert topics.chat_messages(kept.read(spark, "chat-messages"), mode="strict").count() == n
    run(kept.write(kept.read(spark, "chat-messages", streaming=True), "copy", str(tmp_path / "cp"), topics.ALL_AVAILABLE))
    assert kept.read(spark, "copy").count() == n
    with pytest.raises(ValueError):
        kept.write(kept.read(spark, "chat-messages", streaming=True), "copy")


def test_topology_runs_both_stages_side_by_side(spark, tmp_path):
    """Both queries run at once; a bad record and a null message are left out, a keyless one too."""
    kept = topics.FileTopics(str(tmp_path / "kept"))
    for topic in ("chat-messages", "sentiment-scores"):
        kept.create(spark, topic)
    scoring, rejecting, alerting, refusing = streams.start_topology(spark, kept, str(tmp_path / "cp"), mode="append")
    names = ["sentiment-scores", "rejected-messages", "warning-alerts", "sentiment-scores-rejected-messages"]
    assert [q.name for q in (scoring, rejecting, alerting, refusing)] == names
    try:
        when = dt.datetime(2024, 1, 1)
        first = [("U1", "好", 0), ("U1", "难过", 10), ("U1", None, 11), (None, "好", 12)]
        for number, rows in enumerate([first, [("U2", "x", 600)]]):
            batch = spark.createDataFrame(
                [(u, 5, m, 0, number * 10 + i, when + dt.timedelta(seconds=s)) for i, (u, m, s) in enumerate(rows)],
                "user_id STRING, timestamp BIGINT, message STRING, partition INT, offset BIGINT, event_time TIMESTAMP",
            )
            kept.write(topics.chat_records(batch), "chat-messages")
            scoring.processAllAvailable()
            rejecting.processAllAvailable()
            alerting.processAllAvailable()
            refusing.processAllAvailable()
        sent = kept.read(spark, "warning-alerts")
        text, start = split_windowed_key(F.col("key"))
        rows = sent.select(text, (start - int(when.timestamp()) * 1000) / 1000, F.get_json_object(F.col("value").cast("string"), "$.averageScore"))
        assert sorted((u, s, round(float(a), 6)) for u, s, a in rows.collect()) == [("U1", -30.0, 0.1), ("U1", 0.0, 0.1)]
        code = F.get_json_object(F.col("value").cast("string"), "$.errorCode")
        assert [tuple(r) for r in kept.read(spark, "rejected-messages").select("offset", code).collect()] == [(2, "3000")]
        counted = [p.observedMetrics["scores"].messages for p in scoring.recentProgress if "scores" in p.observedMetrics]
        assert sum(counted) == 4
        assert any("alerts" in p.observedMetrics for p in alerting.recentProgress)
        state = [s for p in alerting.recentProgress for s in p["stateOperators"]]
        assert any(name.startswith("rocksdb") for s in state for name in s["customMetrics"])
    finally:
        for query in (scoring, rejecting, alerting, refusing):
            query.stop()


def test_topology_that_cannot_start_leaves_nothing_running(spark, tmp_path, monkeypatch):
    kept = topics.FileTopics(str(tmp_path / "kept"))
    with pytest.raises(ValueError, match="append, update, complete"):
        streams.start_topology(spark, kept, str(tmp_path / "cp"), mode="upsert")
    kept.create(spark, "chat-messages")

    def fail(*args):
        raise RuntimeError("cannot start")

    monkeypatch.setattr(streams, "start_alerting", fail)
    with pytest.raises(RuntimeError, match="cannot start"):
        streams.start_topology(spark, kept, str(tmp_path / "cp"))
    assert not spark.streams.active


@pytest.mark.parametrize("order", ["bsb", "sbs", "ssb"])
def test_topic_keeps_every_row_whatever_the_order_of_writes(spark, sf_dir, tmp_path, order):
    from moodtide.sources.tables import chat

    kept = topics.FileTopics(str(tmp_path / "kept"))
    sent = topics.chat_records(chat(spark, sf_dir).limit(20))
    kept.write(sent, "source")
    for number, kind in enumerate(order):
        if kind == "b":
            kept.write(sent, "topic")
        else:
            again = kept.read(spark, "source", streaming=True)
            run(kept.write(again, "topic", str(tmp_path / f"cp{number}"), topics.ALL_AVAILABLE))
        assert kept.read(spark, "topic").count() == 20 * (number + 1)


def test_repeated_micro_batch_is_written_once(spark, sf_dir, tmp_path):
    from moodtide.sources.tables import chat

    kept = topics.FileTopics(str(tmp_path / "kept"))
    kept.write(topics.chat_records(chat(spark, sf_dir).limit(20)), "source")
    for _ in range(2):
        again = kept.read(spark, "source", streaming=True)
        run(kept.write(again, "topic", str(tmp_path / "cp"), topics.ALL_AVAILABLE))
        # As if the driver had died between the write and its commit.
        for name in os.listdir(tmp_path / "cp/commits"):
            os.unlink(tmp_path / "cp/commits" / name)
    assert kept.read(spark, "topic").count() == 20


def test_replay_needs_every_records_origin(spark):
    rows = spark.createDataFrame([("u", 5, "好")], "user_id STRING, timestamp BIGINT, message STRING")
    read = topics.chat_messages(topics.chat_records(rows).withColumns({"partition": F.lit(None).cast("int"), "offset": F.lit(None).cast("bigint")}))
    assert pipeline.warning_alerts(read).count() == 1
    with pytest.raises(Exception, match="replay needs"):
        pipeline.replayed_alerts(read).collect()


def test_batch_replay_and_stream_group_by_key_and_record_time(spark, tmp_path):
    when = dt.datetime(2024, 1, 1)
    rows = [("K", 1, 0), (None, 2, 40), ("K", 3, 80)]
    sent = spark.createDataFrame(
        [(k, b'{"userId":"P","message":"\xe5\xa5\xbd"}', 0, o, when + dt.timedelta(seconds=s)) for k, o, s in rows],
        "key STRING, value BINARY, partition INT, offset BIGINT, timestamp TIMESTAMP",
    ).withColumn("key", F.col("key").cast("binary"))
    kept = topics.FileTopics(str(tmp_path / "kept"))
    kept.write(sent, "chat-messages")
    read = topics.chat_messages(kept.read(spark, "chat-messages"))
    batch = {(r.user_id, r.window_end) for r in pipeline.warning_alerts(read).collect()}
    assert {user for user, _ in batch} == {"K"} and len(batch) == 4
    assert {(r.user_id, r.window_end) for r in pipeline.replayed_alerts(read).collect()} == batch
    run(streams.start_alerts(spark, kept, str(tmp_path / "cp"), trigger=topics.ALL_AVAILABLE))
    text, start = split_windowed_key(F.col("key"))
    got = kept.read(spark, "warning-alerts").select(text, start + 60_000).distinct().collect()
    assert set(map(tuple, got)) == batch


def test_kafka_needs_its_connector(spark):
    """Without the connector's jar the source is not found; what is asked for is Kafka."""
    kafka = topics.KafkaTopics("broker:1", read_options={"minPartitions": "64"})
    with pytest.raises(Exception, match="kafka|Kafka"):
        kafka.read(spark, "chat-messages")


def test_work_dir_follows_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first != second and first.startswith(f"{shared}/x-")
    # The setting is fixed for a session's life: one without it is imitated.
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default=None: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(unset, "x")


def test_table_stream_from_a_folder_of_files(spark, sf_dir, tmp_path):
    from moodtide.sources.tables import chat, chat_stream, table

    table(spark, sf_dir, "events").repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    sent = topics.chat_records(chat_stream(spark, str(tmp_path), max_files_per_trigger=1))
    kept = topics.FileTopics(str(tmp_path / "kept"))
    query = run(kept.write(sent, "chat-messages", str(tmp_path / "cp"), topics.ALL_AVAILABLE))
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert kept.read(spark, "chat-messages").count() == chat(spark, sf_dir).count()
