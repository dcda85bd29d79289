from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from simulate import Record, simulate

from moodtide.functions import checks
from moodtide.operators import quality
from moodtide.operators.alerts import alert_metrics, observe_alerts, observe_scores, to_alerts, to_records
from moodtide.operators.changelog import alert_changelog, current_table
from moodtide.operators.lateness import windowed_in_time, windowed_late, with_stream_time
from moodtide.operators.running import bucket_of, with_running_sums
from moodtide.operators.windows import (
    Hop,
    assign_windows,
    explode_windows,
    flatten_window,
    join_sum_count,
    window_aggregate,
    window_count,
    window_mean,
    window_sum,
)
from moodtide.plans.pipeline import replayed_means
from moodtide.schemas import ERROR_CODES, error_catalogue

SCORED = "partition INT, offset BIGINT, user_id STRING, timestamp BIGINT, sentiment_score DOUBLE"


def scored(spark, records):
    df = spark.createDataFrame([tuple(r) for r in records], SCORED)
    return df.withColumn("event_time", F.timestamp_millis("timestamp"))


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


# Windows


def test_window_bounds(spark):
    """30 s hops of 60 s, closed at the start, open at the end; none starts before the epoch."""
    records = [Record(0, i, "u", ms, 0.0) for i, ms in enumerate([0, 29_999, 30_000, 59_999, 60_000])]
    rows = flatten_window(assign_windows(scored(spark, records))).select("timestamp", "window_start", "window_end")
    got = sorted(tuple(r) for r in rows.collect())
    assert got == [
        (0, 0, 60_000), (29_999, 0, 60_000), (30_000, 0, 60_000), (30_000, 30_000, 90_000),
        (59_999, 0, 60_000), (59_999, 30_000, 90_000), (60_000, 30_000, 90_000), (60_000, 60_000, 120_000),
    ]


@pytest.mark.parametrize("size, advance", [(60_000, 25_000), (60_000, 60_000), (50_000, 20_000)])
def test_window_starts_for_any_hop(spark, size, advance):
    hop = Hop(size, advance, 0)
    records = [Record(0, i, "u", ms, 0.0) for i, ms in enumerate(range(0, 400_000, 7_333))]
    kept, _, _ = simulate(records, Hop(size, advance, 10**9))
    columns = ["partition", "offset", "user_id", "window_start"]
    for rows in (flatten_window(assign_windows(scored(spark, records), hop)), explode_windows(scored(spark, records), hop)):
        assert sorted(tuple(r) for r in rows.select(columns).collect()) == sorted(kept)
        assert rows.filter(F.col("window_end") - F.col("window_start") != size).count() == 0


@pytest.mark.parametrize("bad", [(0, 1, 0), (60, 0, 0), (60, 61, 0), (60, 30, -1)])
def test_bad_hops(bad):
    with pytest.raises(ValueError):
        Hop(*bad)


def test_rows_without_key_do_not_count(spark):
    windowed = assign_windows(scored(spark, [Record(0, 0, None, 60_000, 0.8), Record(0, 1, "u", 60_000, 0.8)]))
    assert {r.n for r in window_mean(windowed).collect()} == {1}
    assert window_sum(windowed).count() == window_count(windowed).count() == 2


def test_any_aggregate_per_window(spark):
    records = [Record(0, i, "u", 60_000 + i, score) for i, score in enumerate([0.8, -0.6, 0.0])]
    extremes = window_aggregate(assign_windows(scored(spark, records)), F.min("sentiment_score"), F.max("sentiment_score"))
    assert {tuple(r)[2:] for r in extremes.collect()} == {(-0.6, 0.8)}


def test_mean_takes_one_shuffle_and_equals_the_join(spark):
    rnd = random.Random(3)
    records = [Record(0, i, f"u{rnd.randrange(5)}", rnd.randrange(600_000), rnd.choice([0.8, -0.6, 0.0])) for i in range(500)]
    windowed = assign_windows(scored(spark, records))
    fused = window_mean(windowed)
    assert exchanges(fused) == 1
    joined = join_sum_count(window_sum(windowed), window_count(windowed))
    assert exchanges(joined) == 2
    columns = ["user_id", "window", "score_sum", "n", "average_score"]
    assert sorted(fused.select(columns).collect()) == sorted(joined.select(columns).collect())


# Running totals, late rows, update log

def disordered(n, jitter, seed=11, users=6, hot_share=1 / 3):
    """Events of which one user has a third, arriving up to ``jitter`` ms late, some without a key."""
    rnd = random.Random(seed)
    records, offsets = [], {0: 0, 1: 0, 2: 0}
    for i in range(n):
        user = "hot" if rnd.random() < hot_share else f"u{rnd.randrange(users)}"
        partition = sum(map(ord, user)) % 3
        if rnd.random() < 0.02:
            user = None
        time = max(0, 1_000_000 + i * 900 - rnd.randrange(jitter + 1))
        records.append(Record(partition, offsets[partition], user, time, rnd.choice([0.8, -0.6, 0.0])))
        offsets[partition] += rnd.choice([1, 1, 3])
    return records


@pytest.fixture(scope="module")
def records():
    return disordered(1500, jitter=200_000)


@pytest.mark.parametrize("bits", [0, 4, 20])
def test_stream_time_in_buckets(spark, records, bits):
    expected, now = [], {}
    for r in records:
        if r.user_id is not None:
            now[r.partition] = max(now.get(r.partition, 0), r.timestamp)
            expected.append((r.partition, r.offset, now[r.partition]))
    rows = with_stream_time(scored(spark, records), bucket_bits=bits).select("partition", "offset", "stream_time")
    assert sorted(tuple(r) for r in rows.collect()) == sorted(expected)


@pytest.mark.parametrize("bits", [3, 20])
@pytest.mark.parametrize("jitter", [0, 20_000, 200_000])
@pytest.mark.parametrize("hop", [Hop(), Hop(90_000, 20_000, 0)], ids=["60/30/30", "90/20/0"])
def test_replay_equals_record_at_a_time(spark, hop, jitter, bits):
    """In order, few windows reach into another bucket; in disorder, all do."""
    records = disordered(800, jitter, seed=bits + jitter)
    kept, late, updates = simulate(records, hop)
    assert kept and bool(late) == (jitter > hop.grace_ms)
    df = scored(spark, records)
    in_time = windowed_in_time(df, hop, bucket_bits=bits)
    pair = ["partition", "offset", "user_id", "window_start"]
    assert sorted(tuple(r) for r in in_time.select(pair).collect()) == sorted(kept)
    dropped = windowed_late(df, hop, bucket_bits=bits).select(*pair, "stream_time")
    assert sorted(tuple(r) for r in dropped.collect()) == sorted(late)

    log = alert_changelog(in_time, hop, include_transient=True)
    columns = ["user_id", "window_start", "offset", "seq", "n"]
    got = log.select(*columns, F.round("average_score", 6)).collect()
    assert sorted(tuple(r) for r in got) == sorted(updates)
    settled = alert_changelog(in_time, hop)
    got = settled.select(*columns, F.round("average_score", 6)).collect()
    assert sorted(tuple(r) for r in got) == sorted(u for u in updates if u[3] == 1)

    last = {}
    for user, start, _, _, n, mean in updates:
        last[user, start] = (user, start, start + hop.size_ms, n, mean)
    for means in (current_table(log), replayed_means(df, hop, bits)):
        table = means.select("user_id", "window_start", "window_end", "n", F.round("average_score", 6))
        assert sorted(tuple(r) for r in table.collect()) == sorted(last.values())


def final_plan(df):
    """The plan as it ran, without the one it started from."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_one_user_holding_most_rows_is_split(spark):
    """Everything in one (user, window): no task gets more than a few buckets of it."""
    n, bits = 5_000, 8
    rows = spark.range(n).select(
        F.lit("hot").alias("user_id"), F.col("id").alias("offset"), bucket_of(F.col("id"), bits).alias("bucket")
    )
    before = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        sums = {"total": F.lit(0.5), "n": F.lit(1).cast("bigint")}
        running = with_running_sums(rows, ["user_id"], "offset", sums, "bucket")
        assert running.count() == n
        assert running.filter((F.col("n") != F.col("offset") + 1) | (F.col("total") != F.col("n") * 0.5)).count() == 0
        per_task = running.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before[0])
        spark.conf.set("spark.sql.shuffle.partitions", before[1])
    assert per_task <= 4 * 2**bits


def test_replay_shuffles_the_rows_once(spark, sf_dir, tmp_path):
    """All branches of the log read the one shuffle of the rows; windows inside a bucket need no other."""
    path = str(tmp_path / "scored")
    scored(spark, disordered(1500, jitter=0)).write.parquet(path)
    log = alert_changelog(windowed_in_time(spark.read.parquet(path), bucket_bits=5))
    plan = final_plan(log)
    # Branches that read another's shuffle show no scan: one scan is the rows', one the buckets' extents.
    assert plan.count("FileScan") == 2
    alone = plan[plan.index("Union") :]
    alone = alone[: alone.index("FileScan")]
    assert alone.count("Exchange hashpartitioning(partition") == 1


# Alerts


def means(spark):
    rows = [("u1", 0, 60_000, -0.25), ("u2", 0, 60_000, 0.5), ("u1", 30_000, 90_000, 0.1234567)]
    return spark.createDataFrame(rows, "user_id STRING, window_start BIGINT, window_end BIGINT, average_score DOUBLE")


def test_every_window_alerts_unless_a_threshold_is_given(spark):
    assert to_alerts(means(spark)).count() == 3
    assert [r.average_score for r in to_alerts(means(spark), threshold=0).collect()] == [-0.25]
    assert {r.alert_message for r in to_alerts(means(spark)).collect()} == {"用户情绪持续低落"}


def test_records(spark):
    made = dt.datetime(2024, 2, 1, 12)
    rows = to_records(to_alerts(means(spark)), made).orderBy("user_id", "window_end_ts").collect()
    assert [str(r.average_score) for r in rows] == ["-0.250000", "0.123457", "0.500000"]
    assert {r.created_at for r in rows} == {made}
    with_id = to_records(to_alerts(means(spark)), with_id=True)
    assert with_id.columns[0] == "id" and with_id.select("id").distinct().count() == 3
    assert dict(with_id.dtypes)["created_at"] == "timestamp_ntz"


def test_observed_metrics_equal_the_table(spark):
    observed, observation = observe_alerts(to_alerts(means(spark)))
    assert observed.count() == 3
    expected = alert_metrics(to_alerts(means(spark))).first().asDict()
    assert observation.get == expected == {
        "alerts": 3, "low_alerts": 1, "min_average": -0.25, "max_average": 0.5, "last_window_end": 90_000,
    }


def test_negative_messages_are_counted_in_passing(spark):
    records = [Record(0, i, "u", i, score) for i, score in enumerate([0.8, -0.6, -0.6, 0.0])]
    observed, observation = observe_scores(scored(spark, records))
    assert observed.count() == 4
    assert observation.get == {"messages": 4, "negative_messages": 2}


# Validation


def doubtful(spark):
    rows = [(1, "u", "hi", 0.5), (2, None, "", 2.0), (3, "u", None, float("nan")), (4, "u", " ", -1.0)]
    return spark.createDataFrame(rows, "i INT, user_id STRING, message STRING, sentiment_score DOUBLE")


def row_checks():
    return [*quality.chat_checks(), *quality.score_checks(), checks.not_null(F.col("user_id"), "3002")]


def test_valid_and_quarantined_rows_make_up_the_table(spark):
    df = doubtful(spark)
    good = {r.i for r in quality.valid_rows(df, row_checks()).collect()}
    bad = {r.i: r.errors for r in quality.quarantine(df, row_checks()).collect()}
    assert good == {1, 4} and bad == {2: ["3000", "3001", "3002"], 3: ["3000"]}


def test_strict_mode_names_code_and_message(spark):
    assert quality.require_valid(doubtful(spark).filter("i = 1"), row_checks()).count() == 1
    with pytest.raises(Exception, match="3000 聊天消息无效"):
        quality.require_valid(doubtful(spark), row_checks()).count()


def test_alert_checks(spark):
    df = spark.createDataFrame([("u", None), (None, 0.1), ("u", 0.1)], "user_id STRING, average_score DOUBLE")
    assert quality.quarantine(df, quality.alert_checks()).count() == 2


def test_catalogue_and_classification(spark):
    catalogue = error_catalogue(spark)
    assert catalogue.count() == 9
    assert {r.family: r["count"] for r in catalogue.groupBy("family").count().collect()} == {
        "system": 3, "transport": 3, "business": 3,
    }
    known = catalogue.select(quality.classify(F.col("code")) == F.col("code"), quality.error_message(F.col("code")) == F.col("message"))
    assert all(all(r) for r in known.collect()) and known.count() == len(ERROR_CODES)
    df = spark.createDataFrame([("9999", False), ("9999", True), (None, False), ("3001", True)], "code STRING, bad BOOLEAN")
    got = [r[0] for r in df.select(quality.classify(F.col("code"), F.col("bad"))).collect()]
    assert got == ["1000", "1001", "1000", "3001"]


def test_summary(spark):
    rows = quality.error_summary(spark, quality.quarantine(doubtful(spark), row_checks())).collect()
    assert {(r.code, r.n, r.family) for r in rows} == {("3000", 2, "business"), ("3001", 1, "business"), ("3002", 1, "business")}
