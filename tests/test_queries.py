"""Every registered query against its SQL."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as entry_points
from moodtide.plans.catalog import QUERIES
from moodtide.plans.oracle import SQL

TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.items() <= entry_points.queries().items() and SQL.items() <= entry_points.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    df, sql = QUERIES[name](spark, sf_dir), SQL[name]
    assert {c: TYPES[t] for c, t in df.dtypes} == oracle.duckdb_columns(con, sql)
    rows = oracle.spark_rows(df)
    assert rows
    assert rows == oracle.duckdb_rows(con, sql)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["user_id", "window_end", "average_score", "alert_message"]
    assert df.count() > 0


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Shanghai"])
def test_session_zone_does_not_matter(spark, sf_dir, con, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for name in ("src_chat_messages", "warning_alerts", "alert_current", "alerts_stream_upsert"):
            df = QUERIES[name](spark, sf_dir)
            assert oracle.spark_rows(df) == oracle.duckdb_rows(con, SQL[name]), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
