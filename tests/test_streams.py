"""Streams in several micro-batches against the batch operators."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablecraft.operators import etl
from tablecraft.operators import timeseries as S
from tablecraft.streaming import streams as R

COLS = ["event_id", "ts", "user_id", "event_type", "value"]


def values(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def feed(spark, tables, tmp_path_factory):
    """Three files written one after the other, in time order."""
    path = str(tmp_path_factory.mktemp("feed"))
    events = tables.events.select(*COLS)
    days = [1, 11, 21, 32]
    for low, high in zip(days, days[1:]):
        part = events.filter(F.dayofmonth("ts").between(low, high - 1))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.fixture
def stream(spark, tables, feed):
    return lambda: R.event_source(spark, feed, tables.events.select(*COLS).schema, 1)


def mark(tables, minutes=10):
    last = tables.events.agg(F.max("ts")).first()[0]
    return last.replace(microsecond=last.microsecond // 1000 * 1000) - dt.timedelta(minutes=minutes)


def test_buckets_match_batch(tables, stream):
    got = R.run_to_files(R.stream_buckets(stream(), "event_type", "ts", "value", "1 day", "10 minutes"), "t")
    want = tables.events.groupBy("event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_ts")).agg(
        F.count("*").alias("n"), F.max("value").alias("max_value")
    )
    closed = want.filter(F.col("window_ts") + F.expr("interval 1 day") <= F.lit(mark(tables)).cast("timestamp_ntz"))
    cols = ["event_type", "window_ts", "n", "max_value"]
    assert values(got.select(cols)) == values(closed.select(cols)) and got.count() > 0


def test_late_rows_are_dropped(spark, tmp_path):
    path = str(tmp_path / "late")
    schema = "k string, ts timestamp_ntz, v double"
    for rows in ([("a", dt.datetime(2024, 1, 1, 5), 1.0)], [("a", dt.datetime(2024, 1, 1, 9), 2.0)],
                 [("a", dt.datetime(2024, 1, 1, 10), 2.5)], [("a", dt.datetime(2024, 1, 1, 5, 1), 99.0), ("a", dt.datetime(2024, 1, 1, 12), 3.0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    src = R.event_source(spark, path, spark.createDataFrame([], schema).schema, 1)
    got = R.run_to_files(R.stream_buckets(src, "k", "ts", "v", "1 hour", "10 minutes"), "late")
    assert [(r.window_ts.hour, r.n, r.max_value) for r in got.orderBy("window_ts").collect()] == [
        (5, 1, 1.0), (9, 1, 2.0), (10, 1, 2.5)
    ]


def test_sessions_match_batch(tables, stream):
    got = R.run_to_files(R.stream_sessions(stream().select("user_id", "ts"), "user_id", "ts", "6 hours", "10 minutes"), "t")
    want = S.sessions(tables.events, "user_id", "ts", 6 * 3600)
    closed = want.filter(F.col("session_end") + F.expr("interval 6 hours") <= F.lit(mark(tables)).cast("timestamp_ntz"))
    cols = ["user_id", "session_start", "session_end", "n_events"]
    assert values(got.select(cols)) == values(closed.select(cols)) and got.count() > 0


def test_runs_match_batch(tables, stream):
    got = R.run_to_files(R.stream_state_runs(stream(), "user_id", "ts", "event_type", "error", "10 minutes"), "t")
    rows = S.state_runs(tables.events, "user_id", "ts", "event_type", "error")
    runs = rows.groupBy("user_id", "run_start", "run_end").agg(F.count("*").alias("n_rows"))
    after = tables.events.filter("event_type <> 'error'").select(F.col("user_id").alias("u"), F.col("ts").alias("then"))
    closed = runs.join(
        after, (F.col("u") == F.col("user_id")) & (F.col("then") > F.col("run_end")) & (F.col("then") <= F.lit(mark(tables)).cast("timestamp_ntz")),
        "left_semi",
    )
    cols = ["user_id", "run_start", "run_end", "n_rows"]
    assert values(got.select(cols)) == values(closed.select(cols)) and got.count() > 0


def test_interval_join_matches_batch(tables, stream):
    def side(df, kind, id_, ts):
        return df.filter(F.col("event_type") == kind).select(F.col("event_id").alias(id_), "user_id", F.col("ts").alias(ts))

    got = R.run_to_files(
        R.stream_interval_join(
            side(stream(), "error", "e", "ets"), side(stream(), "purchase", "p", "pts"), "user_id", "ets", "pts", 7200, "10 minutes"
        ),
        "t",
    )
    a, b = side(tables.events, "error", "e", "ets"), side(tables.events, "purchase", "p", "pts")
    near = F.abs(F.unix_micros(F.col("ets").cast("timestamp")) - F.unix_micros(F.col("pts").cast("timestamp"))) <= 7_200_000_000
    want = a.join(b, "user_id").filter(near)
    assert values(got.select("e", "p")) == values(want.select("e", "p")) and got.count() > 0


def test_upsert_of_batches_is_the_latest_row(spark, tables, stream, tmp_path):
    args = (str(tmp_path / "latest"), ["user_id"], ["event_id", "ts", "event_type", "value"], "ts", str(tmp_path / "state"))
    table = R.stream_upsert(stream(), *args)
    want = etl.latest_per_key(tables.events.select(*COLS), ["user_id"], ["ts"])
    assert values(table.read().select(*COLS)) == values(want.select(*COLS))
    log = len(table._log())
    again = R.stream_upsert(stream(), *args)
    assert len(again._log()) == log and values(again.read().select(*COLS)) == values(want.select(*COLS))
