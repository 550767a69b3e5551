"""Registered queries: streams over the given tables, run to the end of the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablecraft.plans.registry import Tables, query
from tablecraft.plans.storage import shared_dir
from tablecraft.session import tune
from tablecraft.streaming import streams as S

COLS = ["event_id", "ts", "user_id", "event_type", "value"]


def _session(t: Tables):
    """A session for the stream alone: its state has one partition per core.

    Stateful operators keep the partition count they start with and are not
    merged by AQE, so the batch default is not used for them.
    """
    session = tune(t.spark.newSession())
    session.conf.set("spark.sql.shuffle.partitions", str(t.spark.sparkContext.defaultParallelism))
    return session


def _source(t: Tables, session=None):
    """The events as a stream; the whole table is one bounded run."""
    return S.event_source(session or _session(t), t.folder + "/events.parque[t]", t.events.schema).select(*COLS)


def _feed(t: Tables, files: int = 3):
    """The same rows as several files, one per micro-batch, in no promised order."""
    path = shared_dir(t.spark, "events-feed")
    t.events.select(*COLS).repartitionByRange(files, "ts").write.parquet(path)
    return S.event_source(t.spark, path, t.events.select(*COLS).schema, 1)


@query(
    "sm1_stream_events",
    """
    SELECT event_id, user_id, CASE WHEN event_type IN ('click', 'view') THEN 'browse' WHEN event_type = 'purchase' THEN 'buy'
           ELSE event_type END AS clean_type, event_type AS original_type FROM events
    """,
)
def stream_events(t):
    stream = _source(t).select("event_id", "user_id", "event_type")
    view = S.stream_events(
        stream, "event_type", {"browse": ["click", "view"], "buy": ["purchase"]}, "clean_type", "original_type"
    )
    return S.run_to_files(view, "clean-events", spark=t.spark)


@query(
    "sm2_stream_buckets",
    """
    SELECT event_type, date_trunc('hour', ts) AS window_ts, count(*) AS n, max(value) AS max_value,
           quantile_disc(value, 0.99) AS p99_value FROM events
    GROUP BY 1, 2 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <=
      (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM events)
    """,
)
def stream_buckets(t):
    stream = _source(t)
    return S.run_to_files(
        S.stream_buckets(stream, "event_type", "ts", "value", "1 hour", "10 minutes"), "buckets", spark=t.spark
    )


@query(
    "sm3_stream_sessions",
    """
    WITH a AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS flag
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(flag) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM a)
    SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events FROM s GROUP BY user_id, sid
    HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM events)
    """,
)
def stream_sessions(t):
    stream = _source(t).select("user_id", "ts")
    return S.run_to_files(S.stream_sessions(stream, "user_id", "ts", "30 minutes", "10 minutes"), "sessions", spark=t.spark)


@query(
    "sm4_stream_upsert",
    """
    SELECT user_id, arg_max(event_id, ts) AS event_id, max(ts) AS ts, arg_max(event_type, ts) AS event_type,
           arg_max(value, ts) AS value FROM events GROUP BY user_id
    """,
)
def stream_upsert(t):
    root = shared_dir(t.spark, "latest-by-user")
    stream = _feed(t)
    return S.stream_upsert(stream, root, ["user_id"], ["event_id", "ts", "event_type", "value"], "ts").read()


@query(
    "sm5_stream_interval_join",
    """
    SELECT e.event_id AS error_id, p.event_id AS purchase_id, e.user_id, e.ts AS error_ts, p.ts AS purchase_ts
    FROM events e JOIN events p ON e.user_id = p.user_id AND p.ts BETWEEN e.ts - INTERVAL 1 HOUR AND e.ts + INTERVAL 1 HOUR
    WHERE e.event_type = 'error' AND p.event_type = 'purchase'
    """,
)
def stream_interval_join(t):
    session = _session(t)
    errors = _source(t, session).filter("event_type = 'error'").select(
        F.col("event_id").alias("error_id"), "user_id", F.col("ts").alias("error_ts")
    )
    purchases = _source(t, session).filter("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("purchase_ts")
    )
    joined = S.stream_interval_join(errors, purchases, "user_id", "error_ts", "purchase_ts", 3600, "10 minutes")
    return S.run_to_files(joined, "pairs", spark=t.spark)


@query(
    "sm6_stream_state_runs",
    """
    WITH placed AS (SELECT user_id, ts, event_type = 'error' AS err, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS following,
        row_number() OVER (PARTITION BY user_id ORDER BY ts)
        - row_number() OVER (PARTITION BY user_id, event_type = 'error' ORDER BY ts) AS apart FROM events)
    SELECT user_id, min(ts) AS run_start, max(ts) AS run_end, count(*) AS n_rows FROM placed WHERE err GROUP BY user_id, apart
    HAVING arg_max(following, ts) <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE FROM events)
       AND count(following) = count(*)
    """,
)
def stream_state_runs(t):
    stream = _source(t)
    return S.run_to_files(S.stream_state_runs(stream, "user_id", "ts", "event_type", "error", "10 minutes"), "runs", spark=t.spark)
