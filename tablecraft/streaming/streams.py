"""Structured Streaming forms of the batch operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tablecraft.operators.deltas import DeltaTable
from tablecraft.operators.filters import standardise
from tablecraft.plans.storage import shared_dir

__all__ = [
    "event_source", "run_to_files", "stream_events", "stream_buckets", "stream_sessions", "stream_upsert",
    "stream_interval_join", "stream_state_runs",
]


def event_source(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Files in a folder (or under a glob) as they arrive; none is read twice or changed.

    ``files_per_trigger`` bounds the rows of one micro-batch.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def run_to_files(stream: DataFrame, name: str, mode: str = "append", spark: SparkSession | None = None) -> DataFrame:
    """Process what is available and give back the written rows, read by ``spark``.

    Output and checkpoint live in the shared folder; the file sink writes every
    batch exactly once.
    """
    spark = spark or stream.sparkSession
    out, state = shared_dir(spark, f"{name}-out"), shared_dir(spark, f"{name}-state")
    query = (
        stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", state)
        .trigger(availableNow=True).start(out)
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def stream_events(stream: DataFrame, col: str, variants: dict, clean: str, raw: str) -> DataFrame:
    """The standardised view of an append-only feed."""
    return standardise(stream, col, variants, clean, raw)


def stream_buckets(stream: DataFrame, key: str, ts: str, value: str, width: str, delay: str) -> DataFrame:
    """Count, maximum and approximate 99th percentile per key and closed time bucket.

    Rows later than ``delay`` behind the newest are dropped by the watermark.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    buckets = timed.groupBy(F.window(ts, width), key).agg(
        F.count(F.lit(1)).alias("n"), F.max(value).alias("max_value"), F.percentile_approx(value, 0.99, 10_000).alias("p99_value")
    )
    return buckets.select(key, F.col("window.start").cast("timestamp_ntz").alias("window_ts"), "n", "max_value", "p99_value")


def stream_sessions(stream: DataFrame, key: str, ts: str, gap: str, delay: str) -> DataFrame:
    """Sessions per key that the watermark has closed."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    found = timed.groupBy(F.session_window(ts, gap), key).agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count(F.lit(1)).alias("n_events")
    )
    return found.select(
        key, F.col("session_start").cast("timestamp_ntz").alias("session_start"),
        F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n_events",
    )


def stream_upsert(
    stream: DataFrame, root: str, keys: list[str], update: list[str], newest: str, checkpoint: str | None = None,
    compact: bool = True,
) -> DeltaTable:
    """Upsert every micro-batch into the delta table under ``root`` and give back that table.

    A row that arrives after a newer one of its key changes nothing.  A batch writes its
    own rows only; buckets with many delta rows are rewritten after it.  The batch is
    named after the checkpoint and its number, so a batch that is run again adds nothing,
    and another query on the same table never takes its name.
    """
    spark = stream.sparkSession
    table = DeltaTable(spark, root, stream.schema, tuple(keys), tuple(update), newest)
    checkpoint = checkpoint or shared_dir(spark, "upsert-state")
    feed = uuid.uuid5(uuid.NAMESPACE_URL, checkpoint.rstrip("/")).hex[:12]

    def load(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, f"{feed}-{batch_id:09d}")
        if compact and table.compact():
            table.vacuum()

    query = (
        stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return table


def stream_interval_join(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, seconds: int, delay: str
) -> DataFrame:
    """All pairs of one key at most ``seconds`` apart.

    Both watermarks and the time bound tell Spark when a row can no longer match,
    so state holds only the rows of the last interval.
    """
    lefts = left.withColumn(left_ts, F.col(left_ts).cast("timestamp")).withWatermark(left_ts, delay)
    rights = right.withColumn(right_ts, F.col(right_ts).cast("timestamp")).withColumnRenamed(key, "_key").withWatermark(right_ts, delay)
    span = F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))
    near = (F.col(right_ts) >= F.col(left_ts) - span) & (F.col(right_ts) <= F.col(left_ts) + span)
    joined = lefts.join(rights, (F.col(key) == F.col("_key")) & near).drop("_key")
    return joined.withColumns({c: F.col(c).cast("timestamp_ntz") for c in (left_ts, right_ts)})


_STATE = "in_run boolean, run_start long, run_end long, n long, wait_ts array<long>, wait_in array<boolean>"


def stream_state_runs(stream: DataFrame, key: str, ts: str, state: str, value: str, delay: str) -> DataFrame:
    """Closed runs of a state per key: start, end, rows.

    Rows wait until the watermark has passed them, so rows that arrive out of
    order within ``delay`` are still put in order.  A key's state is one open run
    and the rows inside the delay; a micro-batch's rows per key are bounded by
    the source's rate limit.
    """
    key_type = stream.schema[key].dataType.simpleString()
    schema = f"{key} {key_type}, run_start timestamp_ntz, run_end timestamp_ntz, n_rows long"
    timed = stream.select(
        key, F.col(ts).cast("timestamp").alias(ts), F.col(state).eqNullSafe(value).alias("_in"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"),
    ).withWatermark(ts, delay)

    def step(keys: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        inside, start, end, n, wait_ts, wait_in = held.get if held.exists else (False, 0, 0, 0, [], [])
        waiting = list(zip(wait_ts, wait_in))
        if not held.hasTimedOut:
            for frame in frames:
                waiting.extend(zip(frame["_us"].tolist(), frame["_in"].tolist()))
        passed = held.getCurrentWatermarkMs() * 1000
        waiting.sort()
        closed = []
        ready = [row for row in waiting if row[0] <= passed]
        waiting = waiting[len(ready):]
        if ready:
            at = np.array([row[0] for row in ready], np.int64)
            now = np.array([bool(row[1]) for row in ready])
            before = np.concatenate([[inside], now[:-1]])
            opened, shut = np.flatnonzero(now & ~before), np.flatnonzero(~now & before)
            total = np.concatenate([[0], np.cumsum(now)])
            begins = [*([(start, -n)] if inside else []), *((int(at[i]), int(total[i])) for i in opened)]
            for (began, counted), i in zip(begins, shut):
                last = int(at[i - 1]) if i else end
                closed.append((keys[0], pd.Timestamp(began, unit="us"), pd.Timestamp(last, unit="us"), int(total[i]) - counted))
            if inside := bool(now[-1]):
                start, counted = begins[-1]
                n, end = int(total[-1]) - counted, int(at[-1])
        held.update((inside, start, end, n, [w[0] for w in waiting], [bool(w[1]) for w in waiting]))
        if waiting:
            held.setTimeoutTimestamp(max(waiting[0][0] // 1000 + 1, held.getCurrentWatermarkMs() + 1))
        if closed:
            yield pd.DataFrame(closed, columns=[key, "run_start", "run_end", "n_rows"])

    return timed.groupBy(key).applyInPandasWithState(
        step, schema, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
