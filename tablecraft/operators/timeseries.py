"""Time-series and feature jobs."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.functions.exprs import cyclic, dow0, seconds_between, width_bucket_col
from tablecraft.plans.ordered import PIECE, cut, framed, last_known, next_known, order_of, running
from tablecraft.plans.quantiles import percentiles
from tablecraft.plans.skew import HOT, MAX_ROWS, Hot, Limit, attach, find_hot, join_keys, with_scalars


def bucket_start(ts: str, seconds: int) -> Column:
    """Start of the fixed-width time bucket, counted from 1970."""
    return F.window(F.col(ts), f"{seconds} seconds")["start"]


def bucket_agg(
    df: DataFrame, key: str, ts: str, value: str, seconds: int, low: float, high: float, bins: int,
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Per key, time bucket and value bin: the maximum and the exact 99th percentile."""
    placed = df.select(
        key, bucket_start(ts, seconds).alias("window_ts"), width_bucket_col(value, low, high, bins).alias("value_bin"), value
    )
    return percentiles(
        placed, [key, "window_ts", "value_bin"], value, {"p99_value": 0.99}, max_rows=max_rows,
        beside={"max_value": F.max(value)},
    )


def cyclical_features(df: DataFrame, ts: str) -> DataFrame:
    """Hour, day of week and month with their sine and cosine."""
    parts = {"hour": (F.hour(ts), 24.0), "dow": (dow0(ts), 7.0), "month": (F.month(ts), 12.0)}
    cols = {}
    for name, (part, period) in parts.items():
        sine, cosine = cyclic(part, period)
        cols |= {name: part, f"{name}_sin": sine, f"{name}_cos": cosine}
    return df.withColumns(cols)


def state_runs(
    df: DataFrame, key: str, ts: str, state: str, value: str, max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """Rows in a state with the start, end and length of their unbroken run.

    A run starts where the row before is in another state or missing, and ends
    where the row after is; both ends are carried along the run.
    """
    limit = find_hot(df, [key], max_rows)
    inside = F.col(state).eqNullSafe(value)
    edges = framed(
        df, [key], order_of(ts), 1, 1,
        lambda w: {
            "_starts": inside & ~F.coalesce(F.lag(inside).over(w), F.lit(False)),
            "_ends": inside & ~F.coalesce(F.lead(inside).over(w), F.lit(False)),
        },
        limit,
    )
    started = last_known(edges, [key], order_of(ts), {"run_start": F.when(F.col("_starts"), F.col(ts))}, max_rows=limit)
    both = next_known(
        started, [key], order_of(ts), {"run_end": F.when(F.col("_ends"), F.col(ts))}, current=True, max_rows=limit
    )
    runs = both.filter(inside).drop("_starts", "_ends")
    return runs.withColumn("seconds_in_state", seconds_between("run_end", "run_start"))


def sessionize(
    df: DataFrame, key: str, ts: str, gap_seconds: float, out: str = "session_id", max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """Number each row's session; a gap longer than the limit starts a new one."""
    limit = find_hot(df, [key], max_rows)
    flagged = framed(
        df, [key], order_of(ts), 1, 0,
        lambda w: {
            "_new": F.when(F.coalesce(seconds_between(F.col(ts), F.lag(ts).over(w)) > gap_seconds, F.lit(True)), 1).otherwise(0)
        },
        limit,
    )
    return running(flagged, [key], order_of(ts), {out: ("sum", "_new")}, "range", max_rows=limit).drop("_new")


def sessions(df: DataFrame, key: str, ts: str, gap_seconds: float, max_rows: Limit = MAX_ROWS) -> DataFrame:
    """One row per session with start, end, event count and minutes."""
    rows = sessionize(df, key, ts, gap_seconds, max_rows=max_rows)
    out = rows.groupBy(key, "session_id").agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count(F.lit(1)).alias("n_events")
    )
    return out.withColumn("minutes", seconds_between("session_end", "session_start") / 60)


def detrend_dow(df: DataFrame, ts: str, value: str, max_rows: Limit = MAX_ROWS) -> DataFrame:
    """Value minus its day-of-week mean and minus its day-of-week median."""
    placed = df.withColumn("dow", dow0(ts))
    base = percentiles(
        placed.select("dow", value), ["dow"], value, {"dow_median": 0.5}, max_rows=max_rows,
        beside={"dow_mean": F.avg(value)},
    )
    # seven rows, and one more for NULL times
    wide = join_keys(placed, F.broadcast(base), ["dow"])
    return wide.withColumns(
        {
            "detrended_value": F.col(value) - F.col("dow_mean"),
            "robust_detrended_value": F.col(value) - F.col("dow_median"),
        }
    )


def detrend_dual(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Value minus the average of its day-of-week mean and its month mean."""
    placed = df.withColumns({"_dow": dow0(ts), "_mon": F.month(ts)})
    by_dow = placed.groupBy("_dow").agg(F.avg(value).alias("_dow_avg"))
    by_mon = placed.groupBy("_mon").agg(F.avg(value).alias("_mon_avg"))
    # at most 8 and 13 rows
    wide = join_keys(join_keys(placed, F.broadcast(by_dow), ["_dow"]), F.broadcast(by_mon), ["_mon"])
    adjusted = F.col(value) - (F.col("_dow_avg") + F.col("_mon_avg")) / 2
    return wide.withColumn("seasonality_adjusted", adjusted).drop("_dow", "_mon", "_dow_avg", "_mon_avg")


def _smooth(alpha: float, value: str, out: str):
    """Arrow batches sorted by group, ``_k`` = 1 on the first row of each group."""
    keep = 1 - alpha

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.nan
        for batch in batches:
            starts = batch.column(batch.schema.get_field_index("_k")).to_numpy(zero_copy_only=False) == 1
            values = batch.column(batch.schema.get_field_index(value)).cast(pa.float64()).to_numpy(zero_copy_only=False)
            smooth = []
            for first, v in zip(starts.tolist(), values.tolist()):
                level = v if first else alpha * v + keep * level
                smooth.append(level)
            column = pa.array(np.array(smooth, dtype="float64"), from_pandas=True)
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, out])

    return run


def ema(
    df: DataFrame, key: str, ts: str, value: str, alpha: float = 0.1, tie: Sequence[str] = (), out: str = "ema",
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Exponential moving average per key, seeded with the key's first value.

    The recurrence runs over sorted Arrow batches with one number of state, so a
    key need not fit in memory.  A key too large for one task is cut along time:
    every piece is smoothed from its own first value, and the difference to the
    true start fades by ``(1 - alpha) ** k``, which is added back exactly.  A NULL
    value makes the average NULL from there on, as the recurrence does.
    """
    order = order_of(ts, *tie)
    done = cut(df, [key], order, max_rows)
    rows, keys = (df, [key]) if done is None else (done[0], [key, PIECE])
    numbered = rows.withColumn("_k", F.row_number().over(W.partitionBy(*keys).orderBy(ts, *tie)))
    schema = T.StructType([*numbered.schema.fields, T.StructField(out, T.DoubleType())])
    local = numbered.mapInArrow(_smooth(alpha, value, out), schema)
    if done is None:
        return local.drop("_k")

    pieces = local.filter(F.col(HOT).isNotNull()).groupBy(key, PIECE).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(F.col(value).cast("double"), "_k").alias("first"),
        F.max_by(F.struct(out), "_k")[out].alias("last"),
    )
    key_type = df.schema[key].dataType.simpleString()

    def starts(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(PIECE)
        gaps, end = [], None
        for n, first, last in zip(pdf["n"], pdf["first"], pdf["last"]):
            gap = 0.0 if end is None else end - first
            gaps.append(None if np.isnan(gap) else gap)
            end = last + (1 - alpha) ** n * gap
        return pd.DataFrame({key: pdf[key], PIECE: pdf[PIECE], "_gap": gaps})

    # one row per piece, at most MAX_PIECES + 2 for a key
    gaps = pieces.groupBy(key).applyInPandas(starts, f"{key} {key_type}, {PIECE} long, _gap double")
    joined = join_keys(local, gaps, [key, PIECE])
    fade = F.pow(F.lit(1 - alpha), F.col("_k")) * F.col("_gap")
    fixed = F.when(F.col(HOT).isNull(), F.col(out)).otherwise(F.col(out) + fade)
    return joined.withColumn(out, fixed).select(*df.columns, out)


# Steps of a grid that one row is spread to at a time.
_GRID_CHUNK = 10_000


def _filled_grid(
    latest: DataFrame, keys: DataFrame, key: str, seconds: int, low: str, high: str, out: str, max_rows: Limit
) -> DataFrame:
    """One row per key and step with the last known ``_v``; ``low`` and ``high`` are columns of ``keys``.

    A grid is regular, so it is cut into chunks of equal length by the number of the
    step.  A chunk begins with what the chunks before it hand on, and the known values
    inside end one stretch of equal steps and begin the next; stretches are spread to
    steps at last.  Known values and one row per chunk are sent and sorted, never the
    grid, and no cell or window is longer than a chunk.
    """
    limit = max_rows.max_rows if isinstance(max_rows, Hot) else max_rows
    size = min(limit or _GRID_CHUNK, _GRID_CHUNK)
    step = F.make_dt_interval(secs=F.lit(seconds).cast("decimal(18,6)"))
    chunk = F.floor(F.col("_slot") / size).alias("_chunk")
    last = F.floor(seconds_between(high, low) / seconds)
    firsts = F.sequence(F.lit(0).cast("long"), F.col("_last"), F.lit(size).cast("long"))
    chunks = keys.withColumn("_last", last).select(key, low, "_last", F.explode(firsts).alias("_slot")).select("*", chunk)
    known = latest.filter("_slot IS NOT NULL AND _v IS NOT NULL").select(key, chunk, "_slot", "_v", F.lit(1).alias("_seen"))

    handed = known.groupBy(key, "_chunk").agg(F.max_by("_v", "_slot").alias("_end"))
    # one row per chunk
    earlier = W.partitionBy(key).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    begins = join_keys(chunks, handed, [key, "_chunk"], "left").select(
        *chunks.columns, F.last("_end", ignorenulls=True).over(earlier).alias("_v"), F.lit(0).alias("_seen")
    )
    # a row here is up to a chunk of rows later: AQE, which sees bytes, would merge too many into one task
    conf = latest.sparkSession.conf
    spread = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions")
    points = begins.unionByName(known, allowMissingColumns=True).repartition(int(spread), key, "_chunk")
    inside = W.partitionBy(key, "_chunk").orderBy("_slot", "_seen")
    chunk_end = F.least(F.first("_last").over(inside), F.col("_chunk") * size + (size - 1))
    stretches = points.withColumns(
        {low: F.first(low).over(inside), "_until": F.coalesce(F.lead("_slot").over(inside) - 1, chunk_end)}
    ).filter("_slot <= _until")
    steps = stretches.select(key, low, F.col("_v").alias(out), F.explode(F.sequence("_slot", "_until")).alias("_slot"))
    return steps.withColumn("bucket_ts", F.col(low) + step * F.col("_slot"))


def grid_ffill(
    df: DataFrame, key: str, ts: str, value: str, seconds: int, tie: Sequence[str] = (), out: str = "imputed_value",
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """A regular grid per key over the whole table's time range.

    Each bucket shows its latest value, or the last known one before it; buckets
    before the key's first value are NULL.  Rows are reduced to one per bucket
    first; a grid is filled in chunks of at most ``max_rows`` steps.  A NULL key is a
    key like any other.
    """
    span = df.agg(F.min(ts).alias("_low"), F.max(ts).alias("_high"))
    placed = with_scalars(df, span).withColumn("_slot", F.floor(seconds_between(ts, "_low") / seconds))
    latest = placed.groupBy(key, "_slot").agg(F.max_by(value, F.struct(ts, *tie)).alias("_v"))
    keys = with_scalars(df.select(key).distinct(), span)
    return _filled_grid(latest, keys, key, seconds, "_low", "_high", out, max_rows).select(key, "bucket_ts", out)


def gap_fill_prev(
    df: DataFrame, key: str, ts: str, value: str, seconds: int = 3600, tie: Sequence[str] = (), max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """Each key on its own regular spine, gaps filled with the value before."""
    spans = df.groupBy(key).agg(F.min(ts).alias("_low"), F.max(ts).alias("_high"))
    placed = attach(df, spans, [key], "inner", max_rows).withColumn("_slot", F.floor(seconds_between(ts, "_low") / seconds))
    latest = placed.groupBy(key, "_slot").agg(F.max_by(value, F.struct(ts, *tie)).alias("_v"))
    filled = _filled_grid(latest, spans, key, seconds, "_low", "_high", "_filled", max_rows)
    return filled.select(key, F.col("bucket_ts").alias(ts), F.col("_filled").alias(value))


def calendar_dim(spark: SparkSession, low: str, high: str) -> DataFrame:
    """One row per day with year, quarter and weekday or weekend."""
    days = F.sequence(F.lit(low).cast("date"), F.lit(high).cast("date"), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("dt")).select(
        "dt",
        F.year("dt").alias("year"),
        F.quarter("dt").alias("quarter"),
        F.when(dow0("dt").isin(0, 6), "Weekend").otherwise("Weekday").alias("day_type"),
    )


def month_spine(spark: SparkSession, low: str, high: str) -> DataFrame:
    """First days of the months from ``low`` to ``high`` inclusive."""
    months = F.sequence(F.lit(low).cast("date"), F.lit(high).cast("date"), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("month"))


def number_spine(spark: SparkSession, low: int, high: int, name: str = "num") -> DataFrame:
    """Whole numbers from ``low`` to ``high`` inclusive, made on the executors."""
    return spark.range(low, high + 1).withColumnRenamed("id", name)


def rolling_volatility(
    df: DataFrame, key: str, ts: str, value: str, window: int = 30, baseline: int = 60, max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """Deviation of the last ``window + 1`` rows against the same ``baseline`` rows earlier."""

    def stepwise(w):
        return {"rolling_volatility": F.stddev_samp(value).over(w.rowsBetween(-window, 0))}

    hot = find_hot(df, [key], max_rows)
    vol = framed(df, [key], order_of(ts), window, 0, stepwise, hot)
    based = framed(
        vol, [key], order_of(ts), baseline, 0,
        lambda w: {"baseline_volatility": F.lag("rolling_volatility", baseline).over(w)}, hot,
    )
    up = F.col("rolling_volatility") > F.col("baseline_volatility")
    return based.withColumn("regime_shift_flag", F.when(up, "volatility_up").otherwise("stable"))


def user_features(
    df: DataFrame, user: str, spend: str, login: str, no_login: str = "2000-01-01"
) -> DataFrame:
    """Total spend and last login per user; NULLs get defaults, negative spend is left out."""
    clean = df.select(
        user,
        F.coalesce(F.col(spend), F.lit(0)).alias("_spend"),
        F.coalesce(F.col(login), F.lit(no_login).cast(df.schema[login].dataType)).alias("_login"),
    )
    kept = clean.filter("_spend >= 0")
    return kept.groupBy(user).agg(F.sum("_spend").alias("total_spend"), F.max("_login").alias("last_login"))
