"""Window functions.

Frames that look a fixed number of rows or seconds around a row, and running
values, go through :mod:`tablecraft.plans.ordered`, which cuts groups that are
too large for one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablecraft.functions.exprs import seconds_between
from tablecraft.plans.ordered import (
    framed, last_known, next_known, order_of, ranked, running, tiles, time_framed, time_totals,
)
from tablecraft.plans.quantiles import buffered, percentiles
from tablecraft.plans.skew import MAX_ROWS, Limit, attach, find_hot, over_group


def rank_all(
    df: DataFrame, order: Sequence[str], tie: Sequence[str], by: Sequence[str] = (), max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """ROW_NUMBER (ties broken by ``tie``), RANK and DENSE_RANK beside each row."""
    limit = find_hot(df, by, max_rows)
    ranks = ranked(df, by, order_of(*order), rank="rank", dense_rank="dense_rank", max_rows=limit)
    return ranked(ranks, by, order_of(*order, *tie), row_number="row_number", max_rows=limit)


def dense_rank_by(
    df: DataFrame, by: Sequence[str], order: Sequence[str], out: str = "dense_rank", max_rows: Limit = MAX_ROWS
) -> DataFrame:
    return ranked(df, by, order_of(*order), dense_rank=out, max_rows=max_rows)


def rank_of_agg(
    df: DataFrame, keys: Sequence[str], value: Column, out: str = "ranking", max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """Rank of groups by an aggregate, largest first."""
    totals = df.groupBy(*keys).agg(value.alias("_v"))
    return ranked(totals, [], order_of("-_v"), rank=out, max_rows=max_rows).drop("_v")


def top_n_rank(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int, out: str = "rank") -> DataFrame:
    """Rows ranked ``n`` or better in their group, ties kept, NULL values left out.

    The filter on ``rank`` makes Spark keep only the best rows of each group on
    every task before the shuffle, so a hot group sends few rows.
    """
    for c, _ in order_of(*order):
        df = df.filter(F.col(c).isNotNull())
    sort = [F.col(c).asc() if up else F.col(c).desc() for c, up in order_of(*order)]
    return df.withColumn(out, F.rank().over(W.partitionBy(*by).orderBy(*sort))).filter(F.col(out) <= n)


def number_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[str], out: str = "rn", max_rows: Limit = MAX_ROWS
) -> DataFrame:
    return ranked(df, by, order_of(*order), row_number=out, max_rows=max_rows)


def top_n_rows(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int, out: str = "rn") -> DataFrame:
    """First ``n`` rows of each group; limited per task before the shuffle."""
    sort = [F.col(c).asc() if up else F.col(c).desc() for c, up in order_of(*order)]
    return df.withColumn(out, F.row_number().over(W.partitionBy(*by).orderBy(*sort))).filter(F.col(out) <= n)


def decile(
    df: DataFrame, order: Sequence[str], n: int = 10, out: str = "decile", by: Sequence[str] = (),
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """NTILE over the whole table or per group."""
    return tiles(df, list(by), order_of(*order), n, out, max_rows)


def decile_approx(df: DataFrame, col: str, n: int = 10, out: str = "decile", error: float = 0.001) -> DataFrame:
    """Decile by approximate cut points: no sort and no shuffle of the rows."""
    cuts = sorted(set(df.approxQuantile(col, [i / n for i in range(1, n)], error)))
    splits = [float("-inf"), *cuts, float("inf")]
    placed = Bucketizer(splits=splits, inputCol=col, outputCol="_bin", handleInvalid="keep").transform(df)
    return placed.withColumn(out, F.when(F.col(col).isNotNull(), F.col("_bin").cast("int") + 1)).drop("_bin")


def lag_features(
    df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, steps: Sequence[int], prefix: str = "prev",
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Earlier values of a column as ``prefix_1``, ``prefix_2``, ..."""
    return framed(
        df, by, order_of(*order), max(steps), 0,
        lambda w: {f"{prefix}_{s}": F.lag(col, s).over(w) for s in steps}, max_rows,
    )


def lead_features(
    df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, steps: Sequence[int], prefix: str = "next",
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    return framed(
        df, by, order_of(*order), 0, max(steps),
        lambda w: {f"{prefix}_{s}": F.lead(col, s).over(w) for s in steps}, max_rows,
    )


def pct_change(
    df: DataFrame, order: Sequence[str], col: str, by: Sequence[str] = (), max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """Change against the row before and of the row after, as ratios."""
    value = F.col(col)

    def columns(w):
        before, after = F.lag(col).over(w), F.lead(col).over(w)
        return {
            "previous": before,
            "following": after,
            "change_back": (value - before) / F.nullif(before, F.lit(0).cast("double")),
            "change_ahead": (after - value) / F.nullif(value, F.lit(0).cast("double")),
        }

    return framed(df, by, order_of(*order), 1, 1, columns, max_rows)


def days_between_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[str], ts: str, extra: Sequence[str] = (),
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Days since the previous row of the group, with its date and other columns."""

    def columns(w):
        out = {f"previous_{c}": F.lag(c).over(w) for c in (ts, *extra)}
        return out | {"days_between": F.datediff(F.col(ts), F.lag(ts).over(w))}

    return framed(df, by, order_of(*order), 1, 0, columns, max_rows)


def first_last_value(
    df: DataFrame, order: str, col: str, by: Sequence[str] = (), max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """First and last value of the whole group beside each row (full frame)."""
    return over_group(
        df, by, {f"first_{col}": F.min_by(col, order), f"last_{col}": F.max_by(col, order)}, max_rows
    )


def avg_over(
    df: DataFrame, by: Sequence[str], col: str, out: str = "average", max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """Group average beside each row; the whole table when ``by`` is empty."""
    return over_group(df, by, {out: F.avg(col)}, max_rows)


def avg_of_sum(df: DataFrame, keys: Sequence[str], part: Sequence[str], col: str, max_rows: Limit = MAX_ROWS) -> DataFrame:
    """Totals per key and the average of those totals in each partition."""
    totals = df.groupBy(*keys).agg(F.sum(col).alias("total"))
    return over_group(totals, part, {"average_total": F.avg("total")}, max_rows)


def pct_of_total(
    df: DataFrame, part: Sequence[str], keys: Sequence[str], max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """Row counts per key and their share of the partition's rows."""
    counts = df.groupBy(*part, *keys).agg(F.count(F.lit(1)).alias("n"))
    sized = over_group(counts, part, {"part_total": F.sum("n")}, max_rows)
    return sized.withColumn("pct", F.col("n") / F.col("part_total") * 100)


def running_total_range(
    df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, out: str = "running_total",
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Running sum with the default frame: rows that tie share one total."""
    return running(df, by, order_of(*order), {out: ("sum", col)}, "range", max_rows=max_rows)


def running_total_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, out: str = "running_total",
    unknown: str | None = None, max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Running sum row by row; with ``unknown``, NULL text keys get that name."""
    if unknown is not None:
        df = df.withColumns({k: F.coalesce(F.col(k).cast("string"), F.lit(unknown)) for k in by})
    return running(df, by, order_of(*order), {out: ("sum", col)}, max_rows=max_rows)


def daily_then_cumulative(
    df: DataFrame, by: Sequence[str], ts: str, col: str, max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """Sum per day first, then the running total over the days."""
    days = df.groupBy(*by, F.to_date(ts).alias("day")).agg(F.sum(col).alias("day_total"))
    return running(days, by, order_of("day"), {"cumulative": ("sum", "day_total")}, max_rows=max_rows)


def moving_avg(
    df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, before: int, after: int,
    out: str = "moving_avg", max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Average over ``before`` rows back to ``after`` rows ahead."""
    return moving_avgs(df, by, order, col, {out: (before, after)}, max_rows)


def moving_avgs(
    df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, frames: dict[str, tuple[int, int]],
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Averages over several row frames ``{name: (before, after)}`` in one pass."""
    before, after = (max(f[i] for f in frames.values()) for i in (0, 1))
    return framed(
        df, by, order_of(*order), before, after,
        lambda w: {out: F.avg(col).over(w.rowsBetween(-b, a)) for out, (b, a) in frames.items()}, max_rows,
    )


def rolling_sum_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[str], col: str, before: int, out: str = "rolling_rows",
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    return framed(
        df, by, order_of(*order), before, 0,
        lambda w: {out: F.sum(col).over(w.rowsBetween(-before, 0))}, max_rows,
    )


def rolling_sum_time(
    df: DataFrame, by: Sequence[str], ts: str, col: str, seconds: int, out: str = "rolling_time",
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Sum over the last ``seconds`` of time, peers included."""
    hot = find_hot(df, by, max_rows)
    if hot is None:
        return time_framed(df, by, ts, seconds, lambda w: {out: F.sum(col).over(w)}, None)
    line = time_totals(df, by, ts, seconds, {out: ("sum", col)}, hot)
    return attach(df, line, [*by, ts], "left", hot.max_rows)


def rolling_sums(
    df: DataFrame, by: Sequence[str], ts: str, col: str, before: int, seconds: int, max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """Sums over the last rows and over the last seconds, with one look at the group sizes."""
    limit = find_hot(df, by, max_rows)
    rows = rolling_sum_rows(df, by, [ts], col, before, max_rows=limit)
    return rolling_sum_time(rows, by, ts, col, seconds, max_rows=limit)


def event_distance(
    df: DataFrame, by: Sequence[str], ts: str, event: Column, max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """Times of the last event (this row included) and the next one, and the seconds to them."""
    limit = find_hot(df, by, max_rows)
    at = F.when(event, F.col(ts))
    seen = last_known(df, by, order_of(ts), {"last_event_ts": at}, max_rows=limit)
    both = next_known(seen, by, order_of(ts), {"next_event_ts": at}, max_rows=limit)
    return both.withColumns(
        {
            "seconds_since_last": seconds_between(ts, "last_event_ts"),
            "seconds_until_next": seconds_between("next_event_ts", ts),
        }
    )


def median_over(
    df: DataFrame, by: Sequence[str], col: str, out: str = "median", max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """Interpolated median of the group beside each row."""
    limit = find_hot(df, by, buffered(max_rows))
    return attach(df, percentiles(df, by, col, {out: 0.5}, max_rows=limit), by, "left", limit)


def partition_skew(df: DataFrame, by: Sequence[str], more_than: int) -> DataFrame:
    """Window partitions with more rows than a limit."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > more_than)


def duplicate_order_keys(df: DataFrame, order: Sequence[str], k: int = 50) -> DataFrame:
    """Order values that repeat, most frequent first: a report of ``k`` rows."""
    repeats = df.groupBy(*order).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")
    return repeats.orderBy(F.desc("cnt"), *order).limit(k)
