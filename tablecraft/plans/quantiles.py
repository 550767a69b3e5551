"""Exact continuous percentiles without holding a group in one buffer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.plans.ordered import order_of, running
from tablecraft.plans.skew import MAX_ROWS, Hot, Limit, attach, find_hot, join_keys, with_scalars

# Spark's exact aggregate keeps a group's distinct values in one hash map.
BUFFER_ROWS = 500_000
ACCURACY = 10_000


def buffered(max_rows: Limit) -> Limit:
    """The row limit to look for before an exact percentile: never more than its buffer may hold."""
    return min(max_rows, BUFFER_ROWS) if isinstance(max_rows, int) else max_rows


def percentiles(
    df: DataFrame, by: Sequence[str], col: str, wanted: dict[str, float],
    approx: bool = False, max_rows: Limit = MAX_ROWS, beside: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per group with interpolated percentiles; NULL values are ignored.

    Ordinary groups use Spark's exact aggregate.  If some group is too large for
    its buffer, the mergeable sketch gives two values that enclose each wanted
    rank; one more pass counts what lies below and collects the values between,
    a few in ten thousand.  The result is exact, and checked: a rank outside its
    bracket is an error.  ``approx`` returns the sketch's answer.  ``beside`` are
    further aggregates to report with the percentiles.
    """
    by = list(by)
    more = [c.alias(n) for n, c in (beside or {}).items()]
    if approx:
        return df.groupBy(*by).agg(
            *more, *[F.percentile_approx(col, F.lit(p), F.lit(ACCURACY)).alias(n) for n, p in wanted.items()]
        )
    hot = find_hot(df, by, buffered(max_rows))
    if hot is None:
        return df.groupBy(*by).agg(*more, *[F.percentile(col, F.lit(p)).alias(n) for n, p in wanted.items()])

    exact = _bracketed(df.filter(F.col(col).isNotNull()).select(*by, col), by, col, wanted, hot)
    if not more and not by:
        return exact
    if not by:
        return with_scalars(df.agg(*more), exact)
    # Groups with only NULL values are absent from the brackets.
    groups = df.groupBy(*by).agg(*more) if more else df.select(*by).distinct()
    return join_keys(groups, exact, by)


def _bracketed(df: DataFrame, by: list[str], col: str, wanted: dict[str, float], hot: Hot) -> DataFrame:
    # The sketch is off by at most n / ACCURACY ranks; four times that on each side.
    slack = 4 / ACCURACY
    ends = [max(0.0, p - slack) for p in wanted.values()] + [min(1.0, p + slack) for p in wanted.values()]
    sketch = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_all"),
        F.percentile_approx(col, F.array(*[F.lit(e) for e in ends]), F.lit(ACCURACY)).alias("_ends"),
    )
    if by:
        rows = attach(df, sketch, by, "left", hot)
    else:
        # one row: as literals the later passes need not compute it again
        rows_all, found_ends = sketch.first()
        kind = df.schema[col].dataType
        literals = [F.lit(e).cast(kind) for e in (found_ends or [None] * len(ends))]
        rows = df.withColumns({"_all": F.lit(rows_all), "_ends": F.array(*literals)})
    names = list(wanted)
    # Far below the sketch's resolution a group is simply taken whole.
    whole = F.col("_all") <= 10 * ACCURACY
    low = [F.get("_ends", F.lit(i)) for i in range(len(names))]
    high = [F.get("_ends", F.lit(i + len(names))) for i in range(len(names))]
    value = F.col(col)

    below = rows.groupBy(*by).agg(
        F.max("_all").alias("_all"), F.array(*[F.count_if(~whole & (value < lo)) for lo in low]).alias("_below")
    )
    inside = F.array_compact(
        F.array(*[F.when(whole | ((value >= lo) & (value <= hi)), F.lit(i)) for i, (lo, hi) in enumerate(zip(low, high))])
    )
    # Equal values are counted before anything is ordered.
    near = rows.select(*by, value, F.explode(inside).alias("_p")).groupBy(*by, "_p", col).agg(F.count(F.lit(1)).alias("_c"))
    upto = running(near, [*by, "_p"], order_of(col), {"_upto": ("sum", "_c")}, max_rows=hot.max_rows)
    if by:
        placed = attach(upto, below, by, "left", hot.max_rows)
    else:
        placed = with_scalars(upto, below)

    def found(i: int, p: float) -> list[Column]:
        rank = (F.col("_all") - 1) * F.lit(p)
        reach = F.get("_below", F.lit(i)) + F.col("_upto")
        mine = F.col("_p") == i
        return [
            F.min(F.when(mine & (reach >= F.floor(rank) + 1), value)).alias(f"_lo{i}"),
            F.min(F.when(mine & (reach >= F.ceil(rank) + 1), value)).alias(f"_hi{i}"),
            F.max(F.when(mine, F.get("_below", F.lit(i)) <= F.floor(rank))).alias(f"_ok{i}"),
            F.max(rank - F.floor(rank)).alias(f"_part{i}"),
        ]

    picked = placed.groupBy(*by).agg(*[c for i, p in enumerate(wanted.values()) for c in found(i, p)])
    out = []
    for i, name in enumerate(names):
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        value_at = lo + (hi - lo) * F.col(f"_part{i}")
        sound = F.col(f"_ok{i}") & lo.isNotNull() & hi.isNotNull()
        out.append(
            F.when(sound, value_at).otherwise(F.raise_error(F.lit(f"{name}: rank outside its bracket")).cast("double")).alias(name)
        )
    return picked.select(*by, *out)
