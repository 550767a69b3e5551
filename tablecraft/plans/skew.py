"""Hot groups: find them, spread them, and join one row per key back to them.

A group is hot when it holds more rows than one task should sort.  At most
``MAX_HOT`` groups are ever listed.  That is enough: the group after the
``MAX_HOT`` largest cannot hold more than ``rows / MAX_HOT`` rows, which is an
ordinary share of the data for one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_ROWS = 5_000_000
MAX_HOT = 10_000
MAX_SALTS = 1_000

HOT = "_hot_rows"


@dataclass
class Hot:
    """What one look at the group sizes found, for operators that take several steps."""

    groups: DataFrame
    max_rows: int
    cuts: dict[str, tuple[list[float], list[float]]] = field(default_factory=dict)


# A row limit to look for; None when groups are known to be small; or what was found.
Limit = int | None | Hot


def find_hot(df: DataFrame, by: Sequence[str], limit: Limit = MAX_ROWS) -> Hot | None:
    """The groups with more rows than the limit and their sizes, or None.

    One aggregation with map-side combine over the key columns only; the result
    comes back as a local relation of at most ``MAX_HOT`` rows.
    """
    if limit is None or isinstance(limit, Hot):
        return limit
    spark = df.sparkSession
    if not by:
        rows = df.count()
        return Hot(spark.createDataFrame([(rows,)], f"{HOT} long"), limit) if rows > limit else None
    sizes = (
        df.groupBy(*by)
        .agg(F.count(F.lit(1)).alias(HOT))
        .filter(F.col(HOT) > limit)
        .orderBy(F.desc(HOT))
        .limit(MAX_HOT)
    )
    found = sizes.collect()
    if not found:
        return None
    fields = [T.StructField(f.name, f.dataType, True) for f in sizes.schema.fields]
    return Hot(spark.createDataFrame(found, T.StructType(fields)), limit)


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Null-safe join that keeps the left columns plus the right non-key columns."""
    named = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(named[f"_r_{k}"]) for k in keys])
    return left.join(named, cond, how).drop(*[f"_r_{k}" for k in keys])


def mark_hot(df: DataFrame, by: Sequence[str], hot: Hot) -> DataFrame:
    """Add the size of the row's group for hot groups, NULL for the others."""
    if not by:
        return df.withColumn(HOT, F.lit(hot.groups.first()[0]).cast("long"))
    # at most MAX_HOT rows, see find_hot
    return join_keys(df, F.broadcast(hot.groups), by, "left")


def attach(
    df: DataFrame,
    per_key: DataFrame,
    by: Sequence[str],
    how: str = "left",
    max_rows: Limit = MAX_ROWS,
) -> DataFrame:
    """Join a table with one row per key to every row of that key.

    Rows of hot keys are spread over salts and only their key rows are copied,
    so no task receives a whole hot group.  Without hot keys it is a plain join,
    and AQE broadcasts the key side when its measured size allows.
    """
    hot = find_hot(df, by, max_rows)
    if hot is None:
        return join_keys(df, per_key, by, how)
    largest = hot.groups.agg(F.max(HOT)).first()[0]
    salts = min(MAX_SALTS, math.ceil(largest / hot.max_rows))
    rows = mark_hot(df, by, hot).withColumn(
        "_salt",
        F.when(F.col(HOT).isNull(), 0).otherwise(
            F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int")
        ),
    ).drop(HOT)
    copies = mark_hot(per_key, by, hot).withColumn(
        "_salt",
        F.explode(
            F.when(F.col(HOT).isNull(), F.array(F.lit(0))).otherwise(
                F.sequence(F.lit(0), F.lit(salts - 1))
            )
        ),
    ).drop(HOT)
    return join_keys(rows, copies, [*by, "_salt"], how).drop("_salt")


def over_group(
    df: DataFrame, by: Sequence[str], aggs: dict[str, Column], max_rows: Limit = MAX_ROWS
) -> DataFrame:
    """Group aggregates beside each row.

    Small groups: one window, one shuffle.  With a hot group: aggregate first
    (map-side combine), then join the one row per key back with salts.
    """
    if not by:
        return with_scalars(df, df.agg(*[c.alias(n) for n, c in aggs.items()]))
    hot = find_hot(df, by, max_rows)
    if hot is None:
        w = W.partitionBy(*by)
        return df.withColumns({n: c.over(w) for n, c in aggs.items()})
    per_key = df.groupBy(*by).agg(*[c.alias(n) for n, c in aggs.items()])
    return attach(df, per_key, by, "left", hot)


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Put the columns of a one-row table beside every row.

    The row is a scalar subquery: Spark raises if it turns out to be more than
    one row, ships a single value, and plans no join at all.
    """
    names = one_row.columns
    packed = one_row.select(F.struct(*[F.col(c) for c in names]).alias("_one_row")).scalar()
    wide = df.withColumn("_one_row", packed)
    return wide.select(*[F.col(c) for c in df.columns], *[F.col("_one_row")[c].alias(c) for c in names])
