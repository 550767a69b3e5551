"""Sorting, limits, paging and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablecraft.plans.ordered import order_of


def _columns(order: Sequence[str], nulls_last: bool) -> list[Column]:
    out = []
    for c, up in order_of(*order):
        col = F.col(c)
        if nulls_last:
            out.append(col.asc_nulls_last() if up else col.desc_nulls_last())
        else:
            out.append(col.asc() if up else col.desc())
    return out


def sort_rows(df: DataFrame, *order: str, nulls_last: bool = False) -> DataFrame:
    """Total order: Spark samples the keys and range-partitions the rows.

    The row's place in the input is the last key, so rows that tie can still go
    to different tasks.
    """
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    return placed.orderBy(*_columns(order, nulls_last), "_place").drop("_place")


def top_k(df: DataFrame, order: Sequence[str], k: int) -> DataFrame:
    """First ``k`` rows in order; each task keeps only its own best ``k``."""
    return df.orderBy(*_columns(order, False)).limit(k)


def page_offset(df: DataFrame, order: Sequence[str], skip: int, size: int) -> DataFrame:
    return df.orderBy(*_columns(order, False)).offset(skip).limit(size)


def page_keyset(df: DataFrame, key: str, after, size: int) -> DataFrame:
    """Next page after the last key seen: the filter is pushed to the scan."""
    return df.filter(F.col(key) > after).orderBy(key).limit(size)


def distinct_rows(df: DataFrame, *cols: str) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` lets Spark keep one row per key and task before the
    shuffle, so a hot key sends one row per task.
    """
    w = W.partitionBy(*keys).orderBy(*_columns(order, False))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def duplicate_rows(df: DataFrame, *cols: str) -> DataFrame:
    """Column values that occur more than once, with the number of copies."""
    cols = cols or tuple(df.columns)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def top_customers(counts: DataFrame, names: Sequence[str], count: str, k: int = 10) -> DataFrame:
    """Largest counts with a display name joined from several columns."""
    shown = counts.withColumn("full_name", F.concat_ws(" ", *names))
    return shown.orderBy(F.col(count).desc(), F.col("full_name")).limit(k)
