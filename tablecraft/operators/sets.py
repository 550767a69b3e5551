"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other)
    return first


def union_distinct(first: DataFrame, *others: DataFrame) -> DataFrame:
    return union_all(first, *others).distinct()


def minus(left: DataFrame, right: DataFrame, keep_copies: bool = False) -> DataFrame:
    """Rows of ``left`` not in ``right``, once each; or copy by copy."""
    return left.exceptAll(right) if keep_copies else left.subtract(right)
