"""Projections, filters and predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecraft.plans.skew import join_keys


def filter_rows(df: DataFrame, cond: Column) -> DataFrame:
    return df.filter(cond)


def or_as_union(df: DataFrame, p: Column, q: Column, literal: bool = False) -> DataFrame:
    """``p OR q`` as two branches.

    ``literal=True`` is plain UNION ALL: rows that satisfy both appear twice.
    Otherwise the second branch leaves out what the first already gave.
    """
    second = q if literal else q & ~F.coalesce(p, F.lit(False))
    return df.filter(p).unionAll(df.filter(second))


def not_equal(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) != value)


def ne_split(df: DataFrame, col: str, value) -> tuple[DataFrame, DataFrame]:
    """Rows below and rows above the value; NULL is in neither."""
    return df.filter(F.col(col) < value), df.filter(F.col(col) > value)


def like_filter(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """LIKE; a pure prefix pattern becomes a pushed-down StartsWith."""
    return df.filter(F.col(col).like(pattern))


def time_slice(df: DataFrame, ts: str, low, high, closed: bool = False) -> DataFrame:
    """``low <= ts < high``, or up to and including ``high`` when ``closed``."""
    c = F.col(ts)
    return df.filter(c.between(low, high)) if closed else df.filter((c >= low) & (c < high))


def null_rows(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.filter(F.col(c).isNull())
    return df


def non_null_rows(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.filter(F.col(c).isNotNull())
    return df


def positive_rows(df: DataFrame, col: str) -> DataFrame:
    """``> 0``; unlike IS NOT NULL it also drops zero and negative values."""
    return df.filter(F.col(col) > 0)


def fill_null(df: DataFrame, defaults: dict) -> DataFrame:
    """COALESCE of each column with a default value or column."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), d if isinstance(d, Column) else F.lit(d)) for c, d in defaults.items()}
    )


def blank_to_null(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in cols})


def safe_divide(top: str | Column, bottom: str | Column) -> Column:
    """Division that gives NULL for a zero divisor."""
    top = F.col(top) if isinstance(top, str) else top
    bottom = F.col(bottom) if isinstance(bottom, str) else bottom
    return top.cast("double") / F.nullif(bottom, F.lit(0).cast("double"))


def first_non_null(*cols: str, default=None) -> Column:
    """CASE form of COALESCE."""
    chosen = None
    for c in cols:
        test = F.col(c).isNotNull()
        chosen = F.when(test, F.col(c)) if chosen is None else chosen.when(test, F.col(c))
    return chosen.otherwise(F.lit(default))


def band(col: str, cuts: Sequence[float], labels: Sequence[str], unknown: str = "Unknown") -> Column:
    """Label by descending thresholds.

    Above ``cuts[0]`` is ``labels[0]``; from ``cuts[1]`` to ``cuts[0]`` is
    ``labels[1]``; below the last cut is the last label; NULL is ``unknown``.
    """
    c = F.col(col)
    out = F.when(c > cuts[0], labels[0])
    for cut, label in zip(cuts[1:], labels[1:]):
        out = out.when(c >= cut, label)
    return out.when(c < cuts[-1], labels[len(cuts)]).otherwise(unknown)


def standardise(
    df: DataFrame, col: str, variants: dict[str, Sequence[str]], clean: str, raw: str, unknown: str = "UNKNOWN"
) -> DataFrame:
    """Map spelling variants to one code; keep the original column as ``raw``."""
    out = None
    for code, spellings in variants.items():
        test = F.col(col).isin(*spellings)
        out = F.when(test, code) if out is None else out.when(test, code)
    other = F.coalesce(F.col(col), F.lit(unknown))
    out = other if out is None else out.otherwise(other)
    return df.withColumn(clean, out).withColumnRenamed(col, raw)


def standardised_view(df: DataFrame, name: str, *args, **kwargs) -> DataFrame:
    """The standardised rows as a named view; the stored table stays as it is."""
    standardise(df, *args, **kwargs).createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def prefix_match(df: DataFrame, col: str, letter: str) -> DataFrame:
    """Rows whose text starts with the letter; the scan gets it as StringStartsWith."""
    return df.filter(F.col(col).startswith(letter))


def node_type(edges: DataFrame, node: str, parent: str) -> DataFrame:
    """Root, Inner or Leaf for each (node, parent) row.

    Nodes that have children come from one distinct over the parent column, so a
    NULL parent cannot upset the test as it would with IN.
    """
    parents = edges.filter(F.col(parent).isNotNull()).select(F.col(parent).alias(node)).distinct()
    marked = join_keys(edges, parents.withColumn("_has_child", F.lit(True)), [node], "left")
    kind = (
        F.when(F.col(parent).isNull(), "Root").when(F.col("_has_child"), "Inner").otherwise("Leaf")
    )
    return marked.withColumn("node_type", kind).drop("_has_child")


def is_member(df: DataFrame, cond: Column) -> DataFrame:
    """One row saying whether any row matches; stops at the first match."""
    found = df.filter(cond).limit(1)
    return found.agg((F.count(F.lit(1)) > 0).alias("is_member"))


def members(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """The keys that occur in ``df``: the same test for many keys at once."""
    return keys.join(df.select(*on), list(on), "left_semi")
