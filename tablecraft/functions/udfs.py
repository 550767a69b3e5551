"""User-defined functions: scalar, table-valued, aggregate and named queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.plans.quantiles import percentiles


def register_add_two_numbers(spark: SparkSession, name: str = "add_two_numbers") -> None:
    """A SQL scalar function: inlined by the optimizer, no Python per row."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(a INT, b INT) RETURNS INT RETURN a + b")


def add_two_numbers(a, b):
    return F.call_function("add_two_numbers", a, b)


def register_table_function(
    spark: SparkSession, name: str, view: str, argument: str, columns: dict[str, str], filter_on: str
) -> None:
    """A SQL table function: the rows of a view where one column equals the argument."""
    returned = ", ".join(f"{c} {k}" for c, k in columns.items())
    chosen = ", ".join(columns)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(wanted {argument}) RETURNS TABLE({returned}) "
        f"RETURN SELECT {chosen} FROM {view} WHERE {filter_on} = wanted"
    )


def employees_in(spark: SparkSession, name: str, wanted) -> DataFrame:
    return spark.sql(f"SELECT * FROM {name}(:wanted)", args={"wanted": wanted})


def median(df: DataFrame, by: Sequence[str], col: str, out: str = "median", approx: bool = False) -> DataFrame:
    """Interpolated median per group; safe for a group of any size."""
    return percentiles(df, by, col, {out: 0.5}, approx=approx)


_NAMED: dict[str, Callable[..., DataFrame]] = {}


def define_query(name: str, build: Callable[..., DataFrame]) -> None:
    """Store a query under a name; it may itself run another stored query."""
    _NAMED[name] = build


def named_query(name: str, **params) -> DataFrame:
    if name not in _NAMED:
        raise KeyError(f"no stored query {name}")
    return _NAMED[name](**params)


def drop_query(name: str) -> None:
    _NAMED.pop(name, None)
