"""Registered queries: a name, a Spark callable and, where SQL can say it, the SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablecraft.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder, read lazily by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(name: str, sql: str | None = None, text: tuple[str, ...] = ()):
    """Register ``fn(tables) -> DataFrame`` under a name with its SQL twin.

    ``text`` names date columns that both sides give as ISO text, since client
    libraries disagree on what a date without a time is.
    """

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is already registered")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(Tables(tune(spark), sf_dir))
            return out.withColumns({c: F.col(c).cast("string") for c in text}) if text else out

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql:
            flat = " ".join(sql.split())
            if text:
                flat = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in text)}) FROM ({flat})"
            SQL[name] = flat
        return fn

    return register


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Round double columns half away from zero, so that the last bits cannot show.

    Scaled and rounded in doubles, as the SQL side does; Spark's own ``round``
    works on the decimal text and differs on values just beside a half.
    """
    scale = float(10**digits)

    def one(c: str):
        value = F.col(c).cast("double")
        return F.signum(value) * F.floor(F.abs(value) * scale + 0.5) / scale

    return df.withColumns({c: one(c) for c in cols})


def exact(df: DataFrame, *cols: str) -> DataFrame:
    """Money columns as decimals: sums and means do not depend on the order of rows."""
    return df.withColumns({c: F.col(c).cast("decimal(24,8)") for c in cols})


def mean_sql(col: str, over: str = "") -> str:
    """SQL for the mean of a money column from its sum in whole cents."""
    return f"(CAST(sum(CAST(round({col} * 100) AS BIGINT)) {over} AS DOUBLE) / (count({col}) {over} * 100))"
