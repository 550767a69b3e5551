"""Reading and writing tables: scans, delimited and JSON files, partition layouts."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.plans.storage import child_names, path_exists, remove_path, shared_dir

__all__ = [
    "scan", "load_csv", "literal_rows", "write_json_records", "read_json_records", "append", "ctas",
    "empty_like", "with_added_column", "without_column", "drop_table", "write_partitioned",
    "scan_partitions", "write_list_partitioned", "scan_list_partitioned", "move_rows", "write_hash_partitioned",
    "partitioned_table", "detach_partition", "attach_partition", "adopt_table", "generate_rows", "folder_values",
]

MAX_RECORDS_PER_FILE = 10_000_000


def scan(spark: SparkSession, path: str, cols: Sequence[str] | None = None) -> DataFrame:
    """A base table, whole or with a column list that reaches the file reader."""
    df = spark.read.parquet(path)
    return df.select(*cols) if cols else df


def load_csv(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", quote: str = '"',
    line_sep: str = "\n", bad_rows: str | None = None,
) -> DataFrame:
    """A delimited file under a declared schema; bad lines go to ``bad_rows`` if named."""
    if bad_rows:
        schema = T.StructType([*schema.fields, T.StructField(bad_rows, T.StringType())])
    reader = spark.read.schema(schema).option("sep", sep).option("quote", quote).option("lineSep", line_sep)
    reader = reader.option("mode", "PERMISSIVE")
    if bad_rows:
        reader = reader.option("columnNameOfCorruptRecord", bad_rows)
    return reader.csv(path)


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    """A small relation written out in the program."""
    return spark.createDataFrame(list(rows), schema)


def write_json_records(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def read_json_records(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def append(df: DataFrame, path: str) -> None:
    """One bulk insert of all rows."""
    df.write.mode("append").parquet(path)


def ctas(df: DataFrame, path: str) -> DataFrame:
    """Create a table from a query; fails if the table is already there."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def empty_like(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], df.schema)


def with_added_column(df: DataFrame, name: str, kind: str, value: Column | None = None) -> DataFrame:
    value = F.lit(None) if value is None else value
    return df.withColumn(name, value.cast(kind))


def without_column(df: DataFrame, name: str) -> DataFrame:
    return df.drop(name)


def drop_table(spark: SparkSession, path: str) -> None:
    if path_exists(spark, path):
        remove_path(spark, path)


def _by_partition(df: DataFrame, *by: str):
    # Rebalance: AQE splits a partition value that holds much of the table over
    # several writers and packs the small ones together.
    return df.hint("rebalance", *by).write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> None:
    """Folders per value of ``by``, for example one per date."""
    _by_partition(df, *by).mode(mode).partitionBy(*by).parquet(path)


def scan_partitions(spark: SparkSession, path: str, by: str, low, high) -> DataFrame:
    """Only the folders from ``low`` to ``high`` inclusive are listed and read."""
    return spark.read.parquet(path).filter(F.col(by).between(F.lit(low), F.lit(high)))


def write_list_partitioned(df: DataFrame, path: str, flag: str, mode: str = "overwrite") -> None:
    """One folder per flag value; NULL has its own folder."""
    _by_partition(df, flag).mode(mode).partitionBy(flag).parquet(path)


def scan_list_partitioned(spark: SparkSession, path: str, flag: str, kind: str = "boolean") -> DataFrame:
    """The table with its flag typed; a folder name alone would read as text."""
    return spark.read.parquet(path).withColumn(flag, F.col(flag).cast(kind))


def move_rows(
    spark: SparkSession, path: str, flag: str, cond: Column, value, kind: str = "boolean"
) -> None:
    """Change the flag of matching rows, rewriting only the folders they touch."""
    table = scan_list_partitioned(spark, path, flag, kind)
    target = F.lit(value).cast(kind)
    moving = cond & ~F.col(flag).eqNullSafe(target)
    # one row per flag value
    touched = [r[0] for r in table.filter(moving).select(flag).distinct().collect()]
    if not touched:
        return
    hit = F.col(flag).eqNullSafe(target)
    for old in touched:
        hit = hit | F.col(flag).eqNullSafe(F.lit(old).cast(kind))
    staged = shared_dir(spark, "moved")
    table.filter(hit).withColumn(flag, F.when(cond, target).otherwise(F.col(flag))).write.parquet(staged)
    fresh = spark.read.schema(table.schema).parquet(staged)
    _by_partition(fresh, flag).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        flag
    ).parquet(path)
    emptied = set(touched) - {r[0] for r in fresh.select(flag).distinct().collect()}
    for folder, held in folder_values(spark, path, flag, table.schema[flag].dataType).collect():
        if held in emptied:
            remove_path(spark, f"{path}/{folder}")


def folder_values(spark: SparkSession, path: str, by: str, kind) -> DataFrame:
    """``(folder, value)`` of each partition folder, the value typed and NULL for the NULL folder."""
    found = []
    for folder in child_names(spark, path):
        name, _, text = folder.partition("=")
        if name == by:
            found.append((folder, None if text == "__HIVE_DEFAULT_PARTITION__" else unquote(text)))
    return spark.createDataFrame(found, "folder string, value string").withColumn("value", F.col("value").cast(kind))


def write_hash_partitioned(df: DataFrame, path: str, key: str, n: int = 3, bucket: str = "bucket") -> None:
    """``n`` folders by a hash of the key."""
    placed = df.withColumn(bucket, F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
    _by_partition(placed, bucket).mode("overwrite").partitionBy(bucket).parquet(path)


#: Rows of a bucket, and the buckets that Spark allows a table.
BUCKET_ROWS, MAX_BUCKETS = 500_000, 100_000


def buckets_for(*tables: DataFrame, rows: int | None = None) -> int:
    """Buckets for tables that meet by their key, by the rows of the longest: a task's share stays the same as they grow."""
    longest = max(table.count() for table in tables)
    return min(MAX_BUCKETS, max(1, math.ceil(longest / (rows or BUCKET_ROWS))))


def write_bucketed(df: DataFrame, name: str, path: str, key: str, n: int) -> DataFrame:
    """A table of ``n`` buckets by a hash of the key, each one file sorted by it.

    Tables with the same key and number of buckets are joined, and any of them is
    aggregated by the key, without a shuffle.  Choose ``n`` by :func:`buckets_for`, the
    same for all of them; a key with a large share of the rows fills one bucket, so such tables
    belong in :func:`write_hash_partitioned` folders or are salted first.
    """
    spread = df.repartition(n, key).write.bucketBy(n, key).sortBy(key).format("parquet")
    spread.option("path", path).mode("errorifexists").saveAsTable(name)
    return df.sparkSession.table(name)


def partitioned_table(spark: SparkSession, name: str, path: str, schema: str, by: str) -> None:
    """Register a folder layout as an external table with its partitions."""
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet PARTITIONED BY ({by}) LOCATION '{path}'")
    for folder in child_names(spark, path):
        if folder.startswith(f"{by}="):
            attach_partition(spark, name, by, folder.split("=", 1)[1], f"{path}/{folder}")


def detach_partition(spark: SparkSession, name: str, by: str, value: str) -> None:
    """Take a partition out of the table; its files stay where they are."""
    spark.sql(f"ALTER TABLE {name} DROP PARTITION ({by} = '{value}')")


def attach_partition(spark: SparkSession, name: str, by: str, value: str, path: str) -> None:
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION ({by} = '{value}') LOCATION '{path}'")


def adopt_table(spark: SparkSession, name: str, by: str, path: str, low: str = "0001-01-01") -> None:
    """Make an existing unpartitioned folder the oldest, open-ended partition."""
    attach_partition(spark, name, by, low, path)


def generate_rows(spark: SparkSession, n: int) -> DataFrame:
    """``n`` rows with id, name and address, made on the executors."""
    ids = spark.range(1, n + 1)
    return ids.select(
        "id",
        F.concat(F.lit("Name "), F.col("id")).alias("name"),
        F.concat(F.lit("Address "), F.col("id")).alias("address"),
    )
