"""Where intermediate tables live, and how lineage is cut.

The shared folder is the one named by ``spark.checkpoint.dir``.  Where that
setting is absent a temporary folder is used, but only on a local master: the
executors of a cluster would each write to a disk of their own.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if root:
        return root.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors of {master} share")
    root = tempfile.mkdtemp(prefix="tablecraft-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path under the shared root; nothing is created yet."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and cuts the lineage."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint(eager=True)


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _path(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _path(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def modified_at(spark: SparkSession, path: str) -> float:
    """Seconds since 1970 of the last change of a file, or of what a folder directly holds."""
    fs, target = _path(spark, path)
    return fs.getFileStatus(target).getModificationTime() / 1000


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = _path(spark, path)
    fs.delete(target, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a table in the shared folder: computed once, read by all later steps."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
