"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where a later step on the same key then needs
    # one more shuffle: one extra shuffle is cheaper than one endless task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession, initial_partitions: int | None = None) -> SparkSession:
    """Set the runtime options the operators expect on an existing session.

    ``initial_partitions`` is the number of shuffle partitions AQE starts from and
    merges down: about the input size over 128 MB.  AQE does not split partitions
    outside skewed joins, so large inputs need it.
    """
    if initial_partitions:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions))
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "tablecraft", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
