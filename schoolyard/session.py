"""Session settings the plans rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

PARTITIONS_PER_CORE = 8

# Options that only count when a session starts.
STARTUP = {
    # recording the Python call site of every column expression slows plan building
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # the report alone compiles some 250 classes; the usual 100 are evicted in between
    "spark.sql.codegen.cache.maxEntries": "2000",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Set the runtime options results depend on; leave cluster sizing alone.

    Source timestamps carry no zone and are read as UTC.  Adaptive execution
    sizes shuffle partitions and broadcasts from what was actually shuffled, and
    splits the partitions of hot join keys, even where that costs a later shuffle.
    Shuffles start out with many small partitions, which are merged once their size
    is known; they can be merged but not multiplied, so the start must be high.
    Where the cluster sets a number of its own, that one is kept.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(initial, None) is None:
        usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
        spark.conf.set(initial, str(max(usual, wanted)))
    return spark


def local_session(app: str = "schoolyard", cores: str | None = None) -> SparkSession:
    """A single-JVM session for tests and the bench."""
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config(map=STARTUP)
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
