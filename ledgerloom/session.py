"""Session settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Row-level joins may meet one key that holds a large part of all rows. Spark
# splits such a partition at run time; the force flag lets it do so even when
# the following aggregation then needs a shuffle of its own.
JOB_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Bytes that adaptive execution packs into one partition. Shuffled rows are compressed to some 25 bytes and
# take some 500 in sorts and hash tables, so the 64 MB that are usual fill more than 1 GB of a task.
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PARTITION_BYTES = "16m"


def small_partitions(spark: SparkSession) -> None:
    """Ask for partitions that a task sorts and hashes in little memory; a size that the caller has set stays."""
    if ADVISORY not in spark.conf.getAll:
        spark.conf.set(ADVISORY, PARTITION_BYTES)


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that is already running."""
    for name, value in JOB_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(
    cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "12g"
) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerloom")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
