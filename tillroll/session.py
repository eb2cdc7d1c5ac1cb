"""Session settings used by the registered queries, the pipeline, the bench and the tests."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution merges small partitions and splits hot join keys. The last setting lets it
# split one also where that costs another shuffle, as before a grouping on the same key.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}
SETTINGS = {**ADAPTIVE, "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false"}


SCAN_BYTES = "32MB"  # of a file that one task reads, where the cluster says nothing else


def tuned(spark: SparkSession, hashed: bool = True) -> SparkSession:
    """The session with hot join keys split, small partitions hashed instead of both sides sorted, and smaller reads.

    A side is hashed only if each of its partitions is known to hold no more than the advisory size, so neither
    that nor what a reading task sums by key before the shuffle grows with the data. Rows joined without a sort
    compress less in later shuffles; without ``hashed`` both sides are sorted. All else stays as the cluster set it.
    """
    for key in ("spark.sql.adaptive.skewJoin.enabled", "spark.sql.adaptive.forceOptimizeSkewedJoin"):
        spark.conf.set(key, ADAPTIVE[key])
    most = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", most if hashed else "0")
    if spark.conf.get("spark.sql.files.maxPartitionBytes", None) is None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", SCAN_BYTES)
    return spark


def local_session(
    name: str = "tillroll", cores: str = "8", shuffle_partitions: int = 8, memory: str = "12g"
) -> SparkSession:
    """A local session; on a cluster pass SETTINGS to spark-submit instead."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
