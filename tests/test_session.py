"""What `tuned` sets, and that joins follow it."""

from pyspark.sql import functions as F

from tillroll.session import SCAN_BYTES, tuned


def joined(spark):
    left = spark.range(4_000).select((F.col("id") % 900).alias("key"), "id")
    right = spark.range(1_000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("twice"))
    df = left.join(right, "key", "left").groupBy().agg(F.count("twice").alias("n"), F.sum("twice").alias("total"))
    rows = [tuple(r) for r in df.collect()]
    return rows, df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_small_partitions_are_hashed_and_large_ones_sorted(spark):
    session = tuned(spark.newSession())
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        session.conf.set(key, "-1")
    rows, plan = joined(session)
    assert rows == [(4_000, sum(2 * (i % 900) for i in range(4_000)))]
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    assert "ShuffledHashJoin" not in joined(tuned(session, hashed=False))[1]
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100b")
    again, plan = joined(tuned(session))
    assert again == rows
    assert "SortMergeJoin" in plan and "ShuffledHashJoin" not in plan


def test_a_task_reads_little_unless_the_cluster_says_otherwise(spark):
    key = "spark.sql.files.maxPartitionBytes"
    assert tuned(spark.newSession()).conf.get(key).upper() == SCAN_BYTES
    own = spark.newSession()
    own.conf.set(key, "64MB")
    assert tuned(own).conf.get(key) == "64MB"
