"""Samples and splits that depend on the key and the seed only, not on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.model import SEED
from tillroll.operators import ranking


def shuffle_key(key: str, seed: int = SEED) -> Column:
    """A repeatable pseudo-random text per key."""
    return F.md5(F.concat_ws("#", F.col(key).cast("string"), F.lit(seed)))


def fixed_size_sample(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """Exactly min(n, rows) rows; each task keeps only its best n before they meet."""
    return (
        df.withColumn("_pick", shuffle_key(key, seed))
        .orderBy("_pick", key)
        .limit(n)
        .drop("_pick")
    )


def plain_split(df: DataFrame, key: str, test_share: float = 0.2, seed: int = SEED) -> DataFrame:
    """Adds ``is_test``: true for about ``test_share`` of the keys. Needs no shuffle."""
    part = F.conv(F.substring(shuffle_key(key, seed), 1, 8), 16, 10).cast("bigint")
    return df.withColumn("is_test", part < F.lit(int(test_share * 2**32)))


def stratified_split(
    df: DataFrame,
    key: str,
    label: str,
    test_share: float = 0.2,
    seed: int = SEED,
) -> DataFrame:
    """Adds ``is_test``: true for the same share, rounded, of each label's rows."""
    sizes = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    picked = ranking.row_number(
        df.withColumn("_pick", shuffle_key(key, seed)),
        [F.col("_pick"), F.col(key)],
        "_position",
        within=[label],
    )
    chain = F.lit(False)
    for value, rows in sizes.items():
        limit = F.lit(round(rows * test_share))
        chain = F.when(F.col(label).eqNullSafe(F.lit(value)), F.col("_position") <= limit).otherwise(
            chain
        )
    return picked.withColumn("is_test", chain).drop("_pick", "_position")
