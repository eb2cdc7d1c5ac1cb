"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.settle import settled


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each linked node reaches: columns node, root.

    ``links`` has two long columns, a and b; order, repeats and self-links do not matter. Rounds
    of large-star and small-star steps: every node first points its larger neighbours, then its
    smaller ones, to the smallest neighbour it knows. Each step is one grouping, so a node with
    very many links is a hot key of a minimum, which is taken before the shuffle. A round is written to
    the shared folder, so a lost executor costs its tasks only. Without links the result is empty.
    """
    edges = settled(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        large = settled(large)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        after = settled(small)
        before = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"))
        now = after.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s"))
        if before.first() == now.first():
            break
        edges = after
    roots = edges.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
