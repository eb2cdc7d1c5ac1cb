"""Running totals, row numbers, ranks, buckets and quantiles that survive a hot group.

A plain Spark window sorts each group in one task. Here the rows are range-partitioned on the whole
sort key instead, which cuts a hot group over many tasks, and the totals of the earlier slices are
carried into the later ones. There is one way for every size.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillroll.operators.settle import settled


def running_totals(
    df: DataFrame,
    order_by: Sequence[Column],
    totals: Mapping[str, Column],
    within: Sequence[str] = (),
) -> DataFrame:
    """Adds, per entry of ``totals``, the sum of its column up to and with each row.

    ``order_by`` must be unique within a group, else slices could become uneven.
    """
    keys, outs = list(within), list(totals)
    weights = {f"_w_{out}": weight for out, weight in totals.items()}
    sliced = settled(
        df.withColumns(weights)
        .repartitionByRange(*[F.col(k) for k in keys], *order_by)
        .withColumn("_slice", F.spark_partition_id())
    )
    earlier = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    # A group goes on into a slice only as that slice's first group, so this table holds at
    # most one row per slice: its size is bounded by the number of partitions.
    carried = (
        sliced.groupBy(*keys, "_slice")
        .agg(*[F.sum(f"_w_{out}").alias(f"_w_{out}") for out in outs])
        .select(
            *[F.col(k).alias(f"_c_{k}") for k in keys],
            F.col("_slice").alias("_c_slice"),
            F.count(F.lit(1)).over(earlier).alias("_before"),
            *[F.sum(f"_w_{out}").over(earlier).alias(f"_carry_{out}") for out in outs],
        )
        .filter("_before > 0")
    )
    same = F.col("_slice") == F.col("_c_slice")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    so_far = (
        W.partitionBy("_slice", *keys)
        .orderBy(*order_by)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return (
        sliced.withColumns({out: F.sum(f"_w_{out}").over(so_far) for out in outs})
        .join(F.broadcast(carried), same, "left")
        .withColumns({out: F.col(out) + F.coalesce(f"_carry_{out}", F.lit(0)) for out in outs})
        .select(*df.columns, *outs)
    )


def row_number(
    df: DataFrame,
    order_by: Sequence[Column],
    out: str,
    within: Sequence[str] = (),
) -> DataFrame:
    """1-based position by ``order_by`` (unique), per group if ``within`` names columns."""
    return running_totals(df, order_by, {out: F.lit(1).cast("bigint")}, within)


def ntile(
    df: DataFrame,
    buckets: int,
    order_by: Sequence[Column],
    out: str,
) -> DataFrame:
    """``buckets`` groups of equal size; the first ones hold one row more if needed."""
    rows = df.count()
    size, longer = divmod(rows, buckets)
    edge = longer * (size + 1)
    position = F.col(out) - 1
    return running_totals(df, order_by, {out: F.lit(1).cast("bigint")}).withColumn(
        out,
        F.when(position < edge, F.floor(position / (size + 1)) + 1)
        .otherwise(longer + F.floor((position - edge) / max(size, 1)) + 1)
        .cast("int"),
    )


def rank(
    df: DataFrame,
    value: str,
    out: str,
    within: Sequence[str] = (),
    dense: bool = False,
) -> DataFrame:
    """Rank by ``value`` descending; equal values share a rank, with or without gaps after."""
    keys = [*within, value]
    levels = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    weight = F.lit(1).cast("bigint") if dense else F.col("_rows")
    ranked = running_totals(levels, [F.col(value).desc()], {"_upto": weight}, within)
    position = F.col("_upto") if dense else F.col("_upto") - F.col("_rows") + 1
    ranks = ranked.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], position.cast("bigint").alias(out)
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return df.join(ranks, same).select(*df.columns, out)


def value_histogram(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per column and distinct value, in one pass; equal values meet before the shuffle."""
    pairs = [F.struct(F.lit(i).alias("_i"), F.col(c).alias("value")) for i, c in enumerate(columns)]
    names = F.array(*[F.lit(c) for c in columns])
    return settled(
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .select(F.inline(F.array(*pairs)))
        .filter("value is not null")
        .groupBy("_i", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.get(names, F.col("_i")).alias("name"), "value", "rows")
    )


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation, for all columns in one pass over ``df``."""
    counted = value_histogram(df, columns)
    return histogram_quantiles(counted, columns, probabilities)


def histogram_quantiles(
    counted: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
) -> dict[str, list[float | None]]:
    """Quantiles from a value histogram; only the requested points come to the driver."""
    sizes = {
        r["name"]: (r["levels"], r["total"])
        for r in counted.groupBy("name")
        .agg(F.count(F.lit(1)).alias("levels"), F.sum("rows").alias("total"))
        .collect()
    }
    ordered = running_totals(counted, [F.col("value")], {"upto": F.col("rows")}, ["name"])
    wanted = {}
    for name, (_, total) in sizes.items():
        for i, p in enumerate(probabilities):
            low = math.floor((total - 1) * p)
            wanted[name, i] = (low, min(low + 1, total - 1), (total - 1) * p - low)
    if not wanted:
        return {c: [None] * len(probabilities) for c in columns}
    points = {(name, k) for (name, _), (low, high, _) in wanted.items() for k in (low, high)}
    points = sorted(points)
    found = ordered.agg(
        *[
            F.min(F.when((F.col("name") == name) & (F.col("upto") > k), F.col("value")))
            for name, k in points
        ]
    ).first()
    at = dict(zip(points, found))

    def interpolate(name, i):
        low, high, part = wanted[name, i]
        return at[name, low] + (at[name, high] - at[name, low]) * part

    return {
        c: [interpolate(c, i) if c in sizes else None for i in range(len(probabilities))]
        for c in columns
    }
