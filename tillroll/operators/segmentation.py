"""Recency, frequency and monetary scores, rule-based segments and clusters of customers."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.binning import first_match, quantile_bins
from tillroll.functions.numbers import count, money, real, share_of_total
from tillroll.model import SEED
from tillroll.operators import ranking
from tillroll.operators.quality import first_per_key
from tillroll.operators.settle import settled

ATTRIBUTES = (
    "Customer_Segment",
    "Customer_Age",
    "Gender",
    "State",
    "Income_Group",
    "Customer_Lifetime_Value",
    "Churned",
)
MEASURES = ("Recency", "Frequency", "Monetary")
QUINTILES = (0.2, 0.4, 0.6, 0.8)
CLUSTERS = 4
ELBOW = range(2, 9)
SEED_ROWS = 20_000  # points that starting centers are drawn from
POINTS_AT_A_TIME = 2_048  # compared with all centers together


def rfm_table(lines: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """One row per customer with orders.

    ``lines`` is the flat table, or anything with Customer_ID, Order_ID, Order_Date and Sales.
    The attributes come from ``customers`` if given, else from ``lines``. Lines are summed per
    order first, so a customer with very many lines is shuffled as one row per order at most.
    """
    per_order = lines.groupBy("Customer_ID", "Order_ID").agg(
        F.max("Order_Date").alias("_last"), F.sum("Sales").alias("_sales")
    )
    # kept, one row per customer, so that the latest date needs no second pass over the lines
    per_customer = settled(
        per_order.groupBy("Customer_ID").agg(
            F.max("_last").alias("_last"),
            F.count("Order_ID").alias("Frequency"),
            F.coalesce(F.sum("_sales"), F.lit(0)).alias("_sales"),
        )
    )
    last_day = per_customer.agg(F.max("_last")).scalar()
    rfm = per_customer.filter(F.col("Customer_ID").isNotNull()).select(
        "Customer_ID",
        F.datediff(last_day, "_last").alias("Recency"),
        "Frequency",
        money("_sales").alias("Monetary"),
    )
    if customers is None:
        # equal rows meet before the shuffle; of contradicting rows a customer keeps the first in order
        customers = first_per_key(lines.select("Customer_ID", *ATTRIBUTES), "Customer_ID")
    return rfm.join(customers.select("Customer_ID", *ATTRIBUTES), "Customer_ID", "left")


def segment_of(r: Column, f: Column, m: Column) -> Column:
    """The six segments; the first rule that holds decides. A missing score meets no condition on it."""
    # The rules and their names.
    rules = [
        ((r >= 4) & (f >= 4) & (m >= 4), "Champions"),
        ((r >= 3) & (f >= 3), "Loyal Customers"),
        ((r >= 4) & (f <= 2), "New Customers"),
        ((r <= 2) & (f >= 4), "At Risk"),
        ((r <= 2) & (f <= 2) & (m <= 2), "Lost"),
    ]
    return first_match(rules, "Needs Attention")


def score_rfm(rfm: DataFrame) -> DataFrame:
    """Adds quintile scores (5 is best), their text and sum, and the segment.

    Frequency has many ties, so its score follows the position by frequency and customer.
    """
    rfm = settled(rfm)
    cuts = ranking.quantiles(rfm, ["Recency", "Monetary"], QUINTILES)
    rows = rfm.count()
    positions = [1 + (rows - 1) * p for p in QUINTILES]
    if not rows:
        cuts = {c: [0.0] * len(QUINTILES) for c in cuts}
    numbered = ranking.row_number(
        rfm,
        [F.col("Frequency"), F.col("Customer_ID")],
        "_position",
    )
    r, f, m = F.col("R_Score"), F.col("F_Score"), F.col("M_Score")
    return (
        numbered.withColumns(
            {
                "R_Score": quantile_bins("Recency", cuts["Recency"], [5, 4, 3, 2, 1]),
                "F_Score": quantile_bins("_position", positions, [1, 2, 3, 4, 5]),
                "M_Score": quantile_bins("Monetary", cuts["Monetary"], [1, 2, 3, 4, 5]),
            }
        )
        .drop("_position")
        .withColumns(
            {
                "RFM_Score": F.concat(*[s.cast("string") for s in (r, f, m)]),
                "RFM_Total": r + f + m,
                "RFM_Segment": segment_of(r, f, m),
            }
        )
    )


def segment_distribution(scored: DataFrame) -> DataFrame:
    return (
        scored.groupBy("RFM_Segment")
        .agg(count().alias("Customers"))
        .withColumn("Share_Pct", share_of_total("Customers"))
        .orderBy(F.desc("Customers"), "RFM_Segment")
    )


def standardised(df: DataFrame, columns: Iterable[str] = MEASURES, suffix: str = "_Z") -> DataFrame:
    """Adds (value - mean) / population deviation; a constant column becomes 0."""
    columns = list(columns)
    stats = df.agg(
        *[F.avg(real(c)).alias(f"m_{c}") for c in columns],
        *[F.stddev_pop(real(c)).alias(f"s_{c}") for c in columns],
    ).first()
    return df.withColumns(
        {
            f"{c}{suffix}": (real(c) - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"] or 1.0)
            for c in columns
        }
    )


def _points(df: DataFrame) -> DataFrame:
    return standardised(df).withColumn("_point", F.array(*[F.col(f"{c}_Z") for c in MEASURES]))


def _spread(points: DataFrame) -> DataFrame:
    """The points, stored so that all cores share them: every pass reads them again."""
    return settled(points.repartition(points.sparkSession.sparkContext.defaultParallelism))


def seeded_centers(sample: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    """k starting centers among the sample's points, each drawn by its squared distance to those before."""
    chosen = [sample[draw.integers(len(sample))]]
    apart = ((sample - chosen[0]) ** 2).sum(axis=1)
    for _ in range(1, k):
        total = apart.sum()
        # some points as far as needed, then any
        at = draw.choice(len(sample), p=apart / total) if total > 0 else draw.integers(len(sample))
        chosen.append(sample[at])
        apart = np.minimum(apart, ((sample - sample[at]) ** 2).sum(axis=1))
    return np.array(chosen)


def refined(sample: np.ndarray, centers: np.ndarray, rounds: int, tolerance: float) -> np.ndarray:
    """Centers after rounds over the sample alone, so that few passes over all points are left."""
    for _ in range(rounds):
        nearest = ((centers**2).sum(axis=1) - 2 * (sample @ centers.T)).argmin(axis=1)
        n = np.bincount(nearest, minlength=len(centers))[:, None]
        sums = np.stack([np.bincount(nearest, column, len(centers)) for column in sample.T], axis=1)
        now = np.where(n > 0, sums / np.maximum(n, 1), centers)
        if (((now - centers) ** 2).sum(axis=1) <= tolerance**2).all():
            return now
        centers = now
    return centers


def _cluster_sums(batches, fits: dict[int, np.ndarray]):
    """Points, sums and cost by fit and cluster, of one task."""
    stacked = np.concatenate(list(fits.values()))
    lengths = (stacked**2).sum(axis=1)
    ends = np.cumsum([len(c) for c in fits.values()]).tolist()
    width = stacked.shape[1]
    sums = {fit: np.zeros((len(centers), width + 2)) for fit, centers in fits.items()}
    for batch in batches:
        points = np.asarray(batch.column(0).flatten(), np.float64).reshape(len(batch), width)
        for low in range(0, len(points), POINTS_AT_A_TIME):
            x = points[low : low + POINTS_AT_A_TIME]
            apart = lengths - 2 * (x @ stacked.T)  # but for the point's own length, the same for all centers
            own = (x**2).sum(axis=1)
            for (fit, found), end in zip(sums.items(), ends):
                mine = apart[:, end - len(found) : end]
                nearest = mine.argmin(axis=1)
                columns = [None, np.maximum(mine[np.arange(len(x)), nearest] + own, 0), *x.T]
                for j, weights in enumerate(columns):
                    found[:, j] += np.bincount(nearest, weights, len(found))
    for fit, found in sums.items():
        columns = [np.full(len(found), fit), np.arange(len(found)), *found.T]
        kinds = [pa.int32(), pa.int32(), *[pa.float64()] * found.shape[1]]
        names = ["fit", "cluster", *[f"s{i}" for i in range(found.shape[1])]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)


def _pass(points: DataFrame, fits: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """One pass over the points for all fits: a few numbers per fit and cluster come back."""
    width = next(iter(fits.values())).shape[1] + 2
    names = [f"s{i}" for i in range(width)]
    layout = "fit int, cluster int, " + ", ".join(f"{n} double" for n in names)
    found = points.mapInArrow(lambda b: _cluster_sums(b, fits), layout).groupBy("fit", "cluster").agg(*[F.sum(n) for n in names])
    out = {fit: np.zeros((len(centers), width)) for fit, centers in fits.items()}
    for row in found.collect():
        out[row[0]][row[1]] = row[2:]
    return out


def best_centers(
    points: DataFrame, ks: Iterable[int], starts: int = 10, seed: int = SEED, rounds: int = 300, tolerance: float = 1e-4,
    sample_rows: int = SEED_ROWS,
) -> dict[int, tuple[float, np.ndarray]]:
    """For each number of clusters the cost and the centers of the best of ``starts`` fits.

    All fits move in the same passes over the points; one that has settled (no center moved by more than
    ``tolerance``) takes no part in later ones. Every fit starts from its own draw over one sample of at most
    ``sample_rows`` points, settled on that sample first. A center without points stays. ``points`` has an array column _point.
    """
    points = points.select("_point")
    sample = points.orderBy(F.xxhash64("_point", F.lit(seed)), "_point").limit(sample_rows).collect()
    if not sample:
        raise ValueError("no points to cluster")
    sample = np.array([row[0] for row in sample])
    names = [(k, start) for k in ks for start in range(starts)]
    centers = {}
    for i, (k, start) in enumerate(names):
        first = seeded_centers(sample, k, np.random.default_rng([seed, k, start]))
        centers[i] = refined(sample, first, rounds, tolerance)
    moving = dict(centers)
    for _ in range(rounds):
        if not moving:
            break
        for fit, sums in _pass(points, moving).items():
            some = sums[:, :1] > 0
            now = np.where(some, sums[:, 2:] / np.maximum(sums[:, :1], 1), centers[fit])
            settled_down = (((now - centers[fit]) ** 2).sum(axis=1) <= tolerance**2).all()
            centers[fit] = moving[fit] = now
            if settled_down:
                del moving[fit]
    costs = {fit: float(sums[:, 1].sum()) for fit, sums in _pass(points, centers).items()}
    best = {}
    for fit, (k, _) in enumerate(names):
        if k not in best or costs[fit] < best[k][0]:
            best[k] = costs[fit], centers[fit]
    return best


def elbow(
    rfm: DataFrame, ks: Iterable[int] = ELBOW, starts: int = 10, seed: int = SEED
) -> DataFrame:
    """Cost of the best clustering per number of clusters."""
    found = best_centers(_spread(_points(rfm).select("_point")), ks, starts, seed)
    costs = [(k, cost) for k, (cost, _) in found.items()]
    return rfm.sparkSession.createDataFrame(costs, "Clusters int, Inertia double")


def clustered(
    rfm: DataFrame, k: int = CLUSTERS, starts: int = 10, seed: int = SEED
) -> DataFrame:
    """Adds ``Cluster``; the numbers rise with the cluster's mean Monetary."""
    points = _spread(_points(rfm))
    centers = best_centers(points, [k], starts, seed)[k][1].tolist()
    centers.sort(key=lambda c: c[MEASURES.index("Monetary")])
    apart = [
        F.struct(
            sum(((F.get("_point", F.lit(j)) - c) ** 2 for j, c in enumerate(center)), F.lit(0.0)).alias("apart"),
            F.lit(number).alias("number"),
        )
        for number, center in enumerate(centers)
    ]
    nearest = F.array_min(F.array(*apart))["number"]
    return points.withColumn("Cluster", nearest.cast("int")).select(*rfm.columns, "Cluster")


def cluster_profile(clusters: DataFrame) -> DataFrame:
    """Size and mean measures per cluster, to one digit."""
    return (
        clusters.groupBy("Cluster")
        .agg(count().alias("Customers"), *[F.round(F.avg(real(c)), 1).alias(c) for c in MEASURES])
        .orderBy("Cluster")
    )
