"""The data behind each exploratory chart, from the cleaned flat table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillroll.functions.binning import equal_width_bin, first_match
from tillroll.functions.dates import month_name
from tillroll.functions.numbers import (
    count,
    money,
    ratio,
    real,
    rounded,
    rounded_ratio,
    share_of_total,
)
from tillroll.model import SEED
from tillroll.operators import ranking
from tillroll.operators.sampling import fixed_size_sample
from tillroll.operators.settle import settled

SUMMARISED = (
    "Quantity",
    "Unit_Price",
    "Discount",
    "Sales",
    "Profit",
    "Shipping_Cost",
    "Customer_Age",
)
CATEGORICAL = ("Category", "Order_Status", "Payment_Method", "Customer_Segment")
CORRELATED = (
    "Quantity",
    "Unit_Price",
    "Discount",
    "Sales",
    "Shipping_Cost",
    "Profit",
    "Customer_Age",
    "Customer_Lifetime_Value",
    "Total_Orders",
    "Recency_Days",
)


def numeric_summary(df: DataFrame, columns: Sequence[str] = SUMMARISED) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles, to two digits.

    One pass over the lines counts the values; everything else comes from those counts.
    """
    counted = ranking.value_histogram(df, columns)
    quartiles = ranking.histogram_quantiles(counted, columns, [0.25, 0.5, 0.75])
    value, rows = F.col("value"), F.col("rows")
    exact = value.cast("decimal(18,4)") * rows
    basics = counted.groupBy("name").agg(
        F.sum("rows").alias("n"),
        F.sum(exact).alias("total"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    )
    means = {r["name"]: float(r["total"]) / r["n"] for r in basics.collect()}
    mean = first_match([(F.col("name") == c, F.lit(m)) for c, m in means.items()] or [
        (F.lit(False), F.lit(0.0))
    ])
    spread = counted.groupBy("name").agg(F.sum(rows * F.pow(value - mean, 2)).alias("spread"))
    quartile_of = {
        label: first_match(
            [(F.col("name") == c, F.lit(q[i]).cast("double")) for c, q in quartiles.items()]
        )
        for i, label in enumerate(("p25", "p50", "p75"))
    }
    return (
        basics.join(spread, "name")
        .select(
            F.col("name").alias("column_name"),
            F.col("n").alias("count"),
            rounded_ratio("total", "n").alias("mean"),
            rounded(F.sqrt(F.try_divide("spread", F.col("n") - 1))).alias("std"),
            rounded("low").alias("min"),
            *[rounded(q).alias(label) for label, q in quartile_of.items()],
            rounded("high").alias("max"),
        )
    )


def value_counts(df: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """Frequencies of all columns in one pass; missing values are left out."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in columns
    ]
    return (
        df.select(F.inline(F.array(*pairs)))
        .filter("value is not null")
        .groupBy("column_name", "value")
        .agg(count().alias("row_count"))
        .orderBy("column_name", F.desc("row_count"), "value")
    )


def correlation_matrix(
    df: DataFrame, columns: Sequence[str] = CORRELATED, digits: int = 6
) -> DataFrame:
    """Pearson correlation of every pair of columns, in one pass.

    Each pair uses the rows where both are present. Customer columns weigh by their lines.
    """
    names = list(columns)
    pairs = [
        F.struct(
            F.lit(i).alias("_i"),
            F.lit(j).alias("_j"),
            F.col(a).alias("_x"),
            F.col(b).alias("_y"),
        )
        for i, a in enumerate(names)
        for j, b in enumerate(names)
        if i <= j
    ]
    # a row per pair of columns is aggregated within its task: far less generated code, and
    # faster, than one aggregate with six buffers for each of the pairs
    correlated = (
        df.select(*[real(c).alias(c) for c in names])
        .select(F.inline(F.array(*pairs)))
        .groupBy("_i", "_j")
        .agg(F.round(F.corr("_x", "_y"), digits).alias("correlation"))
    )
    both_ways = F.array_distinct(
        F.array(
            F.struct(F.col("_i").alias("a"), F.col("_j").alias("b")),
            F.struct(F.col("_j").alias("a"), F.col("_i").alias("b")),
        )
    )
    name = F.array(*[F.lit(n) for n in names])
    return (
        correlated.select(F.inline(both_ways), "correlation")
        .select(
            F.get(name, F.col("a")).alias("column_a"),
            F.get(name, F.col("b")).alias("column_b"),
            "correlation",
        )
        .orderBy("column_a", "column_b")
    )


def monthly_trend(df: DataFrame, columns: Sequence[str] = ("Sales", "Profit")) -> DataFrame:
    """Sums per calendar month; months without any line appear with 0.

    Each month also emits the empty months up to the next one, so no calendar table is needed.
    """
    sums = (
        df.filter(F.col("Order_Date").isNotNull())
        .groupBy(F.trunc("Order_Date", "month").alias("_month"))
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])
    )
    following = F.lead("_month").over(W.partitionBy().orderBy("_month"))
    until = F.coalesce(F.add_months(following, -1), F.col("_month"))
    months = F.sequence("_month", until, F.expr("interval 1 month"))
    return (
        sums.withColumn("_months", months)
        .select("*", F.posexplode("_months").alias("_gap", "_day"))
        .select(
            F.last_day("_day").alias("Month_End"),
            *[money(F.when(F.col("_gap") == 0, F.col(c)).otherwise(0)).alias(c) for c in columns],
        )
        .orderBy("Month_End")
    )


def _sum_by(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(money(F.coalesce(F.sum(value), F.lit(0))).alias(out))
        .orderBy(F.desc(out), key)
    )


def top_products(df: DataFrame, n: int = 10) -> DataFrame:
    return _sum_by(df, "Product_ID", "Sales", "Total_Sales").limit(n)


def profit_by_category(df: DataFrame) -> DataFrame:
    return _sum_by(df, "Category", "Profit", "Total_Profit")


def sales_by_state(df: DataFrame) -> DataFrame:
    return _sum_by(df, "State", "Sales", "Total_Sales")


def customer_ages(df: DataFrame) -> DataFrame:
    """Customers per age; one row per customer first, then per year of age."""
    per_customer = df.groupBy("Customer_ID").agg(F.max("Customer_Age").alias("Age"))
    return per_customer.filter("Age is not null").groupBy("Age").agg(count().alias("Customers"))


def age_histogram(df: DataFrame, bins: int = 25) -> DataFrame:
    """Customers per age interval, all intervals of one width, empty ones too."""
    everything = W.partitionBy()
    low, high = F.min("Age").over(everything), F.max("Age").over(everything)
    binned = (
        customer_ages(df)
        .select("*", low.alias("_low"), high.alias("_high"))
        .withColumn("_bin", equal_width_bin("Age", "_low", "_high", bins))
    )
    per_bin = [F.sum(F.when(F.col("_bin") == i + 1, F.col("Customers"))) for i in range(bins)]
    row = binned.agg(
        F.min("_low").alias("_low"), F.max("_high").alias("_high"), F.array(*per_bin).alias("_n")
    ).filter("_low is not null")
    width = (F.col("_high") - F.col("_low")) / F.lit(float(bins))
    return row.select("*", F.posexplode("_n").alias("_i", "_rows")).select(
        (F.col("_i") + 1).alias("Bin"),
        F.round(F.col("_low") + F.col("_i") * width, 6).alias("From_Age"),
        F.round(F.col("_low") + (F.col("_i") + 1) * width, 6).alias("To_Age"),
        F.coalesce("_rows", F.lit(0)).cast("bigint").alias("Customers"),
    )


def age_density(df: DataFrame, points: int = 200, digits: int = 9) -> DataFrame:
    """Gaussian kernel density of the ages between the lowest and the highest.

    The bandwidth is the sample deviation times n^(-1/5). Each age, of which there are few,
    spreads its weight over the fixed grid; customers are never paired with the grid.
    """
    everything = W.partitionBy()
    age, rows = real("Age"), real("Customers")
    n = F.sum(rows).over(everything)
    mean = F.sum(rows * age).over(everything) / n
    stats = customer_ages(df).select(
        age.alias("_age"), rows.alias("_w"), n.alias("_n"), mean.alias("_mean"),
        F.min(age).over(everything).alias("_low"), F.max(age).over(everything).alias("_high"),
    )
    spread = F.sum(F.col("_w") * F.pow(F.col("_age") - F.col("_mean"), 2)).over(everything)
    width = F.sqrt(F.try_divide(spread, F.col("_n") - 1)) * F.pow("_n", F.lit(-0.2))
    step = (F.col("_high") - F.col("_low")) / F.lit(float(points - 1))
    z = (F.col("_low") + F.col("Point") * F.col("_step") - F.col("_age")) / F.col("_width")
    weight = F.col("_w") * F.exp(-z * z / 2) / (F.col("_n") * F.col("_width"))
    return (
        stats.select("*", width.alias("_width"), step.alias("_step"))
        .filter("_width > 0")
        .withColumn("Point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
        .groupBy("Point")
        .agg(
            F.round(F.max(F.col("_low") + F.col("Point") * F.col("_step")), 6).alias("Age"),
            F.round(F.sum(weight) / F.sqrt(2 * F.pi()), digits).alias("Density"),
        )
        .orderBy("Point")
    )


def discount_profit_sample(df: DataFrame, n: int = 4000, seed: int = SEED) -> DataFrame:
    columns = df.select("Order_Item_ID", "Discount", "Profit", "Category")
    return fixed_size_sample(columns, "Order_Item_ID", n, seed)


def order_status_breakdown(df: DataFrame) -> DataFrame:
    """Orders per status and their share; each order counts once."""
    per_order = df.select("Order_ID", "Order_Status").distinct()
    return (
        per_order.filter("Order_Status is not null")
        .groupBy("Order_Status")
        .agg(count().alias("Order_Count"))
        .withColumn("Share_Pct", share_of_total("Order_Count"))
        .orderBy(F.desc("Order_Count"), "Order_Status")
    )


def insight_summary(df: DataFrame) -> DataFrame:
    """Seven headline facts as (position, metric, value).

    One pass groups the lines by category, state and month, with the sums that a correlation needs;
    the facts come from those groups.
    """
    x, y = real("Discount"), real("Profit")
    both = x.isNotNull() & y.isNotNull()
    moments = {"_x": x, "_y": y, "_xx": x * x, "_yy": y * y, "_xy": x * y}
    grouped = settled(
        df.groupBy("Category", "State", F.last_day("Order_Date").alias("Month_End")).agg(
            F.sum("Sales").alias("Sales"),
            F.sum("Profit").alias("Profit"),
            F.count_if(F.col("Return_Flag") == "Yes").alias("Returned"),
            F.count(F.lit(1)).alias("Lines"),
            F.count_if(both).alias("_n"),
            *[F.sum(F.when(both, value)).alias(name) for name, value in moments.items()],
        )
    )

    def extreme(key: str, value: str, highest: bool = True, shown=None) -> DataFrame:
        sums = (
            grouped.filter(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.coalesce(F.sum(value), F.lit(0)).cast("decimal(28,2)").alias("_sum"))
        )
        order = -F.col("_sum") if highest else F.col("_sum")
        best = sums.agg(F.min(F.struct(order.alias("o"), F.col(key), F.col("_sum"))).alias("b"))
        name = F.col(f"b.{key}") if shown is None else shown(F.col(f"b.{key}"))
        amount = F.format_number(F.round(F.col("b._sum"), 0), 0)
        return best.select(F.concat(name, F.lit(" ($"), amount, F.lit(")")).alias("value"))

    returned = grouped.agg(ratio(F.sum("Returned"), F.sum("Lines"), 100).alias("r"))
    sums = grouped.agg(*[F.sum(c).alias(c) for c in ("_n", *moments)])
    spread = F.sqrt(
        (F.col("_n") * F.col("_xx") - F.col("_x") * F.col("_x"))
        * (F.col("_n") * F.col("_yy") - F.col("_y") * F.col("_y"))
    )
    joint = F.col("_n") * F.col("_xy") - F.col("_x") * F.col("_y")
    corr = sums.select(F.try_divide(joint, spread).alias("r"))
    sign = F.when(F.col("r") < 0, "negative -> higher discounts erode profit").otherwise("positive")
    # fixed values: the wording of the seven facts
    facts = [
        ("Best-selling category (revenue)", extreme("Category", "Sales")),
        ("Lowest-selling category (revenue)", extreme("Category", "Sales", highest=False)),
        ("Most profitable category", extreme("Category", "Profit")),
        ("Top state by sales", extreme("State", "Sales")),
        ("Strongest sales month", extreme("Month_End", "Sales", shown=month_name)),
        ("Overall return rate", returned.select(F.format_string("%.1f%%", "r").alias("value"))),
        (
            "Correlation between Discount % and Profit",
            corr.select(F.format_string("%.2f (%s)", F.col("r"), sign).alias("value")),
        ),
    ]
    rows = [
        value.select(F.lit(i).alias("position"), F.lit(metric).alias("metric"), "value")
        for i, (metric, value) in enumerate(facts, 1)
    ]
    summary = rows[0]
    for row in rows[1:]:
        summary = summary.unionByName(row)
    return summary.orderBy("position")
