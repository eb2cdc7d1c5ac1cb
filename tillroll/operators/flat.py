"""One analysis-ready row per order line, and its cleaning."""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.model import PRIMARY_KEYS, SCHEMAS
from tillroll.operators import quality
from tillroll.operators.settle import discard, settled
from tillroll.sources.tables import Tables

DEDUPED = ("customers", "products", "orders", "order_items")
DATES = ("Order_Date", "Ship_Date", "Customer_Since")
TURN_ROWS = 5_000_000  # lines above which orders join them in two turns; more turns would read both sides too often
# The columns that must be numbers.
NUMBERS = {
    "Quantity": "int",
    "Unit_Price": "decimal(10,2)",
    "Discount": "decimal(4,2)",
    "Sales": "decimal(12,2)",
    "Shipping_Cost": "decimal(8,2)",
    "Profit": "decimal(12,2)",
    "Customer_Age": "int",
    "Customer_Lifetime_Value": "decimal(18,2)",
}


def _declared(t: Tables, table: str) -> DataFrame:
    return t[table].select(*SCHEMAS[table].names)


def _with_suffix(right: DataFrame, names: list[str], key: str, suffix: str) -> DataFrame:
    """Columns of ``right`` whose names are taken get the suffix, the key excepted."""
    taken = set(names) - {key}
    return right.select(
        *[F.col(c).alias(f"{c}{suffix}") if c in taken else F.col(c) for c in right.columns]
    )


def _sides(t: Tables) -> tuple[DataFrame, DataFrame, list[str]]:
    """Lines with their mean review, orders with shipment and customer, and the columns of both together.

    Shipments and customers meet the orders first, so the lines are shuffled only twice: if the review
    is used at all, once by line, with the columns of order_items only, and once by order. Several
    shipments of an order repeat its lines.
    """
    items = _declared(t, "order_items")
    orders = _declared(t, "orders")
    customers = _declared(t, "customers")
    orders = _with_suffix(orders, items.columns, "Order_ID", "_order")
    taken = [*items.columns, *orders.columns]
    customers = _with_suffix(customers, taken, "Customer_ID", "_cust")
    # Adaptive execution splits a hot order only where both sides of the join are shuffled for
    # it. Orders therefore meet their shipments under a derived key: were it Order_ID itself,
    # the result would already lie as the lines' join needs it, and would not be shuffled again.
    shipping = t.shipping.select(
        F.concat("Order_ID", F.lit("")).alias("_parcel"), "Shipping_Mode", "Carrier"
    )
    parcels = orders.withColumn("_parcel", F.concat("Order_ID", F.lit("")))
    context = (
        parcels.join(shipping, "_parcel", "left").drop("_parcel").join(customers, "Customer_ID", "left")
    )
    score = F.sum("Review_Score").cast("double") / F.count("Review_Score")
    reviews = (
        t.reviews.filter(F.col("Review_Score").isNotNull())
        .groupBy("Order_Item_ID")
        .agg(score.alias("Review_Score"))
    )
    names = [
        *items.columns,
        *[c for c in orders.columns if c != "Order_ID"],
        *[c for c in customers.columns if c != "Customer_ID"],
        "Shipping_Mode",
        "Carrier",
        "Review_Score",
    ]
    # the review mean meets the lines while they are narrow
    return items.join(reviews, "Order_Item_ID", "left"), context, names


def _stored_sides(t: Tables) -> tuple[DataFrame, DataFrame, list[str]]:
    """The sides written one after the other, so that what is shuffled for one is gone before the next."""
    lines, context, names = _sides(t)
    return settled(lines), settled(context), names


def flat_table(t: Tables, staged: bool = False) -> DataFrame:
    """Lines with order, customer, shipment and mean review: 41 columns.

    ``staged`` stores both sides of the last join first, which takes less disk if all columns are asked for;
    otherwise columns that nobody asks for are not even read.
    """
    lines, context, names = (_stored_sides if staged else _sides)(t)
    return lines.join(context, "Order_ID", "left").select(*names)


def _settled_flat(t: Tables) -> DataFrame:
    """The prepared table, stored; of many lines, half of the orders join theirs before the others are shuffled."""
    lines, context, names = _stored_sides(t)
    turns = 2 if lines.count() > TURN_ROWS else 1

    def flat(turn: int) -> DataFrame:
        part = F.pmod(F.xxhash64("Order_ID"), F.lit(turns)) == turn
        joined = lines.filter(part).join(context.filter(part), "Order_ID", "left").select(*names)
        return settled(presence_flags(typed_flat(joined)))

    whole = reduce(DataFrame.unionByName, [flat(turn) for turn in range(turns)])
    discard(lines, context)
    return whole


def typed_flat(flat: DataFrame) -> DataFrame:
    """Dates, numbers and trimmed text."""
    return quality.trimmed(quality.to_numbers(quality.to_dates(flat, DATES), NUMBERS))


def presence_flags(flat: DataFrame) -> DataFrame:
    """Unshipped and unreviewed lines are no errors: they keep NULL and get a flag."""
    return flat.withColumns(
        {
            "Was_Shipped": F.col("Ship_Date").isNotNull(),
            "Has_Review": F.col("Review_Score").isNotNull(),
        }
    )


def deduped_tables(t: Tables) -> tuple[Tables, dict[str, int]]:
    """The tables without repeated keys, and the dropped rows per table."""
    kept, dropped = {}, {}
    for name in DEDUPED:
        kept[name], dropped[name] = quality.without_duplicates(t[name], PRIMARY_KEYS[name])
    return t.replaced(**kept), dropped


def prepared(t: Tables) -> DataFrame:
    """The typed flat table with presence flags, for tables with unique keys."""
    return presence_flags(typed_flat(flat_table(t)))


def prepared_marks(t: Tables, kept: Collection[str] = ()) -> DataFrame:
    """The prepared table for counts of missing values: true instead of each value but the keys' and those of ``kept``.

    Types are set before the joins, so that they move a mark per value and not the values.
    """
    keys = {"Order_Item_ID", "Order_ID", "Customer_ID"}

    def marks(name: str) -> DataFrame:
        df = quality.to_dates(_declared(t, name), DATES)
        df = quality.to_numbers(df, {c: kind for c, kind in NUMBERS.items() if c in df.columns})
        df = quality.trimmed(df, [c for c in quality.TRIMMED if c in df.columns])
        present = {c: F.when(F.col(c).isNotNull(), F.lit(True)) for c in df.columns if c not in keys and c not in kept}
        return df.select(*[present.get(c, F.col(c)).alias(c) for c in df.columns])

    names = ("order_items", "orders", "customers")
    shipping = t.shipping.select("Order_ID", *[F.when(F.col(c).isNotNull(), F.lit(True)).alias(c) for c in ("Shipping_Mode", "Carrier")])
    return presence_flags(flat_table(t.replaced(shipping=shipping, **{name: marks(name) for name in names})))


def cleaned(t: Tables, dedupe: bool = True, exact_quantiles: bool = True) -> DataFrame:
    """The whole cleaning: 46 columns, integrity enforced.

    The joined table is written once; the checks and quartiles then read only their columns.
    """
    tables = deduped_tables(t)[0] if dedupe else t
    flat = quality.require_integrity(_settled_flat(tables))
    return quality.outlier_flags(flat, exact=exact_quantiles)
