"""What the physical plans must and must not contain."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SMALL, rows_of
from tillroll.operators import flat, quality, settle
from tillroll.plans import business as b
from tillroll.plans import views as v
from tillroll.session import tuned
from tillroll.sources import files

QUERIES = entry.queries()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, star, tmp_path_factory):
    """The eight tables as Parquet, the way a user keeps them."""
    folder = str(tmp_path_factory.mktemp("tables"))
    files.write_tables(star, folder)
    return files.read_parquet_tables(spark, folder)


LAZY = [n for n in sorted(QUERIES) if n[0] in "qvu" or n.startswith(("x0", "d1", "k0"))]
LAZY = [n for n in LAZY if n not in ("k04_high_risk_customers", "k06_cleaning_log")]


@pytest.mark.parametrize("name", LAZY)
def test_no_pairs_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan


def test_filter_and_columns_reach_the_scan(stored):
    plan = plan_of(b.products_in_category(stored, "ECONOMY"))
    assert "EqualTo(Category,ECONOMY)" in plan
    assert "Unit_Cost" not in plan and "Stock_Quantity" not in plan
    plan = plan_of(b.orders_in_month(stored, "2000-07-01", "2000-07-31"))
    assert "GreaterThanOrEqual(Order_Date" in plan and "Payment_Method" not in plan


def test_top_k_and_rank_limits(stored):
    assert "TakeOrderedAndProject" in plan_of(b.top_priced_products(stored))
    assert "TakeOrderedAndProject" in plan_of(v.customer_ltv(stored).orderBy("State").limit(3))
    assert plan_of(b.top5_products_per_category(stored)).count("WindowGroupLimit") == 2


def test_group_values_are_broadcast_once_their_size_is_known(stored):
    for df in (b.above_category_price(stored), b.top_spender_per_state(stored)):
        plan = plan_of(df)
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_anti_join(stored):
    assert "LeftAnti" in plan_of(b.never_ordered_products(stored))


def test_lines_are_summed_before_the_joins(stored):
    """The scan of the lines feeds a partial sum, not a join."""
    for df in (b.revenue_by_state(stored), b.rfm_base(stored), v.monthly_sales(stored)):
        plan = plan_of(df)
        lines = plan[: plan.index("order_items")].splitlines()
        above = [line for line in lines if "HashAggregate" in line or "Join" in line]
        assert "partial_sum" in above[-1]


def test_unused_order_totals_are_not_computed(star):
    assert "lineitem" not in plan_of(b.orders_by_payment(star))


def test_a_hot_order_is_split_before_a_grouping_on_orders(spark, stored):
    """A third of the lines belong to one order; adaptive execution cuts its partition."""
    lines = stored.order_items.crossJoin(spark.range(40)).withColumn(
        "Order_ID", F.when(F.col("id") % 3 == 0, "6").otherwise(F.col("Order_ID"))
    )
    hot = stored.replaced(order_items=lines.repartition(8).drop("id"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        tuned(spark)
        joined = flat.flat_table(hot).groupBy("Order_ID").agg(
            F.sum("Sales").alias("Sales"), F.max("Customer_Age").alias("Age")
        )
        per_order = {r["Order_ID"]: r["Sales"] for r in joined.collect()}
        plan = plan_of(joined)
    finally:
        for key in small:
            spark.conf.unset(key)
    assert "skew=true" in plan
    assert sum(per_order.values()) == hot.order_items.agg(F.sum("Sales")).first()[0]


def test_staged_flat_tables_are_the_lazy_one(star, monkeypatch):
    """Sides that are stored and orders that take turns give the same lines, and only the result stays stored."""
    lazy = rows_of(flat.flat_table(star).select(F.struct("*").cast("string")))
    assert rows_of(flat.flat_table(star, staged=True).select(F.struct("*").cast("string"))) == lazy
    stored, gone = [], []
    monkeypatch.setattr(flat, "settled", lambda df: (stored.append(settle.settled(df)), stored[-1])[1])
    monkeypatch.setattr(flat, "discard", lambda *frames: (gone.extend(f.inputFiles()[0] for f in frames), settle.discard(*frames)))
    monkeypatch.setattr(flat, "TURN_ROWS", 1_000)
    whole = flat._settled_flat(star)
    assert rows_of(whole.select(F.struct("*").cast("string"))) == rows_of(flat.prepared(star).select(F.struct("*").cast("string")))
    turns = [df.count() for df in stored[2:]]
    assert len(turns) == 2 and min(turns) > 0 and sum(turns) == len(lazy)
    assert len(gone) == 2 and not any(Path(file.removeprefix("file:")).exists() for file in gone)


def test_lines_without_an_order_take_part_in_a_turn(tables, monkeypatch):
    monkeypatch.setattr(flat, "TURN_ROWS", 2)
    t = tables(
        order_items=[{"Order_Item_ID": str(i), "Order_ID": o} for i, o in enumerate(["a", "b", None, "x", "a"])],
        orders=[{"Order_ID": o, "Customer_ID": "c"} for o in ("a", "b", None)],
        customers=[{"Customer_ID": "c"}],
    )
    expected = rows_of(flat.prepared(t).select("Order_Item_ID", F.coalesce("Customer_ID", F.lit("-"))))
    assert [c for _, c in expected] == ["c", "c", "-", "-", "c"]
    assert rows_of(flat._settled_flat(t).select("Order_Item_ID", F.coalesce("Customer_ID", F.lit("-")))) == expected


def test_counting_duplicates_leaves_nothing_shuffled(spark, monkeypatch):
    seen = []
    real = quality.duplicate_report
    monkeypatch.setattr(quality, "duplicate_report", lambda *a: (seen.append(spark.conf.get(settle.SHUFFLES_GO)), real(*a))[1])
    before = spark.conf.get(settle.SHUFFLES_GO)
    assert quality.without_duplicates(spark.range(5).selectExpr("id % 4 AS k", "id AS v"), "k")[1] == 1
    assert seen == ["true"] and spark.conf.get(settle.SHUFFLES_GO) == before
