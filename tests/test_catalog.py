"""Views and the history function by name, sketches against exact ranks."""

from pyspark.sql import functions as F

from tests.conftest import rows_of
from tillroll.operators import quality
from tillroll.plans import business, catalog, views


def test_published_views_are_found_by_another_session(spark, star, tmp_path):
    catalog.publish(star, str(tmp_path / "shop"))
    later = spark.newSession()
    catalog.open_published(later, str(tmp_path / "shop"))
    assert later.catalog.tableExists("vw_state_performance") and not spark.newSession().catalog.tableExists("vw_state_performance")
    for name, view in views.all_views(star).items():
        assert rows_of(later.table(name)) == rows_of(view)


def test_history_function(spark, star):
    session = catalog.register(star)
    expected = [tuple(r) for r in business.customer_history(star, p_customer_id="1").collect()]
    assert [tuple(r) for r in catalog.customer_history(session, "1").collect()] == expected and expected
    assert catalog.customer_history(session, "no one'); DROP").count() == 0
    joined = session.sql("SELECT c.Customer_ID, h.Order_ID FROM customers c, LATERAL customer_order_history(c.Customer_ID) h")
    assert joined.count() == star.orders.join(star.order_items, "Order_ID").join(star.customers, "Customer_ID").count()


def test_merged_sketches_know_the_ranks(spark):
    df = spark.range(20_000).selectExpr("id % 7 AS day", "cast(pow(id % 9973, 2) as double) AS x", "if(id < 3, id, null) AS y")
    found = {(r[0], r[1]): r[2] for r in quality.sketched_quantiles(quality.value_sketches(df, ["x", "y"], ["day"]), (0.1, 0.5, 0.99)).collect()}
    for p in (0.1, 0.5, 0.99):
        share = df.agg(F.avg((F.col("x") <= found["x", p]).cast("int"))).first()[0]
        assert abs(share - p) < 0.02
    assert {k: v for k, v in found.items() if k[0] == "y"} == {("y", 0.1): 0.0, ("y", 0.5): 1.0, ("y", 0.99): 2.0}
    nothing = quality.sketched_quantiles(quality.value_sketches(df.limit(0), ["x"]), (0.5,))
    assert [r["value"] for r in nothing.collect()] in ([], [None])
