"""Views and functions that SQL text can ask for by name, also in a later session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.plans import views
from tillroll.sources import files
from tillroll.sources.tables import Tables

HISTORY = """
CREATE OR REPLACE TEMPORARY FUNCTION customer_order_history(p_customer_id STRING)
RETURNS TABLE
RETURN
    SELECT o.Order_ID, o.Order_Date, o.Order_Status, i.Product_ID, i.Category, i.Quantity, i.Sales, i.Profit
    FROM orders o JOIN order_items i ON o.Order_ID = i.Order_ID
    WHERE o.Customer_ID = p_customer_id
    ORDER BY o.Order_Date DESC, o.Order_ID, i.Order_Item_ID
"""


def register(tables: Tables) -> SparkSession:
    """Makes tables, views and the history function available to the SQL of the tables' session."""
    files.register_views(tables, views.all_views(tables))
    spark = tables.orders.sparkSession
    spark.sql(HISTORY)
    return spark


def publish(tables: Tables, folder: str) -> None:
    """Stores the tables so that ``open_published`` finds them in any later session."""
    files.write_tables(tables, folder)


def open_published(spark: SparkSession, folder: str) -> Tables:
    """The published tables; they, the views over them and the history function get their names in this session.

    A view is worked out from the stored tables whenever it is asked for, as a view should be. No
    metastore is needed, which would be a database of its own.
    """
    tables = files.read_parquet_tables(spark, folder)
    register(tables)
    return tables


def customer_history(spark: SparkSession, customer: str) -> DataFrame:
    """The history function called from SQL text, with the name as a parameter."""
    return spark.sql("SELECT * FROM customer_order_history(:customer)", {"customer": customer})
