"""Registered queries by name; each takes (spark, folder with the star-schema Parquet files)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillroll.model import DOCUMENTED_ROWS, PRIMARY_KEYS
from tillroll.operators import (
    churn,
    features,
    flat,
    metrics,
    modelling,
    quality,
    sales,
    segmentation,
)
from tillroll.operators.settle import generation, scratch_path, settled
from tillroll.plans import business as b
from tillroll.plans import catalog, eda, kpis
from tillroll.plans import views as v
from tillroll.session import tuned
from tillroll.sources import files
from tillroll.sources.star import raw_lines, star_tables
from tillroll.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]


def _on_tables(operator: Callable[..., DataFrame], **params) -> Query:
    return lambda spark, folder: operator(star_tables(spark, folder), **params)


def _table_row_counts(t: Tables) -> DataFrame:
    return v.row_counts({name: t[name] for name in t}, "table_name")


def _view_row_counts(t: Tables) -> DataFrame:
    return v.row_counts(v.all_views(t), "view_name")


# The constants of the original questions do not occur in this data; these do.
BUSINESS: dict[str, Query] = {
    "q01_products_in_category": _on_tables(b.products_in_category, category="ECONOMY"),
    "q02_orders_in_month": _on_tables(b.orders_in_month, lo="2000-07-01", hi="2000-07-31"),
    "q03_customers_in_state": _on_tables(b.customers_in_state, state="NATION_3"),
    "q04_top_priced_products": _on_tables(b.top_priced_products),
    "q05_cancelled_orders": _on_tables(b.cancelled_orders),
    "q06_revenue_by_category": _on_tables(b.revenue_by_category),
    "q07_orders_by_segment": _on_tables(b.orders_by_segment),
    "q08_review_avg_by_product": _on_tables(b.review_avg_by_product),
    "q09_revenue_by_state": _on_tables(b.revenue_by_state),
    "q10_orders_by_payment": _on_tables(b.orders_by_payment),
    "q11_big_categories": _on_tables(b.big_categories, min_sales=175_000_000),
    "q12_frequent_customers": _on_tables(b.frequent_customers),
    "q13_high_aov_states": _on_tables(b.high_aov_states, min_aov=72_000),
    "q14_discount_tier": _on_tables(b.discount_tier),
    "q15_value_tier": _on_tables(b.value_tier, edges=(1_000_000, 500_000)),
    "q16_delivery_speed": _on_tables(b.delivery_speed),
    "q17_order_line_detail": _on_tables(b.order_line_detail),
    "q18_never_ordered_products": _on_tables(b.never_ordered_products),
    "q19_last_order_date": _on_tables(b.last_order_date),
    "q20_order_carrier": _on_tables(b.order_carrier),
    "q21_order_360": _on_tables(b.order_360),
    "q22_above_avg_spenders": _on_tables(b.above_avg_spenders),
    "q23_above_category_price": _on_tables(b.above_category_price),
    "q24_above_avg_orders": _on_tables(b.above_avg_orders),
    "q25_top_spender_per_state": _on_tables(b.top_spender_per_state),
    "q26_mom_growth": _on_tables(b.mom_growth),
    "q27_rfm_base": _on_tables(b.rfm_base),
    "q28_category_profit_rank": _on_tables(b.category_profit_rank),
    "q29_spend_by_churn": _on_tables(b.spend_by_churn),
    "q30_running_total": _on_tables(b.running_total),
    "q31_rank_in_category": _on_tables(b.rank_in_category),
    "q32_order_sequence": _on_tables(b.order_sequence),
    "q33_moving_avg_3m": _on_tables(b.moving_avg_3m),
    "q34_top5_products_per_category": _on_tables(b.top5_products_per_category),
    "q35_top3_customers_per_state": _on_tables(b.top3_customers_per_state),
    "q36_spend_quartile": _on_tables(b.spend_quartile),
    "q37_customer_history": _on_tables(b.customer_history, p_customer_id="1"),
    "q38_top20_ltv": _on_tables(b.top20_ltv),
    "q39_monthly_with_year": _on_tables(b.monthly_with_year),
    "q40_headline_kpis": _on_tables(b.headline_kpis),
    "q41_return_rate": _on_tables(b.return_rate),
    "q42_churn_rate_by_segment": _on_tables(b.churn_rate_by_segment),
}

VIEWS: dict[str, Query] = {
    "v1_order_summary": _on_tables(v.order_summary),
    "v2_customer_ltv": _on_tables(v.customer_ltv),
    "v3_monthly_sales": _on_tables(v.monthly_sales),
    "v4_product_performance": _on_tables(v.product_performance),
    "v4_product_performance_preagg": _on_tables(v.product_performance, fan_out=False),
    "v5_state_performance": _on_tables(v.state_performance),
    "u1_table_row_counts": _on_tables(_table_row_counts),
    "u2_view_row_counts": _on_tables(_view_row_counts),
}


# -- sources and data quality ----------------------------------------------------------------


def _as_text(df: DataFrame, **replaced) -> DataFrame:
    """All columns as text, missing values as empty fields, some columns replaced."""
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns}
    texts.update(replaced)
    return df.select(*[value.alias(c) for c, value in texts.items()])


def _orders_from_text(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a text file would bring them, some dates unusable, brought to the schema."""
    key = F.col("Order_ID").cast("bigint")
    day = F.col("Order_Date").cast("string")
    dirty = (
        F.when(key % 7 == 0, "2024-13-01").when(key % 7 == 1, "nan").when(key % 7 == 2, "")
    ).otherwise(F.concat(F.lit(" "), day))
    text = _as_text(star_tables(spark, folder).orders, Order_Date=dirty)
    return files.from_text(text, "orders")


def _items_from_text(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with unusable prices, padded quantities and no Return_Flag column."""
    price = F.when(F.col("Quantity") % 5 == 0, "x").otherwise(F.col("Unit_Price").cast("string"))
    quantity = F.concat(F.lit(" "), F.col("Quantity").cast("string"), F.lit(".0 "))
    text = _as_text(star_tables(spark, folder).order_items, Unit_Price=price, Quantity=quantity)
    return files.from_text(text.drop("Return_Flag"), "order_items")


def _coerced_items(spark: SparkSession, folder: str) -> DataFrame:
    items = star_tables(spark, folder).order_items.select(
        "Order_Item_ID",
        F.when(F.col("Quantity") % 5 == 0, "many")
        .otherwise(F.col("Quantity").cast("string"))
        .alias("Quantity"),
        F.concat(F.lit("  "), "Brand", F.lit(" ")).alias("Brand"),
    )
    return quality.trimmed(quality.to_numbers(items, {"Quantity": "int"}), ["Brand"])


def _csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "order_items")
    files.write_table(star_tables(spark, folder).order_items, path, "csv")
    return files.read_csv(spark, path, "order_items")


def _csv_by_header(spark: SparkSession, folder: str) -> DataFrame:
    """Lines from a file with its columns in another order and two of them missing."""
    path = scratch_path(spark, "shuffled")
    items = star_tables(spark, folder).order_items.drop("Discount", "Return_Flag")
    files.write_table(items.select(*sorted(items.columns, reverse=True)), path, "csv")
    return files.read_csv(spark, path, "order_items")


def _csv_line_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews whose texts hold quotes, separators and line breaks."""
    path = scratch_path(spark, "reviews")
    text = F.concat(F.lit('say "'), "Review_Text", F.lit('",\nthen more'))
    files.write_table(star_tables(spark, folder).reviews.withColumn("Review_Text", text), path, "csv")
    return files.read_csv(spark, path, "reviews")


def _parquet_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "orders")
    files.write_table(star_tables(spark, folder).orders, path)
    return spark.read.parquet(path)


def _views_by_name(spark: SparkSession, folder: str) -> DataFrame:
    """The state view asked for by name in SQL text."""
    t = star_tables(spark, folder)
    v.all_views(t)["vw_state_performance"].createOrReplaceTempView("vw_state_performance")
    return spark.sql("SELECT * FROM vw_state_performance WHERE Customers > 0")


def _reopened_view(spark: SparkSession, folder: str) -> DataFrame:
    """The state view asked for by name in another session, over stored tables."""
    path = scratch_path(spark, "published")
    catalog.publish(star_tables(spark, folder), path)
    later = spark.newSession()
    catalog.open_published(later, path)
    return later.sql("SELECT * FROM vw_state_performance WHERE Customers > 0")


def _history_function(spark: SparkSession, folder: str) -> DataFrame:
    catalog.register(star_tables(spark, folder))
    return spark.sql("SELECT * FROM customer_order_history('1')")


def _report_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The headline facts as a text file, read back."""
    path = scratch_path(spark, "insights")
    files.write_lines(eda.insight_summary(_prepared(spark, folder)), path)
    return spark.read.text(path)


SKETCHED = ("Sales", "Profit", "Unit_Price")
SKETCH_ERROR = 0.02  # of a rank, that the check allows


def _sketch_check(spark: SparkSession, folder: str) -> DataFrame:
    """Quantiles from sketches per category: do the values have the ranks asked for?"""
    items = star_tables(spark, folder).order_items
    found = quality.sketched_quantiles(quality.value_sketches(items, SKETCHED, ["Category"]), (0.05, 0.25, 0.5, 0.75, 0.95))
    points = found.groupBy("column_name").agg(F.sort_array(F.collect_list(F.struct("probability", "value"))).alias("points"))
    values = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x")) for c in SKETCHED]
    ranked = (
        items.select(F.inline(F.array(*values))).filter("x is not null")
        .join(F.broadcast(points), "column_name")  # a row per column
        .select("column_name", "x", F.inline("points"))
        .groupBy("column_name", "probability")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("x") < F.col("value")).alias("below"),
            F.count_if(F.col("x") <= F.col("value")).alias("upto"),
        )
    )
    slack = F.col("n") * SKETCH_ERROR
    right = (F.col("below") - slack <= F.col("n") * F.col("probability")) & (F.col("n") * F.col("probability") <= F.col("upto") + slack)
    return ranked.select("column_name", "probability", "n", right.alias("rank_is_right"))


LINE_KEY = ["l_orderkey", "l_linenumber"]


def _duplicate_report(spark: SparkSession, folder: str) -> DataFrame:
    t = star_tables(spark, folder)
    report = quality.duplicate_report(raw_lines(spark, folder), LINE_KEY, "raw_lines")
    for name in flat.DEDUPED:
        part = quality.duplicate_report(t[name], PRIMARY_KEYS[name], name)
        report = report.unionByName(part)
    return report


def _first_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = raw_lines(spark, folder).withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    return quality.first_per_key(lines, LINE_KEY, ["l_partkey", "l_suppkey"])


def _prepared(spark: SparkSession, folder: str) -> DataFrame:
    """The typed flat table; keys are unique by construction, as d12 shows."""
    return flat.prepared(star_tables(spark, folder))


def _on_marks(operator: Callable[..., DataFrame], **params) -> Query:
    """On the prepared table, of which only the presence of values counts."""
    return lambda spark, folder: operator(flat.prepared_marks(star_tables(spark, folder)), **params)


def _on_flat(operator: Callable[..., DataFrame], **params) -> Query:
    return lambda spark, folder: operator(_prepared(spark, folder), **params)


def _outliers(spark: SparkSession, folder: str) -> DataFrame:
    flags = [f"{c}_Outlier" for c in quality.OUTLIER_COLUMNS]
    flagged = quality.outlier_flags(star_tables(spark, folder).order_items)
    return flagged.select("Order_Item_ID", *quality.OUTLIER_COLUMNS, *flags)


def _outlier_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.outlier_report(quality.outlier_flags(star_tables(spark, folder).order_items))


def _dirty_foreign_keys(spark: SparkSession, folder: str) -> DataFrame:
    return quality.foreign_key_report(star_tables(spark, folder, orphans=True))


def _formula(t: Tables) -> DataFrame:
    """Sales are stored with two digits: a narrow tolerance shows the rounded lines."""
    return quality.formula_violations(t.order_items, 0.004)


STORED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _stored_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return files.stored_row_counts(spark, {name: f"{folder}/{name}.parquet" for name in STORED})


QUALITY: dict[str, Query] = {
    "s11_stored_row_counts": _stored_row_counts,
    "s01_table_shapes": _on_tables(quality.table_shapes),
    "s01_csv_round_trip": _csv_round_trip,
    "s02_csv_by_header": _csv_by_header,
    "s04_csv_line_breaks": _csv_line_breaks,
    "s03_orders_from_text": _orders_from_text,
    "s07_parquet_round_trip": _parquet_round_trip,
    "s08_report_lines": _report_lines,
    "s10_view_by_name": _views_by_name,
    "s10_view_reopened": _reopened_view,
    "g03_history_function": _history_function,
    "d09_sketch_check": _sketch_check,
    "s11_row_count_check": _on_tables(quality.row_count_check, expected={**DOCUMENTED_ROWS, "categories": 30}),
    "d01_duplicate_report": _duplicate_report,
    "d01_first_per_key": _first_lines,
    "d04_items_from_text": _items_from_text,
    "d05_coerced_and_trimmed": _coerced_items,
    "d06_null_report": _on_marks(quality.null_report),
    "d08_unexpected_nulls": _on_marks(quality.unexpected_nulls),
    "d09_outlier_flags": _outliers,
    "d10_outlier_report": _outlier_report,
    "d11_integrity": _on_flat(quality.integrity_violations),
    "d12_primary_keys": _on_tables(quality.primary_key_report),
    "d13_foreign_keys": _on_tables(quality.foreign_key_report),
    "d13_foreign_keys_dirty": _dirty_foreign_keys,
    "d14_scores_outside_2_to_4": _on_tables(
        lambda t: quality.out_of_range(t.reviews, low=2, high=4)
    ),
    "d15_required_columns": _on_tables(quality.required_report),
    "d15_text_lengths": _on_tables(quality.length_report),
    "d17_formula_check": _on_tables(_formula),
    "j05_flat_table": _on_tables(flat.flat_table, staged=True),
    "c01_cleaned": lambda spark, folder: flat.cleaned(star_tables(spark, folder)),
}


# -- features and exploration ----------------------------------------------------------------


def _engineered(spark: SparkSession, folder: str) -> DataFrame:
    return features.engineered(flat.cleaned(star_tables(spark, folder), dedupe=False))


def _label_codes(spark: SparkSession, folder: str) -> DataFrame:
    codes = [f"{c}_Encoded" for c in features.ENCODED]
    coded = features.label_codes(_prepared(spark, folder), features.ENCODED)
    return coded.select("Order_Item_ID", *codes)


FEATURES: dict[str, Query] = {
    "e01_date_features": lambda spark, folder: features.date_features(
        _prepared(spark, folder).select("Order_Item_ID", "Order_Date", "Ship_Date")
    ),
    "e02_financial_features": lambda spark, folder: features.financial_features(
        star_tables(spark, folder).order_items.select(
            "Order_Item_ID", "Sales", "Profit", "Quantity", "Discount"
        )
    ),
    "e06_tenure_features": lambda spark, folder: features.tenure_features(
        _prepared(spark, folder).select(
            "Order_Item_ID", "Order_Date", "Customer_Since", "Total_Spend", "Total_Orders"
        )
    ),
    "e08_label_codes": _label_codes,
    "e09_engineered": _engineered,
}

EXPLORATION: dict[str, Query] = {
    "x01_numeric_summary": _on_flat(eda.numeric_summary),
    "x01_value_counts": _on_flat(eda.value_counts),
    "x02_correlation_matrix": _on_flat(eda.correlation_matrix),
    "x03_monthly_trend": _on_flat(eda.monthly_trend),
    "x04_top_products": _on_flat(eda.top_products),
    "x05_profit_by_category": _on_flat(eda.profit_by_category),
    "x06_sales_by_state": _on_flat(eda.sales_by_state),
    "x07_age_histogram": _on_flat(eda.age_histogram),
    "x07_age_density": _on_flat(eda.age_density),
    "x08_discount_profit_sample": _on_flat(eda.discount_profit_sample),
    "x09_order_status": _on_flat(eda.order_status_breakdown),
    "x10_insights": _on_flat(eda.insight_summary),
}


# -- customers: scores, segments, clusters ---------------------------------------------------


def _rfm(spark: SparkSession, folder: str) -> DataFrame:
    t = star_tables(spark, folder)
    return segmentation.rfm_table(v.sold_orders(t), t.customers)


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return segmentation.score_rfm(_rfm(spark, folder))


def _state(spark: SparkSession, folder: str) -> int:
    """Changes when a file of the folder does: a hash of names, sizes and times."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    entries = []
    while found.hasNext():
        status = found.next()
        entries.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return hash(tuple(sorted(entries)))


def _once(make: Callable[..., object]) -> Callable[..., object]:
    """Fits of one session, folder and state of its files, made once and used by all queries that show them.

    They are made anew after stored tables have been removed, since they read those.
    """
    kept: dict = {}

    def shared(spark: SparkSession, folder: str):
        key = (spark.sparkContext.applicationId, folder, _state(spark, folder), generation())
        if key not in kept:
            kept.clear()  # results of another folder or state are not asked for again
            kept[key] = make(spark, folder)
        return kept[key]

    return shared


@_once
def _clustered(spark: SparkSession, folder: str) -> DataFrame:
    return settled(segmentation.clustered(_scored(spark, folder)))


@_once
def _elbow(spark: SparkSession, folder: str) -> DataFrame:
    return segmentation.elbow(_rfm(spark, folder))


def _clusters_check(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold for any clustering: each customer once, no empty cluster, numbers by value."""
    profile = _clustered(spark, folder).groupBy("Cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("Customer_ID").alias("ids"),
        F.avg(F.col("Monetary").cast("double")).alias("mean"),
    )
    before = F.lag("mean").over(W.orderBy("Cluster"))  # one row per cluster
    return profile.withColumn("falls", (F.col("mean") < before).cast("int")).agg(
        F.sum("n").alias("customers"),
        F.sum("ids").alias("different_customers"),
        F.count(F.lit(1)).alias("clusters"),
        F.coalesce(F.sum("falls"), F.lit(0)).alias("out_of_order"),
    )


SEGMENTS: dict[str, Query] = {
    "r01_rfm_table": _rfm,
    "r02_scored_segments": _scored,
    "r07_segment_distribution": lambda spark, folder: segmentation.segment_distribution(
        _scored(spark, folder)
    ),
    "r08_standardised": lambda spark, folder: _rounded(
        segmentation.standardised(
            _rfm(spark, folder).select("Customer_ID", *segmentation.MEASURES)
        )
    ),
    "r09_elbow": _elbow,
    "r09_elbow_check": lambda spark, folder: _elbow(spark, folder).agg(
        F.count(F.lit(1)).alias("cluster_counts"),
        (F.max_by("Inertia", "Clusters") < F.min_by("Inertia", "Clusters")).alias("falls"),
    ),
    "r10_clusters": _clustered,
    "r10_clusters_check": _clusters_check,
    "r11_profile_check": lambda spark, folder: _profile_check(spark, folder),
    "r11_cluster_profile": lambda spark, folder: segmentation.cluster_profile(
        _clustered(spark, folder)
    ),
}


# -- prediction ------------------------------------------------------------------------------

def _churn_features(spark: SparkSession, folder: str) -> DataFrame:
    table = churn.feature_table(_scored(spark, folder))
    return table.select("Customer_ID", *churn.FEATURES, "Churned", "is_test")


@_once
def _churn_base(spark: SparkSession, folder: str) -> churn.ChurnRun:
    return churn.train(_scored(spark, folder))


@_once
def _churn(spark: SparkSession, folder: str) -> churn.ChurnRun:
    return churn.with_boosted(_churn_base(spark, folder))


@_once
def _churn_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return settled(_churn(spark, folder).predictions())


def _dated(spark: SparkSession, folder: str) -> DataFrame:
    return features.date_features(_prepared(spark, folder))


def _sales_features(spark: SparkSession, folder: str) -> DataFrame:
    table = sales.feature_table(_dated(spark, folder))
    return table.select("Order_Item_ID", *sales.FEATURES, "Sales", "is_test")


@_once
def _sales_base(spark: SparkSession, folder: str) -> sales.SalesRun:
    return sales.train(_dated(spark, folder))


@_once
def _sales(spark: SparkSession, folder: str) -> sales.SalesRun:
    return sales.with_boosted(_sales_base(spark, folder))


@_once
def _sales_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """All lines scored once; the checks read the same table."""
    return settled(_sales(spark, folder).predictions())


def _churn_check(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold for any churn model's predictions."""
    p = F.col("Predicted_Churn_Probability")
    tier = F.when(p <= 0.33, "Low Risk").when(p <= 0.66, "Medium Risk").otherwise("High Risk")
    said = F.when(p > 0.5, 1).otherwise(0)
    return _churn_predictions(spark, folder).agg(
        F.count(F.lit(1)).alias("customers"),
        F.countDistinct("Customer_ID").alias("different_customers"),
        F.count_if(p.isNull() | ~p.between(0, 1)).alias("outside_0_to_1"),
        F.count_if(F.col("Churn_Risk_Tier") != tier).alias("wrong_tier"),
        F.count_if(F.col("Predicted_Churn") != said).alias("wrong_class"),
    )


def _sales_check(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold for any sales model's predictions."""
    off = F.abs(F.col("Sales") - F.col("Predicted_Sales") - F.col("Prediction_Error"))
    return _sales_predictions(spark, folder).agg(
        F.count(F.lit(1)).alias("lines"),
        F.countDistinct("Order_Item_ID").alias("different_lines"),
        F.round(F.sum("Sales"), 0).alias("sales"),
        F.count_if(off.isNull() | (off > 1e-6)).alias("wrong_error"),
    )


def _importances_check(importances: DataFrame) -> DataFrame:
    """What must hold for any importances: shares of 1, none negative, highest first."""
    return importances.agg(
        F.count(F.lit(1)).alias("features"),
        F.countDistinct("feature").alias("different_features"),
        F.count_if(F.col("importance") < 0).alias("negative"),
        F.round(F.sum("importance"), 6).alias("total"),
    )


def _test_pairs_check(spark: SparkSession, folder: str) -> DataFrame:
    """Test rows are about a fifth of the lines, each once, with the line's own Sales."""
    run = _sales_base(spark, folder)
    lines = star_tables(spark, folder).order_items.select("Order_Item_ID", F.col("Sales").cast("double").alias("own"))
    pairs = run.test_pairs().join(lines, "Order_Item_ID", "left")
    share = F.count(F.lit(1)) / run.features.count()
    return pairs.agg(
        (F.count(F.lit(1)) - F.countDistinct("Order_Item_ID")).alias("repeated"),
        F.count_if(F.col("own").isNull() | (F.abs(F.col("own") - F.col("Sales")) > 1e-6) | F.col("Predicted_Sales").isNull()).alias("wrong"),
        share.between(0.15, 0.25).alias("about_a_fifth"),
    )


def _round_trip_check(spark: SparkSession, folder: str) -> DataFrame:
    """The reloaded model says of each customer what the model said before it was stored."""
    run = _churn_base(spark, folder)
    again = _model_round_trip(spark, folder)
    first = churn.predicted(run.best.model, run.features).select(
        "Customer_ID", F.col("prediction").alias("said"), F.col("score").alias("before")
    )
    same = (F.col("said") == F.col("prediction")) & (F.col("before") == F.col("score"))
    return again.join(first, "Customer_ID").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(~same).alias("different")
    )


def _high_risk_check(spark: SparkSession, folder: str) -> DataFrame:
    """The headline count is that of the probabilities above the highest edge."""
    predictions = _churn_predictions(spark, folder)
    above = predictions.agg(F.count_if(F.col("Predicted_Churn_Probability") > 0.66)).scalar()
    return churn.high_risk_count(predictions).select((above == F.col("high_risk_customers")).alias("agrees"))


def _profile_check(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster sizes add up to the customers, and so do their means times the sizes."""
    profile = segmentation.cluster_profile(_clustered(spark, folder))
    return profile.agg(
        F.count(F.lit(1)).alias("clusters"),
        F.sum("Customers").alias("customers"),
        F.round(F.sum(F.col("Customers") * F.col("Frequency")) / F.sum("Customers"), 0).alias("mean_frequency"),
    )


def _best_check(comparison: DataFrame, metric: str, chosen: str) -> DataFrame:
    """The models compared, and whether the one chosen has the highest metric and no metric exceeds 1."""
    best = comparison.orderBy(F.desc(metric), "position").limit(1).select((F.col("model") == chosen).alias("best_is_chosen"))
    shown = comparison.agg(
        F.array_join(F.sort_array(F.collect_list("model")), ", ").alias("models"),
        (F.count_if(F.col(metric).isNull() | (F.col(metric) > 1)) == 0).alias("within_range"),
    )
    return shown.join(best)


def _recomputed(run, predictions: DataFrame, key: str, metric: str, digits: int, measure: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Whether the chosen model's metric follows from the stored predictions of the test rows."""
    test = run.features.filter("is_test").select(key)
    again = measure(predictions.join(test, key, "left_semi")).select(F.round(metric, digits).alias("again"))
    said = run.comparison.filter(F.col("model") == run.best.name).select(F.col(metric).alias("said"))
    return again.join(said).select((F.abs(F.col("again") - F.col("said")) < 1.5 * 10**-digits).alias("follows_from_predictions"))


def _churn_models_check(spark: SparkSession, folder: str) -> DataFrame:
    run = _churn(spark, folder)
    scores = lambda df: metrics.roc_auc(
        df.select(F.col("Churned").alias("label"), F.col("Predicted_Churn_Probability").alias("score"))
    )
    follows = _recomputed(run, _churn_predictions(spark, folder), "Customer_ID", "roc_auc", 4, scores)
    return _best_check(run.comparison, "roc_auc", run.best.name).join(follows)


def _sales_models_check(spark: SparkSession, folder: str) -> DataFrame:
    """Also that trees explain more than a line does."""
    run = _sales(spark, folder)
    pairs = lambda df: metrics.regression_metrics(
        df.select(F.col("Sales").alias("label"), F.col("Predicted_Sales").alias("prediction"))
    )
    follows = _recomputed(run, _sales_predictions(spark, folder), "Order_Item_ID", "r2", 3, pairs)
    linear = F.max(F.when(F.col("model") == "Linear Regression", F.col("r2")))
    trees = run.comparison.agg((F.max("r2") > linear).alias("trees_beat_line"))
    return _best_check(run.comparison, "r2", run.best.name).join(follows).join(trees)


def _fixed_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Customers with a score that needs no model, so that SQL can check the metrics."""
    score = ((F.col("Customer_Age") * 37 + F.col("Total_Orders") * 11) % 100) / F.lit(100.0)
    return star_tables(spark, folder).customers.select(
        "Customer_ID",
        F.col("Churned").alias("label"),
        score.alias("score"),
        F.when(score > 0.5, 1).otherwise(0).alias("prediction"),
    )


def _on_scores(metric: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: metric(_fixed_scores(spark, folder))


def _rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Doubles rounded, for comparison with another engine's order of summing."""
    return df.withColumns(
        {c: F.round(c, digits) for c, kind in df.dtypes if kind == "double"}
    )


def _fixed_estimates(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with the undiscounted amount as estimate of their Sales."""
    return star_tables(spark, folder).order_items.select(
        F.col("Sales").cast("double").alias("label"),
        (F.col("Quantity") * F.col("Unit_Price")).cast("double").alias("prediction"),
    )


def _risk_tiers(spark: SparkSession, folder: str) -> DataFrame:
    return _fixed_scores(spark, folder).select(
        "Customer_ID", "score", churn.risk_tier("score").alias("Churn_Risk_Tier")
    )


def _model_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of the stored and reloaded model."""
    run = _churn_base(spark, folder)
    path = scratch_path(spark, "churn_model")
    modelling.save_model(run.best.model, path)
    scored = churn.predicted(modelling.load_model(path), run.features)
    return scored.select("Customer_ID", "prediction", "score")


PREDICTION: dict[str, Query] = {
    "s09_model_round_trip": _model_round_trip,
    "s09_round_trip_check": _round_trip_check,
    "m01_churn_features": _churn_features,
    "m02_sales_features": _sales_features,
    "m10_classification_metrics": _on_scores(
        lambda df: _rounded(metrics.classification_metrics(df))
    ),
    "m11_roc_auc": _on_scores(lambda df: _rounded(metrics.roc_auc(df))),
    "m12_classification_report": _on_scores(
        lambda df: _rounded(metrics.classification_report(df))
    ),
    "m13_confusion_matrix": _on_scores(metrics.confusion_matrix),
    "m14_roc_points": _on_scores(lambda df: _rounded(metrics.roc_points(df))),
    "m15_churn_importances": lambda spark, folder: _churn_base(spark, folder).importances(),
    "m15_sales_importances": lambda spark, folder: _sales_base(spark, folder).importances(),
    "m15_churn_check": lambda spark, folder: _importances_check(_churn_base(spark, folder).importances()),
    "m15_sales_check": lambda spark, folder: _importances_check(_sales_base(spark, folder).importances()),
    "m16_churn_comparison": lambda spark, folder: _churn(spark, folder).comparison,
    "m16_churn_check": _churn_models_check,
    "m16_sales_comparison": lambda spark, folder: _sales(spark, folder).comparison,
    "m16_sales_check": _sales_models_check,
    "m17_churn_predictions": _churn_predictions,
    "m17_churn_check": _churn_check,
    "m18_risk_tiers": _risk_tiers,
    "m19_high_risk_count": lambda spark, folder: churn.high_risk_count(_risk_tiers(spark, folder)),
    "m20_churn_rate": lambda spark, folder: _rounded(churn.churn_rate(_rfm(spark, folder))),
    "m24_regression_metrics": lambda spark, folder: _rounded(
        metrics.regression_metrics(_fixed_estimates(spark, folder)), 6
    ),
    "m25_sales_test_pairs": lambda spark, folder: _sales_base(spark, folder).test_pairs(),
    "m25_test_pairs_check": _test_pairs_check,
    "m26_sales_predictions": _sales_predictions,
    "m26_sales_check": _sales_check,
    "m28_churn_label": lambda spark, folder: _rfm(spark, folder).select(
        "Customer_ID", "Recency", churn.churn_label().alias("Churned")
    ),
}

KPIS: dict[str, Query] = {
    "k01_repeat_buyer_rate": _on_tables(kpis.repeat_buyer_rate),
    "k02_margin_by_discount_tier": _on_tables(kpis.margin_by_discount_tier),
    "k03_slow_shipment_share": _on_tables(kpis.slow_shipment_share),
    "k04_high_risk_customers": lambda spark, folder: churn.high_risk_count(
        _churn_predictions(spark, folder)
    ),
    "k04_high_risk_check": lambda spark, folder: _high_risk_check(spark, folder),
    "k05_pivot_category_month": _on_tables(kpis.pivot_category_month),
    "k06_cleaning_log": lambda spark, folder: kpis.cleaning_log(
        star_tables(spark, folder), flat.prepared_marks(star_tables(spark, folder), quality.OUTLIER_COLUMNS)
    ),
    "k07_customer_lookup": _on_tables(
        lambda t: kpis.lookup(t.customers, "Customer_ID", "1")
    ),
    "k07_product_lookup_many": _on_tables(
        lambda t: kpis.lookup_many(
            t.products, "Product_ID", t.order_items.filter("Return_Flag = 'Yes'")
        )
    ),
}



# Shuffled bytes count for more here than the time of sorting.
SORTED = ("j05_flat_table",)


def _in_tuned_session(query: Query, hashed: bool) -> Query:
    return lambda spark, folder: query(tuned(spark, hashed), folder)


_ALL = {
    **BUSINESS,
    **VIEWS,
    **QUALITY,
    **FEATURES,
    **EXPLORATION,
    **SEGMENTS,
    **PREDICTION,
    **KPIS,
}

QUERIES: dict[str, Query] = {name: _in_tuned_session(query, name not in SORTED) for name, query in _ALL.items()}
