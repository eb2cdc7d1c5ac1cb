"""All steps from raw tables to stored results, each stage written once and read by the next."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tillroll.operators import churn, features, flat, modelling, sales, segmentation
from tillroll.plans import eda
from tillroll.session import tuned
from tillroll.sources import files
from tillroll.sources.tables import Tables

# The names of the stored results.
CLEANED = "cleaned_ecommerce_data"
ENGINEERED = "engineered_ecommerce_data"
SEGMENTS = "customer_rfm_segments"
CHURN = "churn_predictions"
SALES = "sales_predictions"
INSIGHTS = "eda_insights"


@dataclass(frozen=True)
class Results:
    """The stored results read back, and the two training runs."""

    cleaned: DataFrame
    engineered: DataFrame
    segments: DataFrame
    churn: churn.ChurnRun
    sales: sales.SalesRun


def run(
    t: Tables,
    folder: str,
    kind: str = "parquet",
    trees: int = 300,
    boosted: bool = False,
    starts: int = 10,
) -> Results:
    """Cleans, explores, derives features, segments and predicts; results go below ``folder``.

    Later steps read the Parquet results of earlier ones, so types survive; ``kind="csv"`` writes
    CSV copies beside them.
    """

    tuned(t.orders.sparkSession)

    def stored(df: DataFrame, name: str) -> DataFrame:
        files.write_table(df, f"{folder}/{name}")
        back = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")
        if kind == "csv":
            files.write_table(back, f"{folder}/csv/{name}", "csv")
        return back

    cleaned = stored(flat.cleaned(t), CLEANED)
    files.write_lines(eda.insight_summary(cleaned), f"{folder}/{INSIGHTS}")
    engineered = stored(features.engineered(cleaned), ENGINEERED)
    scored = segmentation.score_rfm(segmentation.rfm_table(engineered))
    segments = stored(segmentation.clustered(scored, starts=starts), SEGMENTS)
    churn_run = churn.train(segments, trees=trees, boosted=boosted)
    modelling.save_model(churn_run.best.model, f"{folder}/models/churn_model")
    stored(churn_run.predictions(), CHURN)
    sales_run = sales.train(engineered, trees=trees, boosted=boosted)
    modelling.save_model(sales_run.best.model, f"{folder}/models/sales_model")
    stored(sales_run.predictions(), SALES)
    return Results(cleaned, engineered, segments, churn_run, sales_run)
