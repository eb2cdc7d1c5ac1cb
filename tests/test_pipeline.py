"""From CSV files to stored predictions, end to end."""

from tests.conftest import rows_of
from tillroll.operators import churn, modelling, sales
from tillroll.plans import pipeline
from tillroll.sources import files


def test_csv_to_predictions(spark, star, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for name in star:
        files.write_table(star[name], f"{source}/{name}.csv", "csv")
    results = pipeline.run(
        files.read_csv_tables(spark, source), out, kind="csv", trees=3, starts=1
    )
    assert (len(results.cleaned.columns), len(results.engineered.columns)) == (46, 68)
    lines = star.order_items.count()
    assert results.cleaned.count() == results.engineered.count() == lines
    assert spark.read.parquet(f"{out}/{pipeline.SALES}").columns == list(sales.EXPORTED)
    assert spark.read.parquet(f"{out}/{pipeline.CHURN}").columns == list(churn.EXPORTED)
    assert spark.read.csv(f"{out}/csv/{pipeline.SALES}", header=True).count() == lines
    segments = results.segments
    buyers = results.cleaned.select("Customer_ID").distinct().count()
    assert segments.count() == segments.select("Customer_ID").distinct().count() == buyers
    assert len(spark.read.text(f"{out}/{pipeline.INSIGHTS}").collect()) == 7
    model = modelling.load_model(f"{out}/models/churn_model")
    assert churn.predicted(model, results.churn.features).count() == buyers
    assert rows_of(segments.select("Cluster").distinct()) == [(0,), (1,), (2,), (3,)]
