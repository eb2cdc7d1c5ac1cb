"""spark-submit entry: ``python -m tillroll <folder with the eight CSV files> <result folder>``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tillroll.plans import pipeline
from tillroll.session import SETTINGS
from tillroll.sources.files import read_csv_tables


def main() -> None:
    parser = argparse.ArgumentParser(prog="tillroll", description=pipeline.__doc__)
    parser.add_argument("tables", help="folder with categories.csv ... reviews.csv")
    parser.add_argument("results", help="folder for the results")
    parser.add_argument("--csv", action="store_true", help="write CSV copies of the results too")
    parser.add_argument("--trees", type=int, default=300)
    parser.add_argument("--boosted", action="store_true", help="try gradient-boosted trees too")
    options = parser.parse_args()
    builder = SparkSession.builder.appName("tillroll")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    results = pipeline.run(
        read_csv_tables(spark, options.tables),
        options.results,
        "csv" if options.csv else "parquet",
        options.trees,
        options.boosted,
    )
    results.churn.comparison.show()
    results.sales.comparison.show()
    spark.stop()


if __name__ == "__main__":
    main()
