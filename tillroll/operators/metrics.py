"""Quality of predictions as DataFrames: one pass each, no sampling of scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.numbers import ratio, real
from tillroll.operators import ranking
from tillroll.operators.settle import settled


def _guarded(top, bottom) -> Column:
    """A ratio that is 0 where it is not defined."""
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def confusion_counts(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """True and false positives and negatives in one row; class 1 is positive."""
    truth, said = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(
        F.count_if(truth & said).alias("tp"),
        F.count_if(~truth & said).alias("fp"),
        F.count_if(~truth & ~said).alias("tn"),
        F.count_if(truth & ~said).alias("fn"),
    )


def _precision_recall_f1(hit: str, wrong: str, missed: str) -> tuple[Column, Column, Column]:
    precision = _guarded(hit, F.col(hit) + F.col(wrong))
    recall = _guarded(hit, F.col(hit) + F.col(missed))
    f1 = _guarded(2 * F.col(hit), 2 * F.col(hit) + F.col(wrong) + F.col(missed))
    return precision, recall, f1


def scores_by_value(
    df: DataFrame, label: str = "label", score: str = "score"
) -> DataFrame:
    """Positives and negatives per distinct score, counted once and kept."""
    return settled(
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(real(score).alias("threshold"))
        .agg(
            F.count_if(F.col(label) == 1).alias("_pos"),
            F.count_if(F.col(label) != 1).alias("_neg"),
        )
    )


def roc_points(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
) -> DataFrame:
    """False and true positive rate for every distinct score used as threshold.

    The curve starts at (0, 0), where the threshold is above every score: infinity.
    """
    levels = scores_by_value(df, label, score)
    upto = ranking.running_totals(
        levels,
        [F.desc("threshold")],
        {"tp": F.col("_pos"), "fp": F.col("_neg")},
    )
    positives, negatives = levels.agg(F.sum("_pos")).scalar(), levels.agg(F.sum("_neg")).scalar()
    none = F.lit(0).cast("bigint")
    start = levels.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), none.alias("tp"), none.alias("fp")
    )
    return upto.select("threshold", "tp", "fp").unionByName(start).select(
        "threshold",
        "tp",
        "fp",
        ratio("fp", negatives).alias("fpr"),
        ratio("tp", positives).alias("tpr"),
    )


def roc_auc(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
) -> DataFrame:
    """Chance that a positive outscores a negative, ties counting half: exact, in one row."""
    levels = scores_by_value(df, label, score)
    upto = ranking.running_totals(
        levels, [F.desc("threshold")], {"tp": F.col("_pos")}
    )
    won = F.col("_neg") * (real("tp") - real("_pos") / 2)
    return upto.agg(
        F.sum(won).alias("_won"), F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n")
    ).select(ratio("_won", real("_p") * real("_n")).alias("roc_auc"))


def classification_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", score: str = "score"
) -> DataFrame:
    """Accuracy, precision, recall, F1 and ROC-AUC in one row."""
    precision, recall, f1 = _precision_recall_f1("tp", "fp", "fn")
    everything = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    return confusion_counts(df, label, prediction).select(
        _guarded(F.col("tp") + F.col("tn"), everything).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        roc_auc(df, label, score).scalar().alias("roc_auc"),
    )


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Four rows (actual, predicted, row_count), empty cells with 0."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    rows = [
        F.struct(
            F.lit(actual).alias("actual"),
            F.lit(predicted).alias("predicted"),
            F.col(name).alias("row_count"),
        )
        for actual, predicted, name in cells
    ]
    return confusion_counts(df, label, prediction).select(F.inline(F.array(*rows)))


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both means."""
    zero = _precision_recall_f1("tn", "fn", "fp")
    one = _precision_recall_f1("tp", "fp", "fn")
    counts = confusion_counts(df, label, prediction).select(
        *[c.alias(f"_0{i}") for i, c in enumerate(zero)],
        *[c.alias(f"_1{i}") for i, c in enumerate(one)],
        (F.col("tn") + F.col("fp")).alias("_s0"),
        (F.col("tp") + F.col("fn")).alias("_s1"),
        (F.col("tp") + F.col("tn")).alias("_right"),
    )
    support = F.col("_s0") + F.col("_s1")
    accuracy = _guarded("_right", support)

    def row(name, values, rows):
        cells = [v.alias(n) for v, n in zip(values, ("precision", "recall", "f1"))]
        return F.struct(F.lit(name).alias("class"), *cells, rows.alias("support"))

    macro = [(F.col(f"_0{i}") + F.col(f"_1{i}")) / 2 for i in range(3)]
    weighted = [
        _guarded(F.col(f"_0{i}") * F.col("_s0") + F.col(f"_1{i}") * F.col("_s1"), support)
        for i in range(3)
    ]
    return counts.select(
        F.inline(
            F.array(
                row("0", [F.col(f"_0{i}") for i in range(3)], F.col("_s0")),
                row("1", [F.col(f"_1{i}") for i in range(3)], F.col("_s1")),
                row("accuracy", [accuracy] * 3, support),
                row("macro avg", macro, support),
                row("weighted avg", weighted, support),
            )
        )
    )


def regression_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """MAE, RMSE and R2 in one row."""
    error = real(label) - real(prediction)
    return df.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("_mse"),
        F.var_pop(F.when(error.isNotNull(), real(label))).alias("_variance"),
    ).select(
        "mae",
        F.sqrt("_mse").alias("rmse"),
        (F.lit(1.0) - ratio("_mse", "_variance")).alias("r2"),
    )
