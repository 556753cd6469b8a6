"""Areas under ROC and PR curve (M4)."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row with tp, fp, fn, tn, from one scan; a row without label or prediction is an error."""
    actual, predicted = F.col(label) == 1, F.col(prediction).cast("double") != 0
    cells = {
        "tp": actual & predicted,
        "fp": ~actual & predicted,
        "fn": actual & ~predicted,
        "tn": ~actual & ~predicted,
    }
    gaps = F.count_if(actual.isNull() | predicted.isNull())
    error = F.raise_error(F.concat(gaps.cast("string"), F.lit(f" rows without {label} or {prediction}")))

    def counted(cell: Column) -> Column:
        return F.when(gaps > 0, error.cast("bigint")).otherwise(F.count_if(cell))

    return df.agg(*[counted(cell).alias(name) for name, cell in cells.items()])


def hard_areas(cells: DataFrame) -> DataFrame:
    """``auroc`` and ``auprc`` of hard predictions, from their confusion counts.

    With a 0/1 score both curves are three points, so the areas are closed
    forms.  Without positives both are 0, without negatives both are 1.
    """
    tp, fp, fn, tn = (F.col(name).cast("double") for name in ("tp", "fp", "fn", "tn"))
    positives, negatives = tp + fn, fp + tn
    prevalence = positives / (positives + negatives)
    recall = tp / positives
    precision = F.when(tp + fp == 0, prevalence).otherwise(F.try_divide(tp, tp + fp))
    auroc = (recall + tn / negatives) / 2
    auprc = recall * precision + (1 - recall) * (precision + prevalence) / 2
    def bounded(area):
        return (
            F.when(positives == 0, F.lit(0.0)).when(negatives == 0, F.lit(1.0)).otherwise(area)
        )

    return cells.select(bounded(auroc).alias("auroc"), bounded(auprc).alias("auprc"))


def evaluate_hard(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> dict[str, float]:
    """The areas of the hard class, as numbers."""
    return hard_areas(confusion(df, label, prediction)).first().asDict()


def evaluate_raw(
    df: DataFrame, label: str = "label", raw: str = "rawPrediction"
) -> dict[str, float]:
    """The areas over the model's continuous score."""
    evaluator = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol=raw)
    return {
        "auroc": evaluator.evaluate(df, {evaluator.metricName: "areaUnderROC"}),
        "auprc": evaluator.evaluate(df, {evaluator.metricName: "areaUnderPR"}),
    }
