from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from riskflow.operators.metrics import confusion, evaluate_hard, evaluate_raw


def frame(spark, tp, fp, fn, tn):
    rows = [(1.0, 1.0)] * tp + [(0.0, 1.0)] * fp + [(1.0, 0.0)] * fn + [(0.0, 0.0)] * tn
    return spark.createDataFrame(rows, "label double, prediction double")


@pytest.mark.parametrize(
    "cells",
    [
        (3, 2, 1, 7),
        (1, 0, 0, 1),
        (0, 0, 4, 6),  # nothing predicted positive
        (4, 6, 0, 0),  # everything predicted positive
        (0, 3, 0, 5),  # no positives
        (3, 0, 5, 0),  # no negatives
        (0, 5, 3, 2),  # no hit
        (50, 1, 7, 900),
    ],
)
def test_closed_forms_equal_the_evaluator(spark, cells):
    df = frame(spark, *cells)
    assert tuple(confusion(df).first()) == cells
    assert evaluate_hard(df) == pytest.approx(evaluate_raw(df, raw="prediction"), abs=1e-12)


def test_boolean_predictions(spark):
    df = frame(spark, 3, 2, 1, 7).selectExpr("label", "prediction = 1 as prediction")
    assert tuple(confusion(df).first()) == (3, 2, 1, 7)


@pytest.mark.parametrize("row", [(None, 1.0), (1.0, None)])
def test_gaps_are_an_error(spark, row):
    df = spark.createDataFrame([(1.0, 1.0), row], "label double, prediction double")
    with pytest.raises(PySparkException, match="1 rows without label or prediction"):
        confusion(df).collect()


def test_no_rows(spark):
    assert tuple(confusion(frame(spark, 0, 0, 0, 0)).first()) == (0, 0, 0, 0)
