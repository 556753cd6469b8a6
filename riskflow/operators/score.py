"""Scoring with several models and letting the most confident decide."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.operators.encode import FEATURES


def with_output_prefix(model: Model, name: str) -> Model:
    """A copy of the model whose output columns start with ``name``."""
    renamed = model.copy()
    for param in ("predictionCol", "probabilityCol", "rawPredictionCol"):
        if renamed.hasParam(param):
            renamed.set(renamed.getParam(param), f"{name}_{param}")
    return renamed


def score(df: DataFrame, models: Mapping[str, Model], features: str = FEATURES) -> DataFrame:
    """Adds ``<name>_positive`` and ``<name>_confidence`` for each model.

    Confidence is the probability of the class the model predicts.  All models
    run over the same row in the same stage; no join brings results together.
    Give it loaded models: a fresh one still holds its training summary.
    """
    for name, model in models.items():
        if not model.hasParam("probabilityCol"):
            raise ValueError(f"{name} has no class probabilities, so it has no confidence")
    columns = list(df.columns)
    for name, model in models.items():
        prediction, probability = f"{name}_predictionCol", f"{name}_probabilityCol"
        scored = with_output_prefix(model, name).setFeaturesCol(features).transform(df)
        df = scored.withColumns(
            {
                f"{name}_positive": F.col(prediction) != 0,
                f"{name}_confidence": F.element_at(
                    vector_to_array(probability), F.col(prediction).cast("int") + 1
                ),
            }
        )
        columns += [f"{name}_positive", f"{name}_confidence"]
    return df.select(*columns)


def score_class(df: DataFrame, name: str, model: Model, features: str = FEATURES) -> DataFrame:
    """Adds ``<name>_positive`` only; for models without probabilities."""
    columns = list(df.columns)
    scored = with_output_prefix(model, name).setFeaturesCol(features).transform(df)
    return scored.withColumn(f"{name}_positive", F.col(f"{name}_predictionCol") != 0).select(
        *columns, f"{name}_positive"
    )


def arbitrate(df: DataFrame, names: Sequence[str], output: str = "positive") -> DataFrame:
    """The verdict of the most confident model; a tie goes to the later one."""
    first, *others = names
    verdict, confidence = F.col(f"{first}_positive"), F.col(f"{first}_confidence")
    for name in others:
        rival, rival_confidence = F.col(f"{name}_positive"), F.col(f"{name}_confidence")
        stays = confidence > rival_confidence
        verdict = F.when(stays, verdict).otherwise(rival)
        confidence = F.when(stays, confidence).otherwise(rival_confidence)
    return df.withColumn(output, verdict)


def arbitrate_joined(
    first: DataFrame, second: DataFrame, names: Sequence[str], key: str, output: str = "positive"
) -> DataFrame:
    """The same for two score tables written by separate jobs, matched by unique key."""
    return arbitrate(first.join(second, key, "inner"), names, output)
