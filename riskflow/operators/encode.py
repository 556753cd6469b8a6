"""Feature encoding of whole frames, batch or streaming."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions.encoding import feature_sql
from riskflow.operators.validate import drop_incomplete
from riskflow.schema import ID, SERVING_SPEC, TARGET, TRAINING_SPEC, EncodingSpec

FEATURES = "features"


def encode(df: DataFrame, spec: EncodingSpec = SERVING_SPEC, output: str = FEATURES) -> DataFrame:
    """Adds the dense feature vector."""
    values = F.expr(f"array({', '.join(feature_sql(spec))})")
    return df.withColumn(output, array_to_vector(values))


def feature_names(spec: EncodingSpec) -> list[str]:
    return [f"f{i:02d}" for i in range(spec.width)]


def encode_wide(df: DataFrame, keep: list[str], spec: EncodingSpec = SERVING_SPEC) -> DataFrame:
    """``keep`` and one scalar double column per feature (``f00``, ``f01``, ...)."""
    named = [f"{value} AS {name}" for value, name in zip(feature_sql(spec), feature_names(spec))]
    return df.selectExpr(*keep, *named)


def feature_ranges(df: DataFrame, spec: EncodingSpec = SERVING_SPEC) -> DataFrame:
    """One row: smallest and largest value of every feature, from one scan."""
    bounds = [
        f"{bound}({name}) AS {name}_{bound}"
        for name in feature_names(spec)
        for bound in ("min", "max")
    ]
    return encode_wide(df, [], spec).selectExpr(*bounds)


def vector_widths(encoded: DataFrame, features: str = FEATURES) -> DataFrame:
    """One row: number of vectors, shortest and longest width."""
    width = F.size(vector_to_array(features))
    return encoded.agg(
        F.count(features).alias("n"),
        F.min(width).alias("min_width"),
        F.max(width).alias("max_width"),
    )


def labelled_set(df: DataFrame, target: str = TARGET) -> DataFrame:
    """The target as double ``label``, beside the fields it belongs to."""
    return df.withColumn("label", F.col(target).cast("double")).drop(target)


def training_set(
    records: DataFrame,
    spec: EncodingSpec = TRAINING_SPEC,
    target: str = TARGET,
    key: str = ID,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """``key``, ``features``, ``label`` and ``extra`` of the complete records; the key may lack.

    The label travels in its row; nothing is collected or matched by position.
    """
    complete = drop_incomplete(records, [name for name in records.columns if name != key])
    return encode(labelled_set(complete, target), spec).select(key, FEATURES, "label", *extra)
