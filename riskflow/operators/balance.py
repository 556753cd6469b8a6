"""Class balance and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_positive(label: str = "label") -> Column:
    return F.col(label) == 1


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: records in all, and positive ones."""
    return df.agg(
        F.count("*").alias("n_all"),
        F.count(F.when(is_positive(label), F.lit(1))).alias("n_positive"),
    )


def with_class_weights(df: DataFrame, label: str = "label", output: str = "weights") -> DataFrame:
    """Adds the weight: all/positive for positive records, 1 for the others.

    The quotient is a scalar subquery over the label column alone, so the
    frame stays lazy and is not joined with anything.
    """
    ratio = (
        class_balance(df, label)
        .select(F.try_divide(F.col("n_all").cast("double"), F.col("n_positive").cast("double")))
        .scalar()
    )
    return df.withColumn(output, F.when(is_positive(label), ratio).otherwise(F.lit(1.0)))
