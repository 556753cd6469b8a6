"""Train/test split by key."""

from __future__ import annotations

from pyspark.sql import DataFrame

from riskflow.functions.hashing import in_fraction
from riskflow.schema import ID, TRAIN_FRACTION


def hash_split(
    df: DataFrame, key: str = ID, fraction: float = TRAIN_FRACTION, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``: the side follows from the key, whatever the partitioning."""
    side = in_fraction(key, fraction, seed)
    return df.where(side), df.where(~side)
