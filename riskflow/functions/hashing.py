"""Reproducible stand-ins for random numbers.

They depend on the row alone, so a recomputed task, another partitioning or
another engine gives the same answer.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_PREFIX_DIGITS = 8
_PREFIX_RANGE = 16**_PREFIX_DIGITS


def stable_key(key: str, seed: int) -> Column:
    """A pseudo-random hex string per key, different for each seed."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))


def in_fraction(key: str, fraction: float, seed: int) -> Column:
    """True for about ``fraction`` of all keys."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"fraction must be within [0, 1], not {fraction}")
    if fraction == 1.0:
        return F.lit(True)
    bound = format(math.floor(fraction * _PREFIX_RANGE), f"0{_PREFIX_DIGITS}x")
    return stable_key(key, seed) < F.lit(bound)
