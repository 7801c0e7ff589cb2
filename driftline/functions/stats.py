"""Normal-test expressions."""

from __future__ import annotations

import math
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import as_column

# Numerical Recipes' rational approximation of erfc (relative error 1.2e-7),
# polynomial in t from the constant term up.
ERFC_POLYNOMIAL = (
    -1.26551223,
    1.00002368,
    0.37409196,
    0.09678418,
    -0.18628806,
    0.27886807,
    -1.13520398,
    1.48851587,
    -0.82215223,
    0.17087277,
)


def two_sided_p(z: str | Column) -> Column:
    """Two-sided normal p-value, as a native expression."""
    x = F.abs(as_column(z)) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + x * 0.5)
    series = reduce(
        lambda acc, coefficient: acc * t + F.lit(coefficient),
        reversed(ERFC_POLYNOMIAL[:-1]),
        F.lit(ERFC_POLYNOMIAL[-1]),
    )
    return F.least(F.lit(1.0), t * F.exp(series - x * x))


def critical_z(alpha: float) -> float:
    """|z| beyond which the two-sided p-value is below alpha."""
    if alpha <= 0:
        return math.inf
    if alpha > 1:
        return -1.0
    return NormalDist().inv_cdf(1 - alpha / 2) if alpha < 1 else 0.0


def z_score(batch_mean: Column, mean: Column, std: Column, n: Column) -> Column:
    return (batch_mean - mean) / (std / F.sqrt(n.cast("double")))
