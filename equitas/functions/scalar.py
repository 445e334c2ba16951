"""Small scalar column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: probabilities at or above this are predicted positive.
DECISION_THRESHOLD = 0.5


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def linear_score(intercept: float, coefs: dict[str, float]) -> Column:
    """``sigmoid(a + sum(b_j * x_j))`` with literal coefficients."""
    z = F.lit(float(intercept))
    for c, b in coefs.items():
        z = z + F.lit(float(b)) * F.col(f"`{c}`").cast("double")
    return sigmoid(z)


def decide(prob: Column, threshold: float = DECISION_THRESHOLD) -> Column:
    """0/1 prediction from a probability (``>=`` threshold)."""
    return F.when(prob >= F.lit(threshold), 1).otherwise(0)


def safe_ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    """``num / den``, with ``default`` when the denominator is 0 or null."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(default))


def platt(score: Column, a: float, b: float) -> Column:
    """Apply a fitted sigmoid: ``1 / (1 + exp(-(a * s + b)))``."""
    return sigmoid(F.lit(float(a)) * score + F.lit(float(b)))
