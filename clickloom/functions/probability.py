"""Probability transforms as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: probabilities are clipped to [CLIP, 1 - CLIP] before the log-odds.
CLIP = 1e-6


def logit(p: Column) -> Column:
    clipped = F.greatest(F.lit(CLIP), F.least(F.lit(1 - CLIP), p))
    return F.log(clipped / (F.lit(1.0) - clipped))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def calibrate_probability(p: Column, slope: float, intercept: float) -> Column:
    """Platt scaling of a raw probability."""
    return sigmoid(F.lit(float(slope)) * logit(p) + F.lit(float(intercept)))


def linear_score(weights: Mapping[str, float], intercept: float) -> Column:
    """Logistic probability of a fixed linear model over feature columns."""
    total = F.lit(float(intercept))
    for name, weight in weights.items():
        total = total + F.lit(float(weight)) * F.col(name)
    return sigmoid(total)
