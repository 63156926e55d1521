"""Guarded ratios, flags and bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The order of the service bands, and their upper ends. The first two ends are outside
# their band, the others inside.
SERVICE_CLASSES = ("very_low", "low", "balanced", "high", "very_high")
SERVICE_LIMITS = (0.25, 0.75, 1.25, 2.5)


def positive_ratio(numerator: Column, denominator: Column) -> Column:
    """n / d where d is positive, else NULL."""
    return F.when(denominator > 0, numerator / denominator)


def is_outlier(z: Column, limit: float = 3.0) -> Column:
    return F.coalesce(F.abs(z) > F.lit(limit), F.lit(False))


def service_class(ratio: Column) -> Column:
    """Five ordered bands of actual over expected trips; a missing ratio has no band."""
    very_low, low, balanced, high, very_high = SERVICE_CLASSES
    ends = SERVICE_LIMITS
    return (
        F.when(ratio < ends[0], very_low)
        .when(ratio < ends[1], low)
        .when(ratio <= ends[2], balanced)
        .when(ratio <= ends[3], high)
        .when(ratio > ends[3], very_high)
    )


def service_rank(name: Column) -> Column:
    """1 … 5 in band order, for sorting."""
    return F.nullif(F.array_position(F.array(*map(F.lit, SERVICE_CLASSES)), name), F.lit(0)).cast("int")
