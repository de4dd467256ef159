"""Z-scores and what they mean."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds and labels that results are compared by.
Z_THRESHOLD = 3.0
SEVERITY_STEPS = (4.0, 6.0)
SURGE_FARE = "surge_fare"
LOW_FARE = "low_fare"
OUTLIER_DISTANCE = "outlier_distance"
LOW_TIP = "low_tip"
LONG_IDLE = "long_idle"


def flat(low: Column, high: Column, count: Column) -> Column:
    """Whether several values are all the same number, going by the least and the greatest."""
    return (low == high) & ~F.isnan(low) & (count > 1)


def deviation(value: str) -> Column:
    """Sample deviation, as an aggregate.

    Exactly 0 for equal values: merging the partial results of several tasks can leave a trace of
    rounding there, and dividing by it would make scores out of nothing.
    """
    same = flat(F.min(value), F.max(value), F.count(value))
    return F.when(same, F.lit(0.0)).otherwise(F.stddev_samp(value))


def z_score(value: Column, mean: Column, deviation: Column) -> Column:
    """(value - mean) / deviation; NULL where the deviation is 0 or NULL, never an error."""
    return F.try_divide(value - mean, deviation)


def is_anomalous(z: Column, threshold: float = Z_THRESHOLD) -> Column:
    """Strictly beyond the threshold on either side; NULL does not pass, NaN does."""
    return F.abs(z) > F.lit(threshold)


def fare_type(z: Column, threshold: float = Z_THRESHOLD) -> Column:
    return (
        F.when(z > threshold, SURGE_FARE)
        .when(z < -threshold, LOW_FARE)
        .otherwise(OUTLIER_DISTANCE)
    )


def severity(z: Column, steps: tuple[float, float] = SEVERITY_STEPS) -> Column:
    medium, high = steps
    size = F.abs(z)
    return F.when(size > high, "HIGH").when(size > medium, "MEDIUM").otherwise("LOW")
