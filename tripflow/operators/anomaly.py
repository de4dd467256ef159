"""Trips that lie far from the mean of their hour of day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.functions.calendar import HOURS_OF_DAY
from tripflow.functions.identity import event_id as make_event_id
from tripflow.functions.scores import (
    SEVERITY_STEPS,
    Z_THRESHOLD,
    deviation,
    fare_type,
    is_anomalous,
    severity,
    z_score,
)
from tripflow.schemas import ANOMALIES


def hour_stats(trips: DataFrame) -> DataFrame:
    """Mean and sample deviation of the fare per hour of day, over all dates: at most 24 rows.

    pickup_hour comes from `hour()`; the range filter states that bound, on which the broadcast
    in `score` rests, and reaches the scan. A NULL hour would match no trip anyway.
    """
    return (
        trips.filter(F.col("pickup_hour").between(*HOURS_OF_DAY))
        .groupBy("pickup_hour")
        .agg(
            F.avg("fare_amount").alias("mean_fare"),
            deviation("fare_amount").alias("std_fare"),
        )
    )


def one_per_hour(stats: DataFrame) -> DataFrame:
    """Given statistics, bounded by the hours of day; an hour found twice raises."""
    repeated = F.raise_error(F.lit("statistics hold an hour of day more than once"))
    once = F.when(F.count(F.lit(1)) > 1, repeated.cast("double"))
    return (
        stats.filter(F.col("pickup_hour").between(*HOURS_OF_DAY))
        .groupBy("pickup_hour")
        .agg(
            F.coalesce(once, F.first("mean_fare")).alias("mean_fare"),
            F.first("std_fare").alias("std_fare"),
        )
    )


def score(trips: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Trips with mean_fare, std_fare and z_score; trips without statistics keep NULLs there.

    The statistics are brought to one row for each hour of day, at most 24, and broadcast: the
    trips are not shuffled. Statistics that hold an hour twice raise.
    """
    stats = hour_stats(trips) if stats is None else one_per_hour(stats)
    scored = trips.join(F.broadcast(stats), "pickup_hour", "left")
    return scored.withColumn(
        "z_score", z_score(F.col("fare_amount"), F.col("mean_fare"), F.col("std_fare"))
    )


def classify(
    scored: DataFrame,
    threshold: float = Z_THRESHOLD,
    steps: tuple[float, float] = SEVERITY_STEPS,
) -> DataFrame:
    """Scored trips beyond the threshold, with type and severity."""
    z = F.col("z_score")
    return scored.filter(is_anomalous(z, threshold)).withColumns(
        {"anomaly_type": fare_type(z, threshold), "severity": severity(z, steps)}
    )


def as_events(classified: DataFrame, event_id: str = "uuid") -> DataFrame:
    """Classified trips in the column order of the anomaly table, stamped with id and time.

    Expects reference_avg beside the trip's own columns.
    """
    stamped = classified.withColumns(
        {
            "event_id": make_event_id(event_id),
            "detected_at": F.current_timestamp(),
            "event_year": F.col("pickup_year"),
            "event_month": F.col("pickup_month"),
        }
    )
    return ANOMALIES.project(stamped)


def detect(
    trips: DataFrame,
    stats: DataFrame | None = None,
    threshold: float = Z_THRESHOLD,
    steps: tuple[float, float] = SEVERITY_STEPS,
    event_id: str = "uuid",
) -> DataFrame:
    """Fare anomalies of `trips`, a batch or a stream.

    A stream needs `stats` given, and frozen (see `tripflow.streaming.detect`).
    """
    classified = classify(score(trips, stats), threshold, steps)
    return as_events(classified.withColumn("reference_avg", F.col("mean_fare")), event_id)
