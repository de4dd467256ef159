"""Trips per calendar hour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripflow.functions.calendar import HOURS_OF_DAY
from tripflow.functions.scores import flat
from tripflow.operators.quantile import exact_quantile
from tripflow.schemas import HOURLY

HOUR_KEYS = ("pickup_year", "pickup_month", "pickup_day", "pickup_hour")
P95 = "0.95"


# Number, mean, sum of squared deviations, least and greatest of an hour's fares.
MOMENTS = ("fare_count", "fare_mean", "fare_squares", "fare_low", "fare_high")


def hourly(trips: DataFrame, p95: str = "approx", moments: bool = False) -> DataFrame:
    """Counts, averages, revenue and 95th percentile fare of each hour.

    Every aggregate is pre-combined in the scan tasks, so the shuffle carries one row per task and
    hour whatever the share of the largest hour. `p95="approx"` uses the mergeable sketch,
    `p95="exact"` adds the distributed exact selection. `moments` adds the columns from which
    `hour_stats_from` derives the statistics per hour of day without another scan of the trips.
    """
    aggregates = {
        "total_trips": F.count(F.lit(1)),
        "total_passengers": F.sum("passenger_count"),
        "avg_trip_distance": F.round(F.avg("trip_distance"), 3),
        "avg_fare_amount": F.round(F.avg("fare_amount"), 2),
        "avg_tip_amount": F.round(F.avg("tip_amount"), 2),
        "total_revenue": F.round(F.sum("total_amount"), 2),
    }
    if p95 == "approx":
        aggregates["p95_fare"] = F.round(F.percentile_approx("fare_amount", float(P95)), 2)
    elif p95 != "exact":
        raise ValueError(f"unknown percentile mode {p95!r}")
    if moments:
        fares = F.count("fare_amount")
        aggregates["fare_count"] = fares
        aggregates["fare_mean"] = F.avg("fare_amount")
        aggregates["fare_squares"] = F.var_pop("fare_amount") * fares
        aggregates["fare_low"] = F.min("fare_amount")
        aggregates["fare_high"] = F.max("fare_amount")

    grouped = trips.groupBy(*HOUR_KEYS).agg(*[c.alias(n) for n, c in aggregates.items()])
    if p95 == "exact":
        fares = exact_quantile(trips, HOUR_KEYS, "fare_amount", P95, "p95_fare")
        fares = fares.withColumn("p95_fare", F.round("p95_fare", 2))
        grouped = grouped.join(fares, list(HOUR_KEYS), "left")
    stamped = grouped.withColumn("computed_at", F.current_timestamp())
    if moments:
        return stamped.select(*HOURLY.columns.names, *MOMENTS)
    return HOURLY.project(stamped)


def hour_stats_from(hours: DataFrame) -> DataFrame:
    """Mean and sample deviation of the fare per hour of day, merged from the hours' moments.

    Works on one row per calendar hour, so the window below holds one row per day. At most 24
    rows come out.
    """
    hours = hours.filter(F.col("pickup_hour").between(*HOURS_OF_DAY) & (F.col("fare_count") > 0))
    mean = F.sum(F.col("fare_count") * F.col("fare_mean")).over(W.partitionBy("pickup_hour"))
    count = F.sum("fare_count").over(W.partitionBy("pickup_hour"))
    shifted = hours.withColumn("shift", F.col("fare_mean") - mean / count)
    total = F.sum("fare_count")
    squares = F.sum(F.col("fare_squares") + F.col("fare_count") * F.pow("shift", F.lit(2)))
    same = flat(F.min("fare_low"), F.max("fare_high"), total)
    spread = F.when(same, F.lit(0.0)).otherwise(F.sqrt(F.try_divide(squares, total - 1)))
    return shifted.groupBy("pickup_hour").agg(
        (F.sum(F.col("fare_count") * F.col("fare_mean")) / total).alias("mean_fare"),
        spread.alias("std_fare"),
    )
