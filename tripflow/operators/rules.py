"""Anomaly rules beyond the fare: the declared types low_tip, outlier_distance and long_idle.

Their formulas are this library's own. Each is a z-score against the trip's hour of day:
low_tip - the tip lies below the threshold; outlier_distance - the distance lies beyond it on
either side; long_idle - the time since the vendor's previous drop-off lies above it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripflow.functions.calendar import HOURS_OF_DAY
from tripflow.functions.scores import (
    LONG_IDLE,
    LOW_TIP,
    OUTLIER_DISTANCE,
    SEVERITY_STEPS,
    Z_THRESHOLD,
    deviation,
    severity,
    z_score,
)
from tripflow.operators.anomaly import as_events
from tripflow.operators.blocks import ordered_blocks
from tripflow.session import durable

TRIP_ORDER = ("vendor_id", "pickup_datetime", "trip_id")
# What every event takes from its trip.
EVENT_INPUT = (
    "trip_id",
    "pickup_datetime",
    "fare_amount",
    "pickup_year",
    "pickup_month",
    "pickup_hour",
)


@dataclass(frozen=True)
class Rule:
    """A measured column, what it is made of, and the side of its z-score that counts."""

    measure: str
    inputs: tuple[str, ...]
    flags: Callable[[Column, float], Column]


RULES = {
    LOW_TIP: Rule("tip_amount", ("tip_amount",), lambda z, limit: z < -limit),
    OUTLIER_DISTANCE: Rule(
        "trip_distance", ("trip_distance",), lambda z, limit: F.abs(z) > limit
    ),
    LONG_IDLE: Rule(
        "idle_seconds", ("vendor_id", "dropoff_datetime"), lambda z, limit: z > limit
    ),
}


def idle_gaps(trips: DataFrame, blocks: int | None = None) -> DataFrame:
    """Trips with idle_seconds, the time from the vendor's previous drop-off to this pickup.

    "Previous" is by pickup time and trip id. There are only a few vendors, so the order is cut
    into blocks; the last drop-off of a vendor's block enters the vendor's next block as an extra
    first row. All columns given are written out once, so give only what is needed.
    """
    ordered = ordered_blocks(trips, TRIP_ORDER, blocks)
    last = F.max_by("dropoff_datetime", F.struct("pickup_datetime", "trip_id"))
    # At most one row per block for each vendor in it.
    lasts = ordered.groupBy("vendor_id", "block").agg(last.alias("dropoff_datetime"))
    following = F.lead("block").over(W.partitionBy("vendor_id").orderBy("block"))
    carried = (
        lasts.withColumn("block", following)
        .filter(F.col("block").isNotNull())
        .withColumn("carried", F.lit(True))
    )
    rows = ordered.withColumn("carried", F.lit(False)).unionByName(
        carried, allowMissingColumns=True
    )
    along = W.partitionBy("vendor_id", "block").orderBy(
        F.col("carried").desc(), "pickup_datetime", "trip_id"
    )
    gap = F.col("pickup_datetime").cast("double") - F.col("previous").cast("double")
    return (
        rows.withColumn("previous", F.lag("dropoff_datetime").over(along))
        .filter(~F.col("carried"))
        .withColumn("idle_seconds", gap)
        .drop("previous", "carried", "block")
    )


def detect_rules(
    trips: DataFrame,
    rules: Sequence[str] = tuple(RULES),
    threshold: float = Z_THRESHOLD,
    steps: tuple[float, float] = SEVERITY_STEPS,
    event_id: str = "uuid",
    blocks: int | None = None,
) -> DataFrame:
    """Events of all `rules`, from one pass for the statistics and one for the scores.

    The broadcast side has one row per hour of day, at most 24.
    """
    inputs = {column for name in rules for column in RULES[name].inputs} - set(EVENT_INPUT)
    measured = trips.select(*EVENT_INPUT, *sorted(inputs))
    if LONG_IDLE in rules:
        # Statistics and scores read the gaps; they are worked out once.
        measured = durable(idle_gaps(measured, blocks), "gaps")
    statistics = []
    for name in rules:
        measure = RULES[name].measure
        statistics.append(F.avg(measure).alias(f"{name}_mean"))
        statistics.append(deviation(measure).alias(f"{name}_deviation"))
    stats = (
        measured.filter(F.col("pickup_hour").between(*HOURS_OF_DAY))
        .groupBy("pickup_hour")
        .agg(*statistics)
    )

    scored = measured.join(F.broadcast(stats), "pickup_hour", "left")
    findings = []
    for name in rules:
        mean, spread = F.col(f"{name}_mean"), F.col(f"{name}_deviation")
        z = z_score(F.col(RULES[name].measure), mean, spread)
        finding = F.struct(
            F.lit(name).alias("anomaly_type"), z.alias("z_score"), mean.alias("reference_avg")
        )
        findings.append(F.when(RULES[name].flags(z, threshold), finding))
    found = scored.withColumn("finding", F.explode(F.array_compact(F.array(*findings))))
    events = found.select("*", "finding.*").withColumn("severity", severity(F.col("z_score"), steps))
    return as_events(events, event_id)
