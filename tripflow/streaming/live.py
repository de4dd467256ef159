"""Scoring a stream of trips against statistics that follow it.

The statistics per hour of day are kept as mergeable moments, 24 rows at most, one version for each
batch. A batch is scored against the version before it, by a broadcast of these rows, and its own
moments, combined in the scan tasks, make the next version: trips are never shuffled, so an hour of
day with a third of them is no larger a task than another. A batch that runs again finds the same
version before it, and so gives the same events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tripflow.functions.calendar import HOURS_OF_DAY
from tripflow.functions.moments import deviation_of, merged_moments, moment_names, moments
from tripflow.operators.anomaly import detect
from tripflow.schemas import ANOMALIES
from tripflow.streaming.intake import append_stream
from tripflow.tables.catalog import NAMESPACE
from tripflow.tables.versions import Versions

HOUR = "pickup_hour"
FARE = "fare"
_SCHEMA = (
    "pickup_hour int, fare_count bigint, fare_mean double, fare_squares double, "
    "fare_low double, fare_high double"
)
#: Versions kept: the last, the one before it, which a repeated batch needs, and one for readers.
KEPT = 3


def hour_moments(trips: DataFrame) -> DataFrame:
    """Moments of the fare for each hour of day of `trips`."""
    known = trips.where(F.col(HOUR).between(*HOURS_OF_DAY))
    return known.groupBy(HOUR).agg(*moments("fare_amount", FARE))


def stats_of(held: DataFrame) -> DataFrame:
    """pickup_hour, mean_fare, std_fare out of moments."""
    return held.select(HOUR, F.col("fare_mean").alias("mean_fare"), deviation_of(FARE).alias("std_fare"))


class LiveStatistics:
    """The moments after each batch, below `root`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.versions = spark, Versions(spark, root)

    def read(self, before: int | None = None) -> DataFrame:
        """The moments after the last batch, or the last one before batch `before`."""
        number = self.versions.last(before)
        if number is None:
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).parquet(self.versions.path(number))

    def begin(self, history: DataFrame) -> None:
        """Start from trips of the past, as if they had been a batch before the first."""
        self._write(hour_moments(history), -1)

    def add(self, batch: DataFrame, number: int) -> None:
        """The version after batch `number`."""
        both = self.read(number).unionByName(hour_moments(batch))
        self._write(merged_moments(both, [HOUR], FARE), number)
        self.versions.prune(KEPT)

    def _write(self, rows: DataFrame, number: int) -> None:
        self.versions.write(rows.select(HOUR, *moment_names(FARE)).coalesce(1), number)


def detect_live(
    trips: DataFrame,
    checkpoint: str,
    namespace: str = NAMESPACE,
    every: str | None = None,
    history: DataFrame | None = None,
) -> StreamingQuery:
    """Append the fare anomalies of a trips stream, scored against all batches before their own.

    Trips of an hour of day without statistics yet give no event; `history` are trips to start
    from, read at the first start only. Event ids derive from the trip, so trip_id has to be stable.
    """
    root = f"{checkpoint.rstrip('/')}/statistics"
    statistics = LiveStatistics(trips.sparkSession, root)
    if history is not None and statistics.versions.last() is None:
        statistics.begin(history)

    def score(batch: DataFrame, number: int) -> DataFrame:
        held = LiveStatistics(batch.sparkSession, root)
        held.add(batch, number)
        return detect(batch, stats_of(held.read(number)), event_id="hash")

    table = f"{namespace}.{ANOMALIES.name}"
    return append_stream(trips, table, "event_id", checkpoint, every, score)
