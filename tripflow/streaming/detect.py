"""Scoring a stream of trips against fixed statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tripflow.operators.anomaly import detect, hour_stats
from tripflow.schemas import ANOMALIES
from tripflow.session import durable
from tripflow.streaming.intake import append_stream
from tripflow.tables.catalog import NAMESPACE


def freeze_stats(trips: DataFrame) -> DataFrame:
    """The hour statistics computed once and kept.

    A stream joins its static side anew in every batch; without this, each batch would aggregate
    the whole trips table.
    """
    return durable(hour_stats(trips), "hour-stats")


def detect_stream(
    trips: DataFrame,
    stats: DataFrame,
    checkpoint: str,
    namespace: str = NAMESPACE,
    every: str | None = None,
) -> StreamingQuery:
    """Append the fare anomalies of a trips stream to the anomaly table.

    Event ids derive from the trip, so trip_id has to be stable.
    """
    events = detect(trips, stats, event_id="hash")
    return append_stream(events, f"{namespace}.{ANOMALIES.name}", "event_id", checkpoint, every)
