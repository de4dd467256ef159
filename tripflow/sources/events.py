"""Raw trips and topic records derived from a generic `events` table.

Columns of `events`: event_id, ts, user_id, event_type, value, props (JSON with a number `k`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Payment code and topic per event type.
PAYMENT_CODES = {"purchase": 1, "click": 2, "view": 3, "error": 4}
TOPIC_OF = {
    "click": "sensor_data",
    "view": "sensor_data",
    "purchase": "market_data",
    "error": "weather_data",
    "signup": "weather_data",
}


def _lookup(column: str, table: dict) -> str:
    """SQL for the value `table` gives to `column`."""
    cases = " ".join(f"WHEN {key!r} THEN {value!r}" for key, value in table.items())
    return f"CASE {column} {cases} END"


def raw_trips(events: DataFrame) -> DataFrame:
    """One raw trip per event; event_id stays for ids."""
    parsed = events.withColumn("k", F.expr("CAST(get_json_object(props, '$.k') AS INT)"))
    return parsed.selectExpr(
        "event_id",
        "CAST(user_id % 2 + 1 AS INT) AS VendorID",
        "ts AS tpep_pickup_datetime",
        "ts + make_dt_interval(0, 0, k) AS tpep_dropoff_datetime",
        "user_id % 10 AS passenger_count",
        "CAST(k AS DOUBLE) AS trip_distance",
        "user_id % 6 + 1 AS RatecodeID",
        f"CAST({_lookup('event_type', PAYMENT_CODES)} AS BIGINT) AS payment_type",
        "value AS fare_amount",
        "0D AS extra",
        "0.5D AS mta_tax",
        "value * 0.125D AS tip_amount",
        "0D AS tolls_amount",
        "value + 0D + 0.5D + value * 0.125D + 0D AS total_amount",
    )


def topic_records(events: DataFrame) -> DataFrame:
    """One topic record per event: topic, timestamp, key, value, props."""
    return events.selectExpr(
        f"{_lookup('event_type', TOPIC_OF)} AS topic",
        "to_timestamp(ts) AS timestamp",
        "user_id AS key",
        "value",
        "props",
    )
