"""Column contracts of the raw input, the topics and the three tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

MIB = 1024 * 1024


def _schema(*columns: tuple[str, DataType, str]) -> StructType:
    fields = []
    for name, kind, comment in columns:
        fields.append(StructField(name, kind, True, {"comment": comment} if comment else {}))
    return StructType(fields)


BIGINT, INT, DOUBLE = LongType(), IntegerType(), DoubleType()
STRING, TIMESTAMP = StringType(), TimestampType()

# Only the columns the cleaning reads; further columns of the files are never decoded.
RAW_TRIPS = _schema(
    ("VendorID", INT, ""),
    ("tpep_pickup_datetime", TimestampNTZType(), ""),
    ("tpep_dropoff_datetime", TimestampNTZType(), ""),
    ("passenger_count", BIGINT, ""),
    ("trip_distance", DOUBLE, ""),
    ("RatecodeID", BIGINT, ""),
    ("payment_type", BIGINT, ""),
    ("fare_amount", DOUBLE, ""),
    ("extra", DOUBLE, ""),
    ("mta_tax", DOUBLE, ""),
    ("tip_amount", DOUBLE, ""),
    ("tolls_amount", DOUBLE, ""),
    ("total_amount", DOUBLE, ""),
)

TRIP_COLUMNS = _schema(
    ("trip_id", BIGINT, "surrogate key"),
    ("vendor_id", INT, "meter provider, 1 or 2"),
    ("pickup_datetime", TIMESTAMP, "meter switched on"),
    ("dropoff_datetime", TIMESTAMP, "meter switched off"),
    ("passenger_count", INT, "riders, as typed in by the driver"),
    ("trip_distance", DOUBLE, "miles on the meter"),
    ("pickup_longitude", DOUBLE, ""),
    ("pickup_latitude", DOUBLE, ""),
    ("dropoff_longitude", DOUBLE, ""),
    ("dropoff_latitude", DOUBLE, ""),
    ("rate_code", INT, "1 standard, 2 JFK, 3 Newark, 4 Nassau, 5 negotiated, 6 group"),
    ("payment_type", INT, "1 credit, 2 cash, 3 no charge, 4 dispute"),
    ("fare_amount", DOUBLE, ""),
    ("extra", DOUBLE, "rush hour and overnight surcharges"),
    ("mta_tax", DOUBLE, ""),
    ("tip_amount", DOUBLE, ""),
    ("tolls_amount", DOUBLE, ""),
    ("total_amount", DOUBLE, ""),
    ("pickup_year", INT, ""),
    ("pickup_month", INT, ""),
    ("pickup_day", INT, ""),
    ("pickup_hour", INT, ""),
)

HOURLY_COLUMNS = _schema(
    ("pickup_year", INT, ""),
    ("pickup_month", INT, ""),
    ("pickup_day", INT, ""),
    ("pickup_hour", INT, ""),
    ("total_trips", BIGINT, ""),
    ("total_passengers", BIGINT, ""),
    ("avg_trip_distance", DOUBLE, ""),
    ("avg_fare_amount", DOUBLE, ""),
    ("avg_tip_amount", DOUBLE, ""),
    ("total_revenue", DOUBLE, ""),
    ("p95_fare", DOUBLE, "95th percentile of the fare"),
    ("computed_at", TIMESTAMP, ""),
)

ANOMALY_COLUMNS = _schema(
    ("event_id", STRING, "unique id of the event"),
    ("detected_at", TIMESTAMP, ""),
    ("anomaly_type", STRING, "surge_fare, low_fare, low_tip, long_idle or outlier_distance"),
    ("severity", STRING, "LOW, MEDIUM or HIGH"),
    ("pickup_datetime", TIMESTAMP, ""),
    ("fare_amount", DOUBLE, ""),
    ("reference_avg", DOUBLE, "expected value at that hour of day"),
    ("z_score", DOUBLE, "distance from the mean in standard deviations"),
    ("event_year", INT, ""),
    ("event_month", INT, ""),
)


@dataclass(frozen=True)
class Table:
    """Name, columns, partitioning and target file size of one table.

    A `versioned` table is replaced as a whole by one change of its location. Its partitions are
    found by listing that folder, for the catalog would keep a location of its own for each.
    """

    name: str
    columns: StructType
    partitions: tuple[str, ...]
    target_file_bytes: int
    versioned: bool = False

    def project(self, df: DataFrame) -> DataFrame:
        """The table's columns by name, in table order and with the table's types.

        Numbers that do not fit raise. A column `df` lacks is NULL.
        """
        return df.to(self.columns)


TRIPS = Table("taxi_trips", TRIP_COLUMNS, ("pickup_year", "pickup_month", "pickup_day"), 128 * MIB)
HOURLY = Table("taxi_hourly_agg", HOURLY_COLUMNS, ("pickup_year", "pickup_month"), 64 * MIB, True)
ANOMALIES = Table("anomaly_events", ANOMALY_COLUMNS, ("event_year", "event_month"), 128 * MIB, True)
TABLES = (TRIPS, HOURLY, ANOMALIES)

TOPICS = ("sensor_data", "market_data", "weather_data")

