"""Raw trips to cleaned, enriched trips in the column order of the trips table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.calendar import calendar_columns
from tripflow.schemas import TRIPS

# Raw columns that only change their name.
RENAMED = {"VendorID": "vendor_id", "RatecodeID": "rate_code"}
# The accepted range of riders, both ends included.
RIDERS = (1, 8)


def usable(raw: DataFrame, nan: str = "keep") -> DataFrame:
    """Rows with a positive fare and distance and an accepted number of riders.

    NULLs fail each test. NaN sorts above every number and so passes the first two; `nan="drop"`
    removes it there.
    """
    positive = [F.col(name) > 0 for name in ("fare_amount", "trip_distance")]
    if nan == "drop":
        positive += [~F.isnan(name) for name in ("fare_amount", "trip_distance")]
    elif nan != "keep":
        raise ValueError(f"unknown NaN policy {nan!r}")
    kept = raw.filter(F.col("passenger_count").between(*RIDERS))
    for test in positive:
        kept = kept.filter(test)
    return kept


def clean(raw: DataFrame, trip_id: Column | None = None, nan: str = "keep") -> DataFrame:
    """Filter, convert and project raw trips; one narrow pass without a shuffle.

    `trip_id` is an expression over the raw columns. The default numbers the surviving rows per
    task; such ids start anew with every run and are not allowed on streams, see
    `tripflow.functions.identity` for stable ones.
    """
    stamped = (
        usable(raw, nan)
        .withColumns(
            {
                "pickup_datetime": F.try_to_timestamp("tpep_pickup_datetime"),
                "dropoff_datetime": F.try_to_timestamp("tpep_dropoff_datetime"),
            }
        )
        .filter(F.col("pickup_datetime").isNotNull())
    )
    numbered = stamped.withColumn(
        "trip_id", F.monotonically_increasing_id() if trip_id is None else trip_id
    )
    enriched = numbered.withColumns(calendar_columns("pickup_datetime", "pickup"))
    # The files no longer carry coordinates; those four columns come out NULL.
    return TRIPS.project(enriched.withColumnsRenamed(RENAMED))
