"""Calendar parts of a timestamp, as integers for tables and as text for file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The range of an hour of day.
HOURS_OF_DAY = (0, 23)


def calendar_columns(ts: str, prefix: str) -> dict[str, Column]:
    """`<prefix>_year`, `_month`, `_day` and `_hour` of the timestamp column `ts`."""
    return {
        f"{prefix}_year": F.year(ts),
        f"{prefix}_month": F.month(ts),
        f"{prefix}_day": F.dayofmonth(ts),
        f"{prefix}_hour": F.hour(ts),
    }


def path_columns(ts: str) -> dict[str, Column]:
    """Zero-padded `year`, `month`, `day` and `hour` for hour-partitioned paths."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
        "hour": F.date_format(ts, "HH"),
    }
