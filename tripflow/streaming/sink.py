"""Topic streams into hour-partitioned Parquet files, exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType

from tripflow.functions.calendar import path_columns
from tripflow.session import settings
from tripflow.tables.write import distribute, write_settings

# When a file is closed and a new one begun.
ROLL_ROWS = 10000
ROLL_WALL_CLOCK = "10 minutes"
ROLL_EVENT_SECONDS = 300
PART_BYTES = 67108864
INGESTION_TIME = "kafka_ingestion_time"
BUCKETS = ("topic", "year", "month", "day", "hour")


def _event_time(records: DataFrame, field: str) -> Column:
    """The record's own time: a timestamp, text, or milliseconds since 1970.

    A record without one fails the query, and the message shows the record.
    """
    if isinstance(records.schema[field].dataType, LongType):
        found = F.timestamp_millis(field)
    else:
        found = F.try_to_timestamp(field)
    message = F.concat(F.lit("record without event time: "), F.to_json(F.struct("*")))
    return F.when(found.isNotNull(), found).otherwise(F.raise_error(message).cast("timestamp"))


def bucket(
    records: DataFrame, event_time: str = "timestamp", roll_event_seconds: int | None = None
) -> DataFrame:
    """Records with their hour bucket and, where the source gave none, an ingestion time.

    A late record gets the bucket of its own event time. `roll_event_seconds` adds the column
    `slot`, which keeps records further apart than that in different files.
    """
    timed = records.withColumn(event_time, _event_time(records, event_time))
    if INGESTION_TIME not in records.columns:
        timed = timed.withColumn(INGESTION_TIME, F.current_timestamp())
    timed = timed.withColumns(path_columns(event_time))
    if roll_event_seconds:
        slot = F.floor(F.unix_seconds(event_time) % 3600 / roll_event_seconds).cast("int")
        timed = timed.withColumn("slot", slot)
    return timed


def time_partitioned_sink(
    records: DataFrame,
    path: str,
    checkpoint: str,
    event_time: str = "timestamp",
    roll_rows: int = ROLL_ROWS,
    roll_event_seconds: int | None = None,
    every: str | None = ROLL_WALL_CLOCK,
    file_bytes: int | None = None,
) -> StreamingQuery:
    """Write `records` to topic=/year=/month=/day=/hour= folders below `path`.

    The rows of a bucket meet in one task, or several where a busy topic or hour exceeds the part
    size, so a backfill over many hours does not leave a file per task and hour. `file_bytes` sizes
    files by bytes in place of rows, which keeps their number, and the sink's log, small where
    topics are busy. `every=None` takes what is there and stops. The sink's log and the checkpoint make a rerun add nothing
    twice.
    """
    folders = [*BUCKETS, "slot"] if roll_event_seconds else list(BUCKETS)
    rows = distribute(bucket(records, event_time, roll_event_seconds), folders)
    writer = (
        rows.writeStream.format("parquet")
        .partitionBy(*folders)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", 0 if file_bytes else roll_rows)
        .option("compression", "snappy")
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    # A query keeps the session settings it was started with.
    with settings(records.sparkSession, write_settings(file_bytes or PART_BYTES)):
        return writer.trigger(**trigger).start()
