"""Streams into catalog tables, each source row once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripflow.functions.identity import source_row_id
from tripflow.operators.clean import clean
from tripflow.schemas import TRIPS
from tripflow.sources.raw import stream_raw
from tripflow.tables.catalog import NAMESPACE
from tripflow.tables.files import Files
from tripflow.tables.write import append, append_once


def unfinished_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """The batch that was begun but not finished when the stream last stopped."""
    files = Files(spark, checkpoint)
    begun, done = (
        max((int(n) for n in files.names(f"{checkpoint}/{log}") if n.isdigit()), default=-1)
        for log in ("offsets", "commits")
    )
    return begun if begun > done else None


def append_stream(
    rows: DataFrame,
    table: str,
    key: str,
    checkpoint: str,
    every: str | None = None,
    each: Callable[[DataFrame, int], DataFrame] | None = None,
) -> StreamingQuery:
    """Append a stream to a catalog table; `key` identifies a row and is the same on a retry.

    A batch may run again after a crash. Only for that batch, the first of a restart, rows that
    the table already holds are left out; all others are appended without looking. `each` makes
    the rows to append out of a batch and its number, and gives the same when it is run again.
    """
    session = rows.sparkSession
    repeated = unfinished_batch(session, checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        if each:
            batch = each(batch, number)
        if number == repeated:
            append_once(batch, table, key)
        else:
            append(batch, table)
        # Batches run in a copy of the session; the caller's own would keep its old file list.
        session.catalog.refreshTable(table)

    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def ingest_new_files(
    spark: SparkSession,
    raw_path: str,
    checkpoint: str,
    namespace: str = NAMESPACE,
    files_per_batch: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Clean raw files that arrived since the last run and append them to the trips table."""
    raw = stream_raw(spark, raw_path, files_per_batch=files_per_batch)
    trips = clean(raw, trip_id=source_row_id())
    return append_stream(trips, f"{namespace}.{TRIPS.name}", "trip_id", checkpoint, every)
