"""The jobs: create, ingest, aggregate, maintain. Each reports row counts per stage."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.identity import FILE_SHIFT, source_row_id, with_file_ids
from tripflow.functions.scores import LOW_FARE, SURGE_FARE
from tripflow.operators.anomaly import detect
from tripflow.operators.clean import clean
from tripflow.operators.hourly import HOUR_KEYS, hour_stats_from, hourly
from tripflow.operators.hourly_state import HourStates, hourly_from
from tripflow.operators.rules import detect_rules
from tripflow.schemas import ANOMALIES, HOURLY, TRIPS
from tripflow.session import durable
from tripflow.sources.mixed import PATH, PLACE, read_mixed
from tripflow.tables.catalog import NAMESPACE, read_table, versions_root
from tripflow.tables.compact import MIN_INPUT_FILES, TARGET_FILE_BYTES, compact
from tripflow.tables.write import append, append_once, overwrite_partitions, replace

MODES = ("append", "overwrite_partitions")
#: How trips are numbered: per task, by file and place (unique over all runs of ingest), or by a
#: hash of both (the same when a file is taken again).
IDS = ("task", "file", "source")


def row_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """One row per stage: stage, rows. Counting stored tables reads only their file footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(stage).alias("stage"), "rows")
        for stage, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def ingest(
    spark: SparkSession,
    raw: str | DataFrame,
    namespace: str = NAMESPACE,
    trip_id: Column | None = None,
    nan: str = "keep",
    mode: str = "append",
    ids: str = "task",
) -> DataFrame:
    """Clean raw trips (a path or a DataFrame) into the trips table.

    The files of a path may differ in the types of their columns. `mode` "overwrite_partitions" replaces trips by their id, so it needs ids that are the same on
    a rerun: a `trip_id` of the caller's, or `ids` "source".
    """
    source = {"path": PATH, "place": PLACE} if isinstance(raw, str) else {}
    rows = read_mixed(spark, raw) if isinstance(raw, str) else raw
    table = f"{namespace}.{TRIPS.name}"
    if trip_id is None and ids == "file":
        spark.catalog.refreshTable(table)
        last = spark.table(table).agg(F.max("trip_id")).first()[0]
        rows = with_file_ids(rows, "trip_id", 0 if last is None else (last >> FILE_SHIFT) + 1, **source)
        trip_id = F.col("trip_id")
    elif trip_id is None and ids == "source":
        trip_id = source_row_id(**source)
    cleaned = clean(rows, trip_id, nan)
    if mode == "overwrite_partitions":
        if trip_id is None or ids == "file":
            raise ValueError("overwriting needs ids that are the same on a rerun")
        overwrite_partitions(cleaned, table, "trip_id")
    else:
        append(cleaned, table)
    return row_counts({"raw": rows, "trips": spark.table(table)})


def aggregate(
    spark: SparkSession,
    namespace: str = NAMESPACE,
    p95: str = "approx",
    event_id: str = "uuid",
    mode: str = "append",
    rules: Sequence[str] = (),
) -> DataFrame:
    """Replace the hourly table and add the fare anomalies, and those of `rules`.

    The trips are scanned twice: once for the hours, whose moments also give the statistics per
    hour of day, and once for the scores. As all trips are read, mode "overwrite_partitions" puts
    the new events in place of all earlier ones of the same types, also where there are none now.
    """
    trips = read_table(spark, TRIPS, namespace)
    hours = replace(hourly(trips, p95, moments=True), f"{namespace}.{HOURLY.name}")
    events = detect(trips, hour_stats_from(hours), event_id=event_id)
    if rules:
        events = events.unionByName(detect_rules(trips, rules, event_id=event_id))
    table = f"{namespace}.{ANOMALIES.name}"
    if mode == "overwrite_partitions":
        held = read_table(spark, ANOMALIES, namespace)
        others = held.where(~F.col("anomaly_type").isin(SURGE_FARE, LOW_FARE, *rules))
        replace(events.unionByName(others), table)
    else:
        append(events, table)
    return report(spark, namespace)


def hour_states(spark: SparkSession, namespace: str = NAMESPACE) -> HourStates:
    """The states behind the hourly table, beside its versions."""
    root = versions_root(spark, f"{namespace}.{HOURLY.name}")
    if root is None:
        raise ValueError("the hourly table was made without versions; create it anew")
    return HourStates(spark, f"{root.rsplit('/', 1)[0]}/_states")


def update_hourly(
    spark: SparkSession, trips: DataFrame, number: int, namespace: str = NAMESPACE
) -> None:
    """Add delivery `number` of cleaned trips to the hourly table.

    Reads the delivery and the states of its months; earlier trips are not read. The same number
    again replaces the earlier try. The table itself, a row for each hour there ever was, is written
    anew and put in place at once.
    """
    table, keys = f"{namespace}.{HOURLY.name}", list(HOUR_KEYS)
    states = hour_states(spark, namespace)
    changed = durable(states.add(trips, number), "hours")
    others = read_table(spark, HOURLY, namespace).join(changed.select(*keys), keys, "left_anti")
    replace(others.unionByName(hourly_from(changed)), table)
    states.fold()


def deliver(
    spark: SparkSession,
    raw: str | DataFrame,
    number: int,
    namespace: str = NAMESPACE,
    trip_id: Column | None = None,
    nan: str = "keep",
) -> DataFrame:
    """Add delivery `number` of raw trips (a path or a DataFrame) to trips and hours, once.

    Trips need ids that are the same on a retry: `trip_id`, or file and place.
    """
    source = {"path": PATH, "place": PLACE} if isinstance(raw, str) else {}
    rows = read_mixed(spark, raw) if isinstance(raw, str) else raw
    trips = clean(rows, source_row_id(**source) if trip_id is None else trip_id, nan)
    table = f"{namespace}.{TRIPS.name}"
    # An earlier try may have left trips.
    append_once(trips, table, "trip_id")
    update_hourly(spark, trips, number, namespace)
    return report(spark, namespace)


def maintain(
    spark: SparkSession,
    namespace: str = NAMESPACE,
    target_file_size_bytes: int = TARGET_FILE_BYTES,
    min_input_files: int = MIN_INPUT_FILES,
) -> DataFrame:
    """Compact the trips table."""
    table = f"{namespace}.{TRIPS.name}"
    return compact(spark, table, target_file_size_bytes, min_input_files)


def report(spark: SparkSession, namespace: str = NAMESPACE) -> DataFrame:
    names = {"trips": TRIPS, "hourly": HOURLY, "anomalies": ANOMALIES}
    return row_counts({k: read_table(spark, t, namespace) for k, t in names.items()})
