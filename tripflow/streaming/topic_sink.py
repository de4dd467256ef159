"""Several topics of different columns into hour folders, files rolled by event time, exactly once.

A batch is written in steps that may each be repeated:

1. Every value is parsed once, into a VARIANT, and typed by its topic's own schema. Records that do
   not fit go to the error folder, with the reason, and then the batch fails, or goes on without
   them if that is wanted.
2. Files are cut along each hour of a topic: a file ends before the first record that lies
   `roll_seconds` or more after its own first. Only the different milliseconds of an hour and their
   numbers of records meet in a task, at most 3.6 million whatever the hour's records.
3. Each file is written by a task of its own, several if it has many records, to a staging folder.
   Once all are there a mark says so, and they are moved into place.

A batch that runs again after that mark is not computed again: its files, and the times stamped in
them, are those of the first try. Before it the times are the same as well, for they belong to the
source's records, not to the run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, TimestampType

from tripflow.functions.calendar import path_columns
from tripflow.streaming.sink import INGESTION_TIME, ROLL_EVENT_SECONDS, ROLL_ROWS, ROLL_WALL_CLOCK
from tripflow.tables.files import Files

HOUR = ("year", "month", "day", "hour")
#: Records that one task writes; more of one file's span go to several.
TASK_ROWS = 1_000_000
#: What is kept of a record that fails.
ERROR_COLUMNS = ("topic", "position", "message", "value", INGESTION_TIME)


@dataclass(frozen=True)
class Topic:
    """A topic's name, the columns (DDL) of its JSON values, and which of them is the event time."""

    name: str
    columns: str
    event_time: str = "timestamp"

    @property
    def schema(self) -> StructType:
        schema = StructType.fromDDL(self.columns)
        if not isinstance(schema[self.event_time].dataType, TimestampType):
            raise ValueError(f"{self.name}: {self.event_time} has to be a timestamp")
        return schema


def _field(field: StructField, kind: str) -> Column:
    path = "$['" + field.name.replace("\\", "\\\\").replace("'", "\\'") + "']"
    return F.try_variant_get("parsed", path, kind)


def _typed(field: StructField) -> Column:
    return _field(field, field.dataType.simpleString())


def _fault(topic: Topic) -> Column:
    """Why a record of the topic cannot be written; NULL if it can."""
    reasons = [F.when(F.col("parsed").isNull(), F.lit("record does not parse"))]
    for field in topic.schema.fields:
        held = _field(field, "variant")
        wrong = held.isNotNull() & ~F.is_variant_null(held) & _typed(field).isNull()
        text = f"{field.name} is no {field.dataType.simpleString()}"
        reasons.append(F.when(wrong, F.lit(text)))
    time = _typed(topic.schema[topic.event_time])
    reasons.append(F.when(time.isNull(), F.lit("record without event time")))
    return F.coalesce(*reasons)


def parsed(records: DataFrame, topics: Sequence[Topic]) -> DataFrame:
    """topic, position, value, the ingestion time, parsed, message, time.

    `message` says why a record cannot be written; `time` is the event time of the others. The
    position is NULL where the source gives none.
    """
    position = F.col("position") if "position" in records.columns else F.lit(None).cast("string")
    read = records.select(
        "topic", position.alias("position"), "value", INGESTION_TIME,
        F.try_parse_json("value").alias("parsed"),
    )
    fault, time = F.lit("topic without a schema"), F.lit(None).cast("timestamp")
    for topic in topics:
        mine = F.col("topic") == topic.name
        fault = F.when(mine, _fault(topic)).otherwise(fault)
        time = F.when(mine, _typed(topic.schema[topic.event_time])).otherwise(time)
    return read.withColumns({"message": fault, "time": time})


def greedy_starts(times: np.ndarray, span: int) -> np.ndarray:
    """The first time of each file: a file ends before the first time `span` or more after its own
    first. `times` are different and ascending."""
    starts = [0] if len(times) else []
    while starts:
        after = int(np.searchsorted(times, times[starts[-1]] + span))
        if after == len(times):
            break
        starts.append(after)
    return times[np.array(starts, dtype=np.int64)]


def _cut(span: int):
    def cut(bucket: pa.Table) -> pa.Table:
        bucket = bucket.sort_by("ms")
        times, counts = bucket.column("ms").to_numpy(), bucket.column("n").to_numpy()
        starts = greedy_starts(times, span)
        rows = np.add.reduceat(counts, np.searchsorted(times, starts))
        pieces = -(-rows // TASK_ROWS)
        first = np.concatenate([[0], np.cumsum(pieces)[:-1]])
        lists = (starts, first, pieces)
        return pa.table(
            [
                *(bucket.column(c).slice(0, 1) for c in ("topic", *HOUR)),
                *(pa.array([x.tolist()], pa.list_(pa.int64())) for x in lists),
                pa.array([int(pieces.sum())], pa.int64()),
            ],
            names=["topic", *HOUR, "starts", "first", "pieces", "parts"],
        )

    return cut


def file_slots(timed: DataFrame, roll_seconds: int) -> DataFrame:
    """topic, year, month, day, hour, starts, first, pieces, parts, before: one row per hour.

    `timed`: topic, time and the hour's columns. `starts` are the first milliseconds of the hour's
    files, `pieces` the tasks that write each, numbered from `first` within the hour and from
    `before` within the topic.
    """
    keys = ["topic", *HOUR]
    distinct = timed.groupBy(*keys, F.unix_millis("time").alias("ms")).agg(
        F.count(F.lit(1)).alias("n")
    )
    types = ", ".join(f"{k} string" for k in keys)
    cut = distinct.groupBy(*keys).applyInArrow(
        _cut(roll_seconds * 1000),
        f"{types}, starts array<long>, first array<long>, pieces array<long>, parts long",
    )
    # One row per hour of the batch.
    so_far = Window.partitionBy("topic").orderBy(*HOUR).rowsBetween(Window.unboundedPreceding, 0)
    return cut.withColumn("before", F.sum("parts").over(so_far) - F.col("parts"))


def with_part(timed: DataFrame, slots: DataFrame) -> DataFrame:
    """`timed` with `part`, the number of the task that writes the record."""
    met = timed.join(slots, ["topic", *HOUR])
    ms = F.unix_millis("time")
    slot = F.size(F.filter("starts", lambda s: s <= ms))
    spread = F.pmod(F.xxhash64("value", "position"), F.element_at("pieces", slot))
    part = F.col("before") + F.element_at("first", slot) + spread
    return met.withColumn("part", part.cast("int"))


class BadRecords(RuntimeError):
    """Records of a batch that do not fit their topic's schema."""


class _Batches:
    """Writes numbered batches below `path`, each once."""

    def __init__(
        self, topics: Sequence[Topic], path: str, checkpoint: str, errors: str,
        roll_rows: int, roll_seconds: int, tolerate: bool, before_commit: Callable[[int], None] | None,
    ):
        self.topics, self.path, self.errors = topics, path.rstrip("/"), errors.rstrip("/")
        self.log = f"{checkpoint.rstrip('/')}/sink"
        self.roll_rows, self.roll_seconds, self.tolerate = roll_rows, roll_seconds, tolerate
        self.before_commit = before_commit

    def _name(self, files: Files) -> str:
        """What tells this checkpoint from others that write to the same place."""
        for name in files.names(f"{self.log}/id"):
            return name
        name = uuid.uuid4().hex
        files.mark(f"{self.log}/id/{name}")
        return name

    def write(self, batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        files, log = Files(spark, self.path), Files(spark, self.log)
        if log.exists(f"{self.log}/done/{number}"):
            return
        staging = f"{self.path}/_staging/{self._name(log)}-{number}"
        if not files.exists(f"{staging}.ready"):
            files.delete(staging)
            self._stage(batch, number, staging)
            files.make(staging)
            files.mark(f"{staging}.ready")
        self.move(spark, staging)
        if self.before_commit:
            self.before_commit(number)
        log.mark(f"{self.log}/done/{number}")
        files.delete(f"{staging}.ready")
        files.delete(staging)

    def move(self, spark: SparkSession, staging: str) -> None:
        """Staged files into place; those that an earlier try has moved are left alone."""
        files = Files(spark, self.path)
        names = (p.split(f"{staging.rsplit('/', 1)[1]}/", 1)[1] for p in files.walk(staging))
        chosen = (n for n in names if not n.rsplit("/", 1)[1].startswith(("_", ".")))
        files.move_all((f"{staging}/{n}", f"{self.path}/{n}") for n in chosen)

    def _stage(self, batch: DataFrame, number: int, staging: str) -> None:
        # Read by the errors, the cuts and each topic; what is lost with an executor is read again.
        read = parsed(batch, self.topics).persist()
        try:
            self._refuse(read.where("message IS NOT NULL"), number)
            timed = read.where("message IS NULL").withColumns(path_columns("time"))
            slots = file_slots(timed, self.roll_seconds).persist()
            # One row per topic.
            tasks = {r["topic"]: r["n"] for r in slots.groupBy("topic").agg(F.sum("parts").alias("n")).collect()}
            for topic in self.topics:
                if topic.name in tasks:
                    mine = with_part(timed.where(F.col("topic") == topic.name), slots)
                    self._write(mine, topic, tasks[topic.name], staging)
            slots.unpersist()
        finally:
            read.unpersist()

    def _write(self, rows: DataFrame, topic: Topic, tasks: int, staging: str) -> None:
        columns = [_typed(f).alias(f.name) for f in topic.schema.fields]
        placed = rows.repartitionById(tasks, F.col("part"))
        writer = placed.select(*columns, INGESTION_TIME, *HOUR).write.partitionBy(*HOUR)
        writer = writer.option("maxRecordsPerFile", self.roll_rows).option("compression", "snappy")
        writer.parquet(f"{staging}/topic={topic.name}")

    def _refuse(self, bad: DataFrame, number: int) -> None:
        first = bad.select("message", "value").first()
        if first is None:
            return
        place = f"{self.errors}/batch={number}"
        bad.select(*ERROR_COLUMNS).write.mode("overwrite").parquet(place)
        if not self.tolerate:
            raise BadRecords(f"{first['message']}: {first['value']}; all bad records are in {place}")


def topic_sink(
    records: DataFrame,
    topics: Sequence[Topic],
    path: str,
    checkpoint: str,
    errors: str | None = None,
    roll_rows: int = ROLL_ROWS,
    roll_seconds: int = ROLL_EVENT_SECONDS,
    tolerate: bool = False,
    every: str | None = ROLL_WALL_CLOCK,
    before_commit: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Write `records` to topic=/year=/month=/day=/hour= folders, each topic with its own columns.

    `records`: topic, value (JSON text), kafka_ingestion_time and, where the source has one,
    position. A field that a value lacks or has as null is NULL; a value that does not parse, is of
    another type, has no event time, or belongs to a topic without a schema is a bad record. Bad
    records go to `errors` (by default beside the checkpoint) as batch=<number>, and fail the query
    unless `tolerate`. A late record goes to the folder of its own time. `every=None` takes what is
    there and stops. `before_commit` is called with the number of each batch whose files are in place,
    to tell others for instance; if it raises, the batch is repeated.
    """
    errors = errors or f"{checkpoint.rstrip('/')}/errors"
    batches = _Batches(topics, path, checkpoint, errors, roll_rows, roll_seconds, tolerate, before_commit)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    writer = records.writeStream.foreachBatch(batches.write).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()
