"""Command line: spark-submit this module, or `python -m tripflow <job> …`."""

from __future__ import annotations

import argparse
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from tripflow.functions.identity import source_row_id
from tripflow.operators.clean import clean
from tripflow.operators.rules import RULES
from tripflow.plans import jobs
from tripflow.schemas import TABLES, TRIPS
from tripflow.session import build_session
from tripflow.sources.raw import stream_raw
from tripflow.sources.topics import (
    file_topics,
    kafka_topics,
    parse_values,
    stamped_file_topics,
)
from tripflow.streaming.intake import ingest_new_files
from tripflow.streaming.live import detect_live
from tripflow.streaming.sink import ROLL_EVENT_SECONDS, ROLL_WALL_CLOCK, time_partitioned_sink
from tripflow.streaming.topic_sink import Topic, topic_sink
from tripflow.tables.catalog import NAMESPACE, create_tables, read_table
from tripflow.tables.compact import MIN_INPUT_FILES, TARGET_FILE_BYTES
from tripflow.tables.expiry import KEEP, expire
from tripflow.tables.purge import purge


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripflow")
    parser.add_argument("--namespace", default=NAMESPACE)
    parser.add_argument("--location", help="folder of the tables, for catalogs kept in memory")
    commands = parser.add_subparsers(dest="job", required=True)
    commands.add_parser("create", help="create namespace and tables")
    ingest = commands.add_parser("ingest", help="clean raw files into the trips table")
    ingest.add_argument("raw")
    ingest.add_argument("--mode", choices=jobs.MODES, default="append")
    ingest.add_argument("--ids", choices=jobs.IDS, default="task")
    ingest.add_argument("--nan", choices=["keep", "drop"], default="keep")
    intake = commands.add_parser("intake", help="clean only files not taken before")
    intake.add_argument("raw")
    intake.add_argument("checkpoint")
    deliver = commands.add_parser("deliver", help="add numbered raw files to trips and hours, once")
    deliver.add_argument("raw")
    deliver.add_argument("number", type=int, help="from 1; the same number again adds nothing")
    detect = commands.add_parser("detect", help="score new raw files against all files before them")
    detect.add_argument("raw")
    detect.add_argument("checkpoint")
    detect.add_argument("--history", action="store_true", help="start from the trips table")
    aggregate = commands.add_parser("aggregate", help="hourly table, anomalies, compaction")
    aggregate.add_argument("--p95", choices=["approx", "exact"], default="approx")
    aggregate.add_argument("--mode", choices=jobs.MODES, default="append")
    aggregate.add_argument("--rules", nargs="*", choices=sorted(RULES), default=[])
    sink = commands.add_parser("sink", help="topics to hour-partitioned files")
    sink.add_argument("path")
    sink.add_argument("checkpoint")
    source = sink.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="broker addresses")
    source.add_argument("--files", help="folder of topic=<name>/ text files")
    sink.add_argument("--schema", required=True, help="DDL of the JSON values")
    sink.add_argument("--tasks", type=int, help="least number of tasks reading the broker")
    sink.add_argument("--roll-event-time", action="store_true", help="a folder per five minutes")
    sink.add_argument("--file-bytes", type=int, help="size files by bytes in place of rows")
    sink.add_argument("--once", action="store_true", help="take what is there and stop")
    topics = commands.add_parser("topics", help="topics of different columns, files by event time")
    topics.add_argument("path")
    topics.add_argument("checkpoint")
    origin = topics.add_mutually_exclusive_group(required=True)
    origin.add_argument("--servers", help="broker addresses")
    origin.add_argument("--files", help="folder of topic=<name>/ text files")
    topics.add_argument(
        "--topic", action="append", required=True, metavar="NAME=DDL", help="columns of one topic"
    )
    topics.add_argument("--errors", help="folder of bad records, by default beside the checkpoint")
    topics.add_argument("--tolerate", action="store_true", help="go on without bad records")
    topics.add_argument("--once", action="store_true", help="take what is there and stop")
    tidy = commands.add_parser("compact", help="rewrite trip files of bad size")
    tidy.add_argument("--target-bytes", type=int, default=TARGET_FILE_BYTES)
    tidy.add_argument("--min-files", type=int, default=MIN_INPUT_FILES)
    drop = commands.add_parser("purge", help="drop trip partitions before a date")
    drop.add_argument("before", type=date.fromisoformat)
    tidy_up = commands.add_parser("expire", help="remove old versions, work and scratch folders")
    tidy_up.add_argument("--days", type=float, default=KEEP.days)
    tidy_up.add_argument("--scratch", help="folder of intermediate results")
    tidy_up.add_argument("--dry", action="store_true", help="only list")
    query = commands.add_parser("sql", help="run a query over the tables")
    query.add_argument("text")
    query.add_argument("--out", help="folder for the whole result as Parquet")
    return parser.parse_args()


def main() -> None:
    args = _arguments()
    spark = build_session(f"tripflow-{args.job}")
    tables = create_tables(spark, args.namespace, args.location)
    if args.job == "create":
        tables.show(truncate=False)
    elif args.job == "ingest":
        jobs.ingest(spark, args.raw, args.namespace, nan=args.nan, mode=args.mode, ids=args.ids).show()
    elif args.job == "intake":
        ingest_new_files(spark, args.raw, args.checkpoint, args.namespace).awaitTermination()
        jobs.report(spark, args.namespace).show()
    elif args.job == "deliver":
        jobs.deliver(spark, args.raw, args.number, args.namespace).show()
    elif args.job == "detect":
        past = read_table(spark, TRIPS, args.namespace) if args.history else None
        trips = clean(stream_raw(spark, args.raw), trip_id=source_row_id())
        detect_live(trips, args.checkpoint, args.namespace, history=past).awaitTermination()
        jobs.report(spark, args.namespace).show()
    elif args.job == "aggregate":
        counts = jobs.aggregate(
            spark, args.namespace, args.p95, mode=args.mode, rules=args.rules
        )
        _print(jobs.maintain(spark, args.namespace))
        counts.show()
    elif args.job == "sink":
        _sink(spark, args)
    elif args.job == "topics":
        _topics(spark, args)
    elif args.job == "compact":
        _print(jobs.maintain(spark, args.namespace, args.target_bytes, args.min_files))
    elif args.job == "purge":
        print(purge(spark, f"{args.namespace}.{TRIPS.name}", args.before))
    elif args.job == "expire":
        names = [f"{args.namespace}.{t.name}" for t in TABLES]
        _print(expire(spark, names, args.scratch, keep=timedelta(days=args.days), dry=args.dry))
    elif args.job == "sql":
        spark.catalog.setCurrentDatabase(args.namespace)
        result = spark.sql(args.text)
        if args.out:
            result.write.parquet(args.out)
        else:
            _print(result)
    spark.stop()


def _print(rows: DataFrame) -> None:
    """All rows, tab separated; they pass through one at a time."""
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join("NULL" if value is None else str(value) for value in row))


def _sink(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.servers:
        records = kafka_topics(spark, args.servers, min_partitions=args.tasks)
    else:
        records = file_topics(spark, args.files)
    values = parse_values(records, args.schema)
    query = time_partitioned_sink(
        values,
        args.path,
        args.checkpoint,
        roll_event_seconds=ROLL_EVENT_SECONDS if args.roll_event_time else None,
        every=None if args.once else ROLL_WALL_CLOCK,
        file_bytes=args.file_bytes,
    )
    query.awaitTermination()


def _topics(spark: SparkSession, args: argparse.Namespace) -> None:
    topics = [Topic(*text.split("=", 1)) for text in args.topic]
    if args.servers:
        names = [t.name for t in topics]
        records = kafka_topics(spark, args.servers, names, position=True)
    else:
        records = stamped_file_topics(spark, args.files)
    every = None if args.once else ROLL_WALL_CLOCK
    query = topic_sink(
        records, topics, args.path, args.checkpoint, args.errors, tolerate=args.tolerate, every=every
    )
    query.awaitTermination()


if __name__ == "__main__":
    main()
