"""Sink, intake and detection on streams."""

import datetime as dt
import json
import re

import pytest
from pyspark.errors import PySparkException, StreamingQueryException
from pyspark.sql import functions as F

from tripflow.functions.identity import source_row_id
from tripflow.operators.anomaly import detect
from tripflow.operators.clean import clean
from tripflow.schemas import ANOMALIES, TRIPS
from tripflow.session import scratch
from tripflow.sources.events import raw_trips, topic_records
from tripflow.sources.raw import stream_raw
from tripflow.sources.topics import file_topics, kafka_topics, parse_values
from tripflow.streaming import sink
from tripflow.streaming.detect import detect_stream, freeze_stats
from tripflow.streaming.intake import append_stream, ingest_new_files, unfinished_batch
from tripflow.streaming.sink import INGESTION_TIME, bucket, time_partitioned_sink
from tripflow.tables.files import Files
from tripflow.tables.write import append

VALUE = "timestamp timestamp, key bigint, value double"


@pytest.fixture
def places(spark):
    return {name: scratch(spark, name) for name in ("in", "out", "log")}


def few(events):
    """Two days, to keep the number of folders small."""
    return events.filter("ts >= '2024-01-02' AND ts < '2024-01-04'")


def run(spark, places, **options):
    schema = spark.read.parquet(places["in"]).schema
    stream = spark.readStream.schema(schema).parquet(places["in"])
    query = time_partitioned_sink(stream, places["out"], places["log"], every=None, **options)
    query.awaitTermination()
    return spark.read.parquet(places["out"])


def test_layout_and_rerun(spark, events, places):
    records = topic_records(few(events))
    first = records.filter("timestamp < '2024-01-03'")
    first.coalesce(1).write.parquet(places["in"])
    held = run(spark, places)
    assert held.count() == first.count()
    folder = f"{places['out']}/topic=sensor_data/year=2024/month=01/day=02/hour=00"
    assert Files(spark, places["out"]).exists(folder)
    assert run(spark, places).count() == first.count()

    rest = records.filter("timestamp >= '2024-01-03'")
    rest.coalesce(1).write.mode("append").parquet(places["in"])
    held = run(spark, places)
    kept = held.select(*records.columns)
    assert kept.exceptAll(records).count() == 0 and records.exceptAll(kept).count() == 0
    assert held.filter(F.col(INGESTION_TIME).isNull()).count() == 0


def test_late_records_reach_their_own_hour(spark, places):
    def put(*times):
        rows = [("sensor_data", t, i, 1.0) for i, t in enumerate(times)]
        df = spark.createDataFrame(rows, "topic string, timestamp timestamp, key bigint, value double")
        df.coalesce(1).write.mode("append").parquet(places["in"])

    put(dt.datetime(2024, 5, 1, 10, 1), dt.datetime(2024, 5, 1, 11, 2))
    run(spark, places)
    put(dt.datetime(2024, 6, 1, 0, 0))
    run(spark, places)
    put(dt.datetime(2024, 5, 1, 10, 59, 59))
    held = run(spark, places).groupBy("month", "hour").count().collect()
    assert {(r.month, r.hour): r["count"] for r in held} == {(5, 10): 2, (5, 11): 1, (6, 0): 1}


def test_rolls(spark, events, places):
    records = topic_records(few(events)).withColumns(
        {"topic": F.lit("market_data"), "timestamp": F.to_timestamp(F.lit("2024-01-01 05:07:00"))}
    )
    records.coalesce(1).write.parquet(places["in"])
    held = run(spark, places, roll_rows=100)
    rows, files = held.agg(
        F.count(F.lit(1)), F.countDistinct("_metadata.file_path")
    ).first()
    assert rows == records.count() and files >= rows / 100
    largest = held.groupBy("_metadata.file_path").count().agg(F.max("count")).first()[0]
    assert largest <= 100


def test_files_by_bytes(spark, events, places):
    """Beyond the rows at which files roll otherwise, one file as long as it is small."""
    records = topic_records(few(events)).withColumns(
        {"topic": F.lit("market_data"), "timestamp": F.to_timestamp(F.lit("2024-01-01 05:07:00"))}
    )
    records.coalesce(1).write.parquet(places["in"])
    held = run(spark, places, roll_rows=10, file_bytes=1 << 27)
    rows, files = held.agg(F.count(F.lit(1)), F.countDistinct("_metadata.file_path")).first()
    assert rows == records.count() > 10 and files == 1


def test_hot_bucket_is_split(spark, events, places, monkeypatch):
    """All records in one hour of one topic: several tasks write them."""
    monkeypatch.setattr(sink, "PART_BYTES", 20000)
    records = topic_records(events).withColumns(
        {"topic": F.lit("market_data"), "timestamp": F.to_timestamp(F.lit("2024-01-01 05:07:00"))}
    )
    records.repartition(12).write.parquet(places["in"])
    monkeypatch.setitem(sink.__dict__, "write_settings", one_scan_task_per_file)
    held = run(spark, places, roll_rows=0)
    assert held.count() == records.count()
    assert held.select("_metadata.file_path").distinct().count() > 2


def one_scan_task_per_file(target):
    from tripflow.tables.write import write_settings

    return {**write_settings(target), "spark.sql.files.openCostInBytes": str(2**27)}


def test_event_time_roll(spark, places):
    minutes = [0, 4, 5, 14, 59]
    rows = [("a", dt.datetime(2024, 1, 1, 3, m), m) for m in minutes]
    spark.createDataFrame(rows, "topic string, timestamp timestamp, key int").coalesce(
        1
    ).write.parquet(places["in"])
    held = run(spark, places, roll_event_seconds=300)
    assert {r.key: r.slot for r in held.collect()} == {0: 0, 4: 0, 5: 1, 14: 2, 59: 11}


def test_event_time_kinds(spark):
    moment = "2024-02-03T04:05:06Z"
    text = spark.createDataFrame([("a", moment)], "topic string, timestamp string")
    millis = spark.createDataFrame([("a", 1706933106000)], "topic string, timestamp bigint")
    for df in (text, millis):
        row = bucket(df).first()
        assert (row.year, row.month, row.day, row.hour) == ("2024", "02", "03", "04")


@pytest.mark.parametrize("bad", [None, "yesterday"])
def test_missing_event_time_fails_with_the_record(spark, bad):
    df = spark.createDataFrame([("a", bad, 77)], "topic string, timestamp string, key int")
    with pytest.raises(PySparkException, match="77"):
        bucket(df).collect()


def test_source_time_is_kept(spark):
    row = ("a", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 9))
    df = spark.createDataFrame([row], f"topic string, timestamp timestamp, {INGESTION_TIME} timestamp")
    assert bucket(df).first()[INGESTION_TIME] == row[2]


def lines(spark, folder, topic, *values):
    spark.createDataFrame([(v, topic) for v in values], "value string, topic string").coalesce(
        1
    ).write.mode("append").partitionBy("topic").text(folder)


def test_json_topics(spark, places):
    good = json.dumps({"timestamp": "2024-01-01T02:00:00Z", "key": 4, "value": 0.5})
    for topic in ("sensor_data", "weather_data"):
        lines(spark, places["in"], topic, good)
    stream = parse_values(file_topics(spark, places["in"]), VALUE)
    time_partitioned_sink(stream, places["out"], places["log"], every=None).awaitTermination()
    held = spark.read.parquet(places["out"]).select("topic", "hour", "key", "value").collect()
    assert sorted(held) == [("sensor_data", 2, 4, 0.5), ("weather_data", 2, 4, 0.5)]


@pytest.mark.parametrize("bad", ['{"timestamp": "2024-01-01T02:00:00Z", "key": "x"}', "{no json"])
def test_bad_record_stops_the_stream(spark, places, bad):
    lines(spark, places["in"], "sensor_data", bad)
    stream = parse_values(file_topics(spark, places["in"]), VALUE)
    query = time_partitioned_sink(stream, places["out"], places["log"], every=None)
    with pytest.raises(StreamingQueryException, match=re.escape(f"record does not parse: {bad}")):
        query.awaitTermination()


def test_kafka_needs_its_source(spark):
    with pytest.raises(PySparkException, match="kafka"):
        kafka_topics(spark, "broker:9092")


def raw_parts(events, folder, parts=3):
    raw_trips(events).drop("event_id").repartition(parts).write.mode("append").parquet(folder)


def test_intake_takes_each_file_once(spark, events, namespace, places):
    table = f"{namespace}.{TRIPS.name}"
    raw_parts(events, places["in"])
    for _ in range(2):
        ingest_new_files(spark, places["in"], places["log"], namespace).awaitTermination()
        assert spark.table(table).count() == 7890
    raw_parts(events, places["in"], 1)
    query = ingest_new_files(spark, places["in"], places["log"], namespace, files_per_batch=1)
    query.awaitTermination()
    assert spark.table(table).count() == 2 * 7890
    assert spark.table(table).select("trip_id").distinct().count() == 2 * 7890


@pytest.mark.parametrize("appended", ["nothing", "some", "all"])
def test_retried_batch_adds_nothing_twice(spark, events, namespace, places, appended):
    """A crash after the rows were appended, in part or whole, but before the batch was noted."""
    table = f"{namespace}.{TRIPS.name}"
    raw_parts(events, places["in"])
    stream = clean(stream_raw(spark, places["in"]), source_row_id())

    def crash(batch, number):
        if appended != "nothing":
            part = batch if appended == "all" else batch.filter("pickup_day < 9")
            append(part, table)
        raise RuntimeError("driver lost")

    broken = stream.writeStream.foreachBatch(crash).option("checkpointLocation", places["log"])
    with pytest.raises(Exception, match="driver lost"):
        broken.trigger(availableNow=True).start().awaitTermination()
    assert unfinished_batch(spark, places["log"]) == 0
    append_stream(stream, table, "trip_id", places["log"]).awaitTermination()
    assert unfinished_batch(spark, places["log"]) is None
    assert spark.table(table).count() == 7890
    assert spark.table(table).select("trip_id").distinct().count() == 7890


def test_stream_finds_what_the_batch_finds(spark, events, trips, namespace, places):
    events.repartition(3).write.parquet(places["in"])
    stats = freeze_stats(trips)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    rows = clean(raw_trips(stream.parquet(places["in"])), F.col("event_id"))
    for _ in range(2):
        detect_stream(rows, stats, places["log"], namespace).awaitTermination()
    names = [n for n in ANOMALIES.columns.names if n != "detected_at"]
    found = spark.table(f"{namespace}.{ANOMALIES.name}").select(*names)
    want = detect(trips, stats, event_id="hash").select(*names)
    assert found.count() == 146 and found.exceptAll(want).count() == 0


def test_older_files_are_taken_too(spark, events, namespace, places):
    raw_parts(events, places["in"], 1)
    ingest_new_files(spark, places["in"], places["log"], namespace).awaitTermination()
    table = f"{namespace}.{TRIPS.name}"
    first = spark.table(table).count()
    files = Files(spark, places["in"])
    seen = set(files.walk(places["in"]))
    raw_parts(events, places["in"], 1)
    for path in set(files.walk(places["in"])) - seen:
        files.date_back(path, 10)
    ingest_new_files(spark, places["in"], places["log"], namespace).awaitTermination()
    assert spark.table(table).count() == 2 * first
