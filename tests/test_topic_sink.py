"""Several topics in one sink: own columns, event-time files, bad records, batches that run again."""

import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tripflow.sources.topics import stamped_file_topics
from tripflow.streaming import topic_sink as module
from tripflow.streaming.topic_sink import Topic, greedy_starts, topic_sink
from tripflow.tables.files import Files

TOPICS = [
    Topic("sensor_data", "timestamp timestamp, sensor bigint, reading double"),
    Topic("market_data", "at timestamp, symbol string, price decimal(10,2)", "at"),
]


def deliver(spark, folder, rows):
    """`rows`: topic and value, an object or the text itself."""
    lines = [(t, v if isinstance(v, str) else json.dumps(v)) for t, v in rows]
    table = spark.createDataFrame(lines, "topic string, value string").coalesce(1)
    table.write.mode("append").partitionBy("topic").text(f"{folder}/in")


def run(spark, folder, **options):
    records = stamped_file_topics(spark, f"{folder}/in")
    topic_sink(records, TOPICS, f"{folder}/out", f"{folder}/log", every=None, **options).awaitTermination()


def sensor(time, n=1, reading=1.5):
    return ("sensor_data", {"timestamp": time, "sensor": n, "reading": reading})


def held(spark, folder, topic):
    return spark.read.parquet(f"{folder}/out/topic={topic}")


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 400), max_size=60), st.integers(1, 120))
def test_cuts_one_by_one(times, span):
    times, expected = sorted(times), []
    for t in times:
        if not expected or t - expected[-1] >= span:
            expected.append(t)
    assert greedy_starts(np.array(times, dtype=np.int64), span).tolist() == expected


def test_own_columns_and_files_by_event_time(spark, folder):
    rows = [sensor(f"2024-01-01T05:{m:02}:{s:02}Z", m) for m in range(0, 60, 3) for s in (0, 30)]
    rows += [("market_data", {"at": "2024-01-01T05:00:00Z", "symbol": "X", "price": 12.25, "more": 1})]
    rows += [sensor("2023-12-31T23:59:59.999Z", 99), ("sensor_data", {"timestamp": "2024-01-01T05:59:59Z"})]
    deliver(spark, folder, rows)
    run(spark, folder)
    found = held(spark, folder, "sensor_data")
    assert found.count() == 42
    assert set(found.columns) == {
        "timestamp", "sensor", "reading", "kafka_ingestion_time", "year", "month", "day", "hour"
    }
    market = held(spark, folder, "market_data").select("at", "symbol", "price").collect()
    assert [(r.symbol, str(r.price)) for r in market] == [("X", "12.25")]
    spans = found.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min("timestamp").alias("a"), F.max("timestamp").alias("b")
    )
    assert spans.where(F.unix_millis("b") - F.unix_millis("a") >= 300_000).isEmpty()
    # 5:00 to 5:03, 5:06 to 5:09 and so on, ten files, then 5:59:59, which is late for 5:54:00.
    assert spans.count() == 1 + 10 + 1
    assert "slot" not in "".join(Files(spark, folder).walk(f"{folder}/out"))


def test_files_roll_by_rows_and_hot_spans_use_several_tasks(spark, folder, monkeypatch):
    monkeypatch.setattr(module, "TASK_ROWS", 40)
    deliver(spark, folder, [sensor("2024-01-01T05:00:00Z", i) for i in range(200)])
    run(spark, folder, roll_rows=15)
    counts = held(spark, folder, "sensor_data").groupBy("_metadata.file_path").count().collect()
    assert sum(r["count"] for r in counts) == 200 and max(r["count"] for r in counts) <= 15
    assert len(counts) >= 200 // 15


BAD = [
    ("sensor_data", "{not json", "record does not parse"),
    ("sensor_data", {"timestamp": "2024-01-01T05:00:00Z", "sensor": "x"}, "sensor is no bigint"),
    ("sensor_data", {"timestamp": "yesterday"}, "timestamp is no timestamp"),
    ("sensor_data", {"sensor": 4}, "record without event time"),
    ("sensor_data", {"timestamp": None}, "record without event time"),
    ("sensor_data", "17", "record without event time"),
    ("weather_data", {"timestamp": "2024-01-01T05:00:00Z"}, "topic without a schema"),
    ("market_data", {"at": "2024-01-01T05:00:00Z", "price": [1]}, "price is no decimal(10,2)"),
]


def test_bad_records_are_kept_and_fail_the_batch(spark, folder):
    deliver(spark, folder, [sensor("2024-01-01T05:00:00Z"), *[b[:2] for b in BAD]])
    for _ in range(2):  # the second start repeats the batch
        with pytest.raises(StreamingQueryException, match="all bad records are in"):
            run(spark, folder)
    errors = spark.read.parquet(f"{folder}/log/errors")
    assert sorted(r.message for r in errors.collect()) == sorted(b[2] for b in BAD)
    assert errors.where("position IS NULL OR value IS NULL").isEmpty()
    assert not [f for f in Files(spark, folder).walk(f"{folder}/out") if f.endswith(".parquet")]


def test_tolerated_bad_records(spark, folder):
    deliver(spark, folder, [sensor("2024-01-01T05:00:00Z"), *[b[:2] for b in BAD]])
    run(spark, folder, tolerate=True)
    assert held(spark, folder, "sensor_data").count() == 1
    assert spark.read.parquet(f"{folder}/log/errors").count() == len(BAD)


@pytest.mark.parametrize("step", ["_write", "move", "mark", "half", "done"])
def test_a_batch_that_runs_again_is_written_once(spark, folder, monkeypatch, step):
    """Stopped while staging, before the mark, while moving, or before the commit."""
    rows = [sensor(f"2024-01-01T{h:02}:00:00Z", h) for h in range(20)]
    deliver(spark, folder, rows)
    stamps = {r[0] for r in spark.read.text(f"{folder}/in").select("_metadata.file_modification_time").distinct().collect()}

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as broken:
        if step in ("_write", "move"):
            broken.setattr(module._Batches, step, stop)
        elif step == "half":
            real, left = Files.move, [7]

            def few(self, source, target):
                left[0] -= 1
                if left[0] < 0:
                    stop()
                real(self, source, target)

            broken.setattr(Files, "move", few)
        else:
            wanted, real_mark = {"mark": ".ready", "done": "/done/"}[step], Files.mark

            def mark(self, path):
                if wanted in path:
                    stop()
                real_mark(self, path)

            broken.setattr(Files, "mark", mark)
        with pytest.raises(StreamingQueryException):
            run(spark, folder)
    run(spark, folder)
    deliver(spark, folder, [sensor("2024-01-01T03:30:00Z", 77)])
    run(spark, folder)
    run(spark, folder)
    found = held(spark, folder, "sensor_data")
    assert sorted(r.sensor for r in found.collect()) == [*range(20), 77]
    mine = {r[0] for r in found.where("sensor < 20").select("kafka_ingestion_time").collect()}
    assert mine == stamps
    assert Files(spark, folder).names(f"{folder}/out/_staging") == []


def test_nothing_there(spark, folder):
    deliver(spark, folder, [("market_data", {"at": "2024-01-01T05:00:00Z"})])
    run(spark, folder)
    run(spark, folder)
    assert held(spark, folder, "market_data").count() == 1


def test_event_time_has_to_be_a_timestamp():
    with pytest.raises(ValueError, match="timestamp"):
        Topic("x", "timestamp string").schema
