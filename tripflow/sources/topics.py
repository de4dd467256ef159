"""Topic streams: records with the columns topic, value and, from a broker, timestamp."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.sources.raw import ANY_AGE

from tripflow.schemas import TOPICS

UNPARSED = "_unparsed"


def kafka_topics(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str] = TOPICS,
    min_partitions: int | None = None,
    position: bool = False,
) -> DataFrame:
    """Subscribe to `topics`; needs the Kafka source on the classpath.

    `position` adds a record's topic partition and offset. `min_partitions` splits topic partitions further when there are more cores than partitions.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "true")
    )
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return reader.load().select(
        "topic",
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("kafka_ingestion_time"),
        *([F.concat_ws(":", "partition", "offset").alias("position")] if position else []),
    )


def file_topics(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """The same records from text files of one JSON value per line under `path/topic=<name>/`."""
    reader = spark.readStream.schema("value string, topic string").option("maxFileAge", ANY_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).select("topic", "value")


def stamped_file_topics(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """`file_topics` with the file as position and its date as time of arrival.

    Both belong to the file, so a batch that runs again finds the same.
    """
    reader = spark.readStream.schema("value string, topic string").option("maxFileAge", ANY_AGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path).select(
        "topic",
        "value",
        F.col("_metadata.file_modification_time").alias("kafka_ingestion_time"),
        F.col("_metadata.file_path").alias("position"),
    )


def parse_values(records: DataFrame, schema: str) -> DataFrame:
    """JSON values into the columns of `schema` (DDL).

    A record that does not parse, or has a value of another type, fails the query, and the message
    shows the record.
    """
    options = {"columnNameOfCorruptRecord": UNPARSED, "timeZone": "UTC"}
    parsed = F.from_json("value", f"{schema}, {UNPARSED} string", options)
    message = F.concat(F.lit("record does not parse: "), F.col(f"parsed.{UNPARSED}"))
    unparsed = F.col(f"parsed.{UNPARSED}")
    checked = F.when(unparsed.isNull(), F.col("parsed")).otherwise(F.raise_error(message))
    read = records.withColumn("parsed", parsed).withColumn("parsed", checked)
    return read.drop("value").select("*", "parsed.*").drop("parsed", UNPARSED)
