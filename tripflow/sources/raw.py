"""Raw trip files, as a batch or as a stream of newly arrived files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tripflow.schemas import RAW_TRIPS

# Spark's file streams ignore for good what is older than the newest file by more than this, and
# say nothing; copies often keep their dates. A hundred years, longer than any file's age. The
# stream's list of files seen then holds every file, one line each in the checkpoint.
ANY_AGE = "36500d"


def read_raw(spark: SparkSession, path: str, schema: StructType | None = RAW_TRIPS) -> DataFrame:
    """All Parquet files below `path` (any Hadoop URI).

    A fixed schema saves the footer reads of inference and makes type drift an error;
    `schema=None` infers it from the files instead.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def stream_raw(
    spark: SparkSession,
    path: str,
    schema: StructType = RAW_TRIPS,
    files_per_batch: int | None = None,
    max_file_age: str = ANY_AGE,
) -> DataFrame:
    """A stream that delivers each file below `path` once, whatever its date."""
    reader = spark.readStream.schema(schema).option("maxFileAge", max_file_age)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
