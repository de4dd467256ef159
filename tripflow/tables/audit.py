"""How a table lies on disk: files, codecs and sizes per partition, from the files' footers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.sources.footers import footers, list_parquet
from tripflow.tables.binpack import badly_sized
from tripflow.tables.catalog import location, partition_columns, target_file_bytes
from tripflow.tables.compact import TARGET_FILE_BYTES, WORK


def layout(spark: SparkSession, table: str) -> DataFrame:
    """partition, files, rows, bytes, row_groups, codecs, well_sized, share_well_sized.

    A file is well sized if compaction would leave it alone: near the table's own target. Files of a
    compaction under way do not count.
    """
    depth = len(partition_columns(spark, table))
    target = target_file_bytes(spark, table) or TARGET_FILE_BYTES
    folder = F.substring_index(F.substring_index("path", "/", -(depth + 1)), "/", depth)
    files = list_parquet(spark, location(spark, table)).where(~F.col("path").contains(f"/{WORK}/"))
    good = F.count_if(~badly_sized(F.col("bytes"), target))
    return (
        footers(files)
        .groupBy(folder.alias("partition"))
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.sum("rows").alias("rows"),
            F.sum("bytes").alias("bytes"),
            F.sum("row_groups").alias("row_groups"),
            F.array_join(F.sort_array(F.array_distinct(F.flatten(F.collect_set("codecs")))), ",").alias("codecs"),
            good.alias("well_sized"),
            (good / F.count(F.lit(1))).alias("share_well_sized"),
        )
    )
