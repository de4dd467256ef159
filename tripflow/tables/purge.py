"""Dropping old partitions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.tables.catalog import details, partition_columns, versions_root
from tripflow.tables.files import Files
from tripflow.tables.write import replace

DROPS_PER_STATEMENT = 200
# The folder of rows without a value, which has no date.
HIDDEN = "__HIVE_DEFAULT_PARTITION__"


def partitions(spark: SparkSession, table: str) -> DataFrame:
    """partition: the path of each partition. The catalog does not know those of a versioned table."""
    columns = partition_columns(spark, table)
    if versions_root(spark, table) is None:
        return spark.sql(f"SHOW PARTITIONS {table}")
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(HIDDEN))) for c in columns]
    return spark.table(table).select(F.concat_ws("/", *parts).alias("partition")).distinct()


def oldpartitions(spark: SparkSession, table: str, before: date) -> DataFrame:
    """Partitions all of whose days lie before `before`: partition spec and its last day."""
    columns = partition_columns(spark, table)
    specs = partitions(spark, table)
    part = {
        name.rsplit("_", 1)[-1]: F.regexp_extract("partition", f"(?:^|/){name}=([0-9]+)", 1)
        for name in columns
    }
    month_start = F.make_date(part["year"].try_cast("int"), part["month"].try_cast("int"), F.lit(1))
    if "day" in part:
        last = F.date_add(month_start, part["day"].try_cast("int") - 1)
    else:
        last = F.last_day(month_start)
    return specs.withColumn("last_day", last).filter(F.col("last_day") < F.lit(before))


def _replace_without(spark: SparkSession, table: str, specs: list[str]) -> None:
    """A version of the table without these partitions, put in place at once."""
    columns = partition_columns(spark, table)
    gone = spark.createDataFrame([(s,) for s in specs], "partition string")
    parts = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in columns]
    rows = spark.table(table).withColumn("partition", F.concat_ws("/", *parts))
    replace(rows.join(gone, "partition", "left_anti").drop("partition"), table)


def purge(spark: SparkSession, table: str, before: date) -> int:
    """Drop partitions that lie wholly before `before`, with their files; gives their number.

    Whole partitions only: a table partitioned by month keeps the month that `before` falls in.
    """
    specs = [row["partition"] for row in oldpartitions(spark, table, before).collect()]
    if versions_root(spark, table):
        if specs:
            _replace_without(spark, table, specs)
        return len(specs)
    about = details(spark, table)
    for start in range(0, len(specs), DROPS_PER_STATEMENT):
        clauses = ", ".join(
            f"PARTITION ({spec.replace('/', ', ')})"
            for spec in specs[start : start + DROPS_PER_STATEMENT]
        )
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {clauses}")
    if about.get("Type") == "EXTERNAL":
        files = Files(spark, about["Location"])
        for spec in specs:
            files.delete(f"{about['Location']}/{spec}")
    spark.catalog.refreshTable(table)
    return len(specs)
