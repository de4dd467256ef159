"""Writes into catalog tables: always by column name, distributed by partition, sized by table."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.session import durable, scratch, settings
from tripflow.tables.catalog import partition_columns, point_to, target_file_bytes, versions_root
from tripflow.tables.versions import Versions

# Bytes of shuffled rows per byte of snappy Parquet, measured on cleaned trips.
SHUFFLE_EXPANSION = 2
# Hash slots of a write. Days that share a slot share its tasks, and each task then leaves a file
# per day, so there are to be more slots than days; empty ones are merged away.
WRITE_SLOTS = 4096
# Table property that names the rows of a replacement under way.
REPLACING = "tripflow.replacing"
# Partition files a task keeps open at once. Up to this many it need not sort its rows by
# partition first; with more it sorts the rest.
OPEN_FILES = 32
# A write's settings belong to the session while it runs; writes of one driver take turns, so that
# none runs under another's overwrite mode.
_TURN = threading.RLock()


def write_settings(target_bytes: int | None) -> dict[str, str]:
    """How a rebalance before a write forms its tasks.

    Rows of a partition stay together whatever the number of tasks, so more tasks do not mean
    more files: no minimum size, and at most `target_bytes` of files per task.
    """
    wanted = {
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(WRITE_SLOTS),
        "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES),
    }
    if target_bytes:
        wanted["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(
            target_bytes * SHUFFLE_EXPANSION
        )
    return wanted


def distribute(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of one table partition together, so that each gets few files.

    A rebalance, not a plain repartition: at run time it splits a partition that exceeds the
    advisory size over several tasks and merges small ones into one task.
    """
    return df.hint("rebalance", *partitions)


def _insert(df: DataFrame, table: str, verb: str, mode: str) -> None:
    spark = df.sparkSession
    wanted = write_settings(target_file_bytes(spark, table))
    wanted["spark.sql.sources.partitionOverwriteMode"] = mode
    rows = distribute(df, partition_columns(spark, table))
    with _TURN, settings(spark, wanted):
        spark.sql(f"{verb} {table} BY NAME SELECT * FROM {{rows}}", rows=rows)


def append(df: DataFrame, table: str) -> None:
    """Add rows; a value that does not fit the column's type raises."""
    _insert(df, table, "INSERT INTO", "static")


def _not_yet_in(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows of `df` whose key the table lacks; reads only the partitions `df` touches."""
    spark = df.sparkSession
    spark.catalog.refreshTable(table)
    partitions = partition_columns(spark, table)
    touched = df.select(*partitions).distinct()
    held = spark.table(table).join(touched, partitions, "left_semi").select(*partitions, key)
    return df.join(held, [*partitions, key], "left_anti")


def append_once(df: DataFrame, table: str, key: str) -> None:
    """Add the rows whose key the table lacks; `key` is the same on a retry."""
    append(_not_yet_in(df, table, key), table)


def overwrite_partitions(df: DataFrame, table: str, key: str) -> None:
    """Put `df` in place of the rows with its keys; a rerun adds nothing.

    `key` tells rows apart and is the same on a rerun. Only partitions that `df` has rows for are
    rewritten, and rows there with other keys stay: a delivery that holds a few strays of a day
    does not wipe that day. The result is computed in full before a partition goes.
    """
    spark = df.sparkSession
    spark.catalog.refreshTable(table)
    partitions = partition_columns(spark, table)
    held = spark.table(table)
    columns = held.columns
    new = durable(df.select(*columns), "overwrite")
    touched = new.select(*partitions).distinct()
    stay = held.join(touched, partitions, "left_semi").join(new.select(key), key, "left_anti")
    rows = durable(_typed(new, held).unionByName(stay.select(*columns)), "overwrite")
    _insert(rows, table, "INSERT OVERWRITE", "dynamic")


def _typed(df: DataFrame, like: DataFrame) -> DataFrame:
    """The table's columns in its types; what does not fit raises here, not in the write."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in like.schema.fields])


#: Versions of a replaced table that stay: the new one, and those that readers may still read.
KEPT = 3


def replace(df: DataFrame, table: str) -> DataFrame:
    """Put `df` in place of all rows; columns, comments and partitioning of the table stay.

    A versioned table's rows are written once, to a new folder, and one change of the table's
    location puts them in place: a reader sees all old rows or all new ones, and a crash leaves the
    one or the other. `df` may read the table itself. Other columns of `df` are kept in the files,
    where the table does not see them. Returns the rows as written, with these columns.
    """
    spark = df.sparkSession
    root = versions_root(spark, table)
    if root is None:
        return _replace_in_place(df, table)
    with _TURN:
        spark.catalog.refreshTable(table)
        fields = {f.name: f.dataType for f in spark.table(table).schema.fields}
        more = [c for c in df.columns if c not in fields]
        rows = df.select(*[F.col(n).cast(t) for n, t in fields.items()], *more)
        partitions = partition_columns(spark, table)
        versions = Versions(spark, root)
        number = (versions.last() or 0) + 1
        with settings(spark, write_settings(target_file_bytes(spark, table))):
            path = versions.write(distribute(rows, partitions), number, partitions)
        point_to(spark, table, path)
        spark.catalog.refreshTable(table)
        versions.prune(KEPT)
    return spark.read.schema(rows.schema).parquet(path).select(*rows.columns)


def _replace_in_place(df: DataFrame, table: str) -> DataFrame:
    """For a table whose partitions the catalog tracks; readers may see it empty meanwhile.

    The rows are computed in full, in the table's types, before the old ones go, so an error in
    them leaves the table as it was, and `df` may read the table itself. Should the write fail
    after that, the old rows, of which a copy is taken first, are put back. While the write runs
    the table's property REPLACING names the computed rows: after a crash of the driver, `recover`
    finishes the replacement. Returns the computed rows.
    """
    spark = df.sparkSession
    spark.catalog.refreshTable(table)
    held = spark.table(table)
    rows = durable(df, "replace")
    path = scratch(spark, "replace-ready")
    _typed(rows, held).write.parquet(path)
    ready = spark.read.schema(held.schema).parquet(path)
    old = durable(held, "replaced")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{REPLACING}' = '{path}')")
    try:
        _insert(ready, table, "INSERT OVERWRITE", "static")
    except Exception:
        _insert(old, table, "INSERT OVERWRITE", "static")
        raise
    finally:
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{REPLACING}')")
    return rows


def recover(spark: SparkSession, table: str) -> bool:
    """Finish a replacement that a crash has interrupted; says whether there was one."""
    properties = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == REPLACING)
    found = properties.select("value").first()
    if not found or not found[0]:
        return False
    rows = spark.read.schema(spark.table(table).schema).parquet(found[0])
    _insert(rows, table, "INSERT OVERWRITE", "static")
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{REPLACING}')")
    return True
