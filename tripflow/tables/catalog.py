"""Namespace and table definitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.schemas import TABLES, Table
from tripflow.session import settings
from tripflow.tables.files import Files
from tripflow.tables.versions import Versions

NAMESPACE = "timeseries"
TARGET_PROPERTY = "tripflow.target-file-size-bytes"
# Says that a table has versions; the folder they lie in, below the table's own.
VERSIONS_PROPERTY = "tripflow.versions"
VERSIONS = "_versions"
_TRACKED = "spark.sql.hive.manageFilesourcePartitions"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_ddl(table: Table, namespace: str, location: str | None = None) -> str:
    columns = []
    for field in table.columns.fields:
        comment = field.metadata.get("comment")
        note = f" COMMENT {_text(comment)}" if comment else ""
        columns.append(f"  `{field.name}` {field.dataType.simpleString()}{note}")
    where = f"\nLOCATION {_text(f'{location}/{table.name}')}" if location else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {namespace}.{table.name} (\n"
        + ",\n".join(columns)
        + f"\n)\nUSING parquet\nPARTITIONED BY ({', '.join(table.partitions)}){where}"
        + f"\nTBLPROPERTIES ({_text(TARGET_PROPERTY)} = {_text(str(table.target_file_bytes))})"
    )


def create_tables(
    spark: SparkSession, namespace: str = NAMESPACE, location: str | None = None
) -> DataFrame:
    """Create what does not exist yet, and list the namespace.

    With `location` the files lie at a known place: a session whose catalog does not outlive it
    finds the tables' partitions again.
    """
    location = location.rstrip("/") if location else None
    where = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{where}")
    for table in TABLES:
        name = f"{namespace}.{table.name}"
        if location:
            Files(spark, location).make(f"{location}/{table.name}")
        with settings(spark, {_TRACKED: "false"} if table.versioned else {}):
            spark.sql(table_ddl(table, namespace, location))
        if table.versioned:
            _find_version(spark, name)
        elif location:
            spark.sql(f"MSCK REPAIR TABLE {name}")
    return list_tables(spark, namespace)


def _find_version(spark: SparkSession, table: str) -> None:
    """Mark a new table as versioned, and point it to the last version already there."""
    if VERSIONS_PROPERTY in properties(spark, table):
        return
    if details(spark, table).get("Partition Provider"):
        return  # made before there were versions; its partitions have locations of their own
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_text(VERSIONS_PROPERTY)} = 'yes')")
    versions = Versions(spark, versions_root(spark, table))
    if versions.last() is not None:
        point_to(spark, table, versions.path(versions.last()))


def versions_root(spark: SparkSession, table: str) -> str | None:
    """The folder of the table's versions; none if the table is not versioned."""
    if VERSIONS_PROPERTY not in properties(spark, table):
        return None
    place = location(spark, table)
    above = place.rsplit("/", 1)[0]
    return above if above.endswith(f"/{VERSIONS}") else f"{place}/{VERSIONS}"


def point_to(spark: SparkSession, table: str, path: str) -> None:
    """Make `path` the table's folder: one change, which readers see as a whole or not at all."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(path)}")


def read_table(spark: SparkSession, table: Table, namespace: str = NAMESPACE) -> DataFrame:
    """The table in its declared column order; the catalog itself lists partition columns last."""
    return spark.table(f"{namespace}.{table.name}").select(*table.columns.names)


def list_tables(spark: SparkSession, namespace: str = NAMESPACE) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}")


def describe(spark: SparkSession, table: str) -> DataFrame:
    """The data dictionary: column, type, comment."""
    return spark.sql(f"DESCRIBE TABLE {table}")


def details(spark: SparkSession, table: str) -> dict[str, str]:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    start = next(i for i, r in enumerate(rows) if r["col_name"].startswith("# Detailed"))
    return {r["col_name"]: r["data_type"] for r in rows[start + 1 :]}


def location(spark: SparkSession, table: str) -> str:
    return details(spark, table)["Location"].rstrip("/")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def target_file_bytes(spark: SparkSession, table: str) -> int | None:
    """The table's own target file size, if it names one."""
    found = properties(spark, table).get(TARGET_PROPERTY)
    return int(found) if found else None
