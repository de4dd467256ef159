"""Definitions, writes, purge and the jobs."""

import uuid
from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tripflow.operators.hourly import hourly
from tripflow.plans import jobs
from tripflow.schemas import ANOMALIES, HOURLY, MIB, TABLES, TRIPS
from tripflow.session import scratch
from tripflow.sources.events import raw_trips
from tripflow.tables import write
from tripflow.tables.catalog import (
    create_tables,
    describe,
    list_tables,
    location,
    partition_columns,
    read_table,
    target_file_bytes,
)
from tripflow.tables.files import Files
from tripflow.tables.purge import partitions, purge
from tripflow.tables.write import append, overwrite_partitions, replace, settings


def file_count(df):
    return df.select("_metadata.file_path").distinct().count()


def several_scans(spark, folder):
    """One scan task per file, as with large files."""
    with settings(spark, {"spark.sql.files.openCostInBytes": str(128 * MIB)}):
        scan = spark.read.parquet(folder)
        assert scan.rdd.getNumPartitions() > 1
        return scan


def test_definitions(spark, namespace):
    assert create_tables(spark, namespace).count() >= len(TABLES)
    names = {r.tableName for r in list_tables(spark, namespace).collect()}
    assert names >= {t.name for t in TABLES}
    for table in TABLES:
        name = f"{namespace}.{table.name}"
        held = read_table(spark, table, namespace).schema
        assert held.names == table.columns.names
        assert [f.dataType for f in held] == [f.dataType for f in table.columns]
        assert partition_columns(spark, name) == list(table.partitions)
        assert target_file_bytes(spark, name) == table.target_file_bytes
        comments = {r.col_name: r.comment for r in describe(spark, name).collect()}
        for field in table.columns.fields:
            assert (comments[field.name] or "") == field.metadata.get("comment", "")
    assert TRIPS.target_file_bytes == 128 * MIB and HOURLY.target_file_bytes == 64 * MIB


def test_append_by_name(spark, namespace, trips):
    table = f"{namespace}.{TRIPS.name}"
    append(trips.select(*sorted(trips.columns)), table)
    held = read_table(spark, TRIPS, namespace)
    assert held.exceptAll(trips).count() == 0 and trips.exceptAll(held).count() == 0
    append(trips, table)
    assert spark.table(table).count() == 2 * trips.count()
    with pytest.raises(PySparkException):
        append(trips.withColumnRenamed("extra", "other"), table)


def test_overflow_raises(spark, namespace, trips):
    wide = trips.withColumn("vendor_id", F.lit(2**40))
    with pytest.raises(PySparkException):
        append(wide, f"{namespace}.{TRIPS.name}")


def test_one_file_per_small_partition_and_snappy(spark, namespace, trips):
    table = f"{namespace}.{TRIPS.name}"
    append(trips.repartition(6), table)
    days = trips.select(*TRIPS.partitions).distinct().count()
    assert file_count(spark.table(table)) == days
    names = Files(spark, location(spark, table)).walk(location(spark, table))
    assert all(n.endswith(".snappy.parquet") for n in names if n.endswith(".parquet"))


def test_hot_partition_is_split(spark, namespace, trips, folder):
    """All rows on one day: several tasks write it once it passes the target size."""
    trips.repartition(12).write.parquet(folder)
    table = f"{namespace}.{TRIPS.name}"
    spark.sql(
        f"ALTER TABLE {table} SET TBLPROPERTIES ('tripflow.target-file-size-bytes' = '20000')"
    )
    append(several_scans(spark, folder).withColumn("pickup_day", F.lit(1)), table)
    assert file_count(spark.table(table)) > 3
    assert spark.table(table).count() == trips.count()


def test_pruned_read(spark, namespace, trips, capsys):
    table = f"{namespace}.{TRIPS.name}"
    append(trips, table)
    hourly(spark.table(table).filter("pickup_day = 7")).explain("formatted")
    plan = capsys.readouterr().out
    assert "(pickup_day" in plan.split("PartitionFilters")[1].split("\n")[0]
    assert "extra" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_replace_keeps_definition(spark, namespace, trips):
    table = f"{namespace}.{HOURLY.name}"
    replace(hourly(trips), table)
    early = hourly(trips.filter("pickup_day < 3"))
    replace(early.withColumn("pickup_month", F.lit(2)), table)
    assert spark.table(table).count() == early.count()
    assert partition_columns(spark, table) == list(HOURLY.partitions)
    assert [r.partition for r in partitions(spark, table).collect()] == [
        "pickup_year=2024/pickup_month=2"
    ]


def test_failed_replace_leaves_the_table(spark, namespace, trips):
    table = f"{namespace}.{HOURLY.name}"
    replace(hourly(trips), table)
    broken = hourly(trips).withColumn(
        "total_trips", F.when(F.col("pickup_day") > 5, F.raise_error("lost")).otherwise(F.lit(1))
    )
    with pytest.raises(PySparkException):
        replace(broken, table)
    assert spark.table(table).count() == hourly(trips).count()


def test_strays_do_not_wipe_a_day(spark, namespace, trips):
    table = f"{namespace}.{TRIPS.name}"
    append(trips, table)
    strays = trips.filter("pickup_day = 4").limit(5).withColumn("extra", F.lit(9.0))
    overwrite_partitions(strays, table, "trip_id")
    assert spark.table(table).count() == trips.count()
    assert spark.table(table).filter("extra = 9").count() == 5


def test_writes_of_two_threads(spark, trips):
    """Modes of two writes at a time do not cross."""
    from concurrent.futures import ThreadPoolExecutor

    tables = []
    for _ in range(2):
        name = f"tests_{uuid.uuid4().hex[:10]}"
        create_tables(spark, name, scratch(spark, "tables"))
        tables.append(f"{name}.{TRIPS.name}")
    append(trips, tables[0])
    day = trips.filter("pickup_day = 3")
    with ThreadPoolExecutor(2) as pool:
        one = pool.submit(lambda: [overwrite_partitions(day, tables[0], "trip_id") for _ in range(3)])
        two = pool.submit(lambda: [append(day, tables[1]) for _ in range(3)])
        one.result(), two.result()
    assert spark.table(tables[0]).count() == trips.count()
    assert spark.table(tables[1]).count() == 3 * day.count()


def test_rerun_leaves_no_stale_events(spark, namespace, trips):
    append(trips, f"{namespace}.{TRIPS.name}")
    jobs.aggregate(spark, namespace, mode="overwrite_partitions")
    events = f"{namespace}.{ANOMALIES.name}"
    assert spark.table(events).count() == 146
    replace(trips.withColumn("fare_amount", F.lit(1.0)), f"{namespace}.{TRIPS.name}")
    jobs.aggregate(spark, namespace, mode="overwrite_partitions")
    assert spark.table(events).count() == 0


def test_failed_write_of_a_replacement(spark, namespace, trips, monkeypatch):
    """The write itself fails after the old rows have gone: they are put back.

    Of a table without versions; one that has them never loses its old rows."""
    table = f"{namespace}.{TRIPS.name}"
    replace(trips, table)
    whole = write._insert

    def broken(df, table, verb, mode):
        monkeypatch.setattr(write, "_insert", whole)
        whole(df.limit(1), table, verb, mode)
        raise RuntimeError("tasks lost")

    monkeypatch.setattr(write, "_insert", broken)
    with pytest.raises(RuntimeError):
        replace(trips.filter("pickup_day < 9"), table)
    assert spark.table(table).count() == trips.count()
    assert not write.recover(spark, table)


def test_replacement_is_finished_after_a_crash(spark, namespace, trips, folder):
    table = f"{namespace}.{HOURLY.name}"
    replace(hourly(trips), table)
    spark.table(table).filter("pickup_day < 3").write.parquet(folder)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{write.REPLACING}' = '{folder}')")
    assert write.recover(spark, table)
    assert spark.table(table).count() == 48
    assert not write.recover(spark, table)


def test_value_that_does_not_fit_leaves_the_table(spark, namespace, trips):
    table = f"{namespace}.{HOURLY.name}"
    replace(hourly(trips), table)
    with pytest.raises(PySparkException):
        replace(hourly(trips).withColumn("pickup_hour", F.lit(2**40)), table)
    assert spark.table(table).count() == 720


def test_file_ids_over_two_ingests(spark, namespace, events, folder):
    raw_trips(events).drop("event_id").repartition(3).write.parquet(folder)
    for _ in range(2):
        jobs.ingest(spark, folder, namespace, ids="file")
    found = spark.table(f"{namespace}.{TRIPS.name}")
    assert found.count() == found.select("trip_id").distinct().count() == 2 * 7890


def test_settings_are_restored(spark):
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    with pytest.raises(RuntimeError), settings(spark, {key: "dynamic"}):
        assert spark.conf.get(key) == "dynamic"
        raise RuntimeError
    assert spark.conf.get(key) == before


def test_tables_found_again(spark, trips):
    """A new catalog entry over an existing folder sees its partitions."""
    from tripflow.session import scratch

    place = scratch(spark, "place")
    create_tables(spark, "found_a", place)
    append(trips, f"found_a.{TRIPS.name}")
    create_tables(spark, "found_b", place)
    assert spark.table(f"found_b.{TRIPS.name}").count() == trips.count()


@pytest.mark.parametrize("external", [True, False])
def test_purge(spark, namespace, trips, folder, external):
    table = f"{namespace}.{TRIPS.name}"
    if not external:
        spark.sql(f"CREATE DATABASE managed LOCATION '{folder}'")
        create_tables(spark, "managed")
        table = f"managed.{TRIPS.name}"
    append(trips, table)
    root = location(spark, table)
    kept = trips.filter("pickup_datetime >= '2024-01-20'")
    assert purge(spark, table, date(2024, 1, 20)) == 19
    assert spark.table(table).count() == kept.count()
    assert spark.read.parquet(root).count() == kept.count()
    assert purge(spark, table, date(2024, 1, 20)) == 0
    if not external:
        spark.sql("DROP DATABASE managed CASCADE")


def test_purge_by_month(spark, namespace, trips):
    table = f"{namespace}.{HOURLY.name}"
    append(hourly(trips), table)
    rows = spark.table(table).count()
    assert purge(spark, table, date(2024, 1, 31)) == 0
    assert spark.table(table).count() == rows
    assert purge(spark, table, date(2024, 2, 1)) == 1
    assert spark.table(table).count() == 0


def test_jobs(spark, namespace, events):
    raw = raw_trips(events)
    counts = jobs.ingest(spark, raw, namespace, F.col("event_id"), mode="overwrite_partitions")
    assert {r.stage: r.rows for r in counts.collect()} == {"raw": 10000, "trips": 7890}
    for _ in range(2):
        counts = jobs.aggregate(spark, namespace, event_id="hash", mode="overwrite_partitions")
        found = {r.stage: r.rows for r in counts.collect()}
        assert found == {"trips": 7890, "hourly": 720, "anomalies": 146}
    jobs.aggregate(spark, namespace)
    ids = spark.table(f"{namespace}.{ANOMALIES.name}").select("event_id")
    assert ids.count() == ids.distinct().count() == 292


def test_ingest_from_a_path(spark, namespace, events, folder):
    raw_trips(events).drop("event_id").repartition(3).write.parquet(folder)
    jobs.ingest(spark, folder, namespace)
    trips = spark.table(f"{namespace}.{TRIPS.name}")
    assert trips.count() == trips.select("trip_id").distinct().count() == 7890
