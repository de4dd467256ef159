"""Replacing a table at once: readers, crashes, kept versions."""

import threading

import pytest
from pyspark.sql import functions as F

from tripflow.operators.hourly import hourly
from tripflow.schemas import HOURLY
from tripflow.tables import write
from tripflow.tables.catalog import create_tables, location, read_table, versions_root
from tripflow.tables.files import Files
from tripflow.tables.purge import purge
from tripflow.tables.versions import Versions
from tripflow.tables.write import append, replace


@pytest.fixture
def table(spark, namespace, trips):
    replace(hourly(trips), f"{namespace}.taxi_hourly_agg")
    return f"{namespace}.taxi_hourly_agg"


def test_readers_never_see_fewer_rows(spark, table):
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(spark.table(table).count())

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for _ in range(4):
            replace(spark.table(table), table)
    finally:
        stop.set()
        reader.join()
    assert set(seen) == {720} and len(seen) > 4


@pytest.mark.parametrize("step", ["write", "mark", "point_to", "prune"])
def test_a_crash_leaves_old_or_new(spark, table, monkeypatch, step):
    old = spark.table(table).count()
    new = spark.table(table).where("pickup_hour < 12")

    def crash(*args, **kwargs):
        raise KeyboardInterrupt(step)

    owner = {"write": Versions, "mark": Files, "point_to": write, "prune": Versions}[step]
    with monkeypatch.context() as broken:
        broken.setattr(owner, step, crash)
        with pytest.raises(KeyboardInterrupt):
            replace(new, table)
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == (360 if step == "prune" else old)
    replace(spark.table(table).where("pickup_hour < 6"), table)
    assert spark.table(table).count() == 180


def test_rows_that_fail_leave_the_table(spark, table):
    broken = spark.table(table).withColumn("total_trips", F.raise_error(F.lit("no")).cast("long"))
    with pytest.raises(Exception, match="no"):
        replace(broken, table)
    assert spark.table(table).count() == 720


def test_old_versions_go(spark, table):
    for _ in range(5):
        replace(spark.table(table), table)
    root = versions_root(spark, table)
    assert len(Versions(spark, root).numbers()) == write.KEPT
    assert len(Files(spark, root).names(root)) == 2 * write.KEPT


def test_a_new_catalog_finds_the_last_version(spark, folder, trips):
    create_tables(spark, "versions_a", folder)
    replace(hourly(trips), "versions_a.taxi_hourly_agg")
    replace(spark.table("versions_a.taxi_hourly_agg").where("pickup_hour = 3"), "versions_a.taxi_hourly_agg")
    create_tables(spark, "versions_b", folder)
    assert read_table(spark, HOURLY, "versions_b").count() == 30
    spark.sql("DROP DATABASE versions_a CASCADE")
    spark.sql("DROP DATABASE versions_b CASCADE")


def test_appends_and_more_columns(spark, table):
    more = spark.table(table).withColumn("extra", F.lit(7))
    rows = replace(more, table)
    assert rows.select("extra").distinct().collect() == [(7,)]
    append(spark.table(table).where("pickup_hour = 0"), table)
    assert spark.table(table).count() == 750 and "extra" not in spark.table(table).columns


def test_purge_of_a_versioned_table(spark, table):
    from datetime import date

    older = spark.table(table).withColumn("pickup_year", F.lit(2023))
    append(older, table)
    before = location(spark, table)
    assert purge(spark, table, date(2024, 1, 20)) == 1
    assert spark.table(table).count() == 720 and location(spark, table) != before


def test_an_empty_replacement(spark, table):
    replace(spark.table(table).where("false"), table)
    assert spark.table(table).count() == 0
