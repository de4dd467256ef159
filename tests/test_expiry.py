"""What runs leave behind goes by age, and nothing that is in use."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tripflow.operators.hourly import hourly
from tripflow.tables.catalog import location
from tripflow.tables.compact import WORK
from tripflow.tables.expiry import expire, expired, register
from tripflow.tables.files import Files
from tripflow.tables.versions import Versions
from tripflow.tables.write import append, replace

NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)


@pytest.fixture
def tables(spark, namespace, trips):
    for hour in (3, 6):
        replace(hourly(trips.where(F.col("pickup_hour") < hour)), f"{namespace}.taxi_hourly_agg")
    append(trips.where("pickup_day = 1"), f"{namespace}.taxi_trips")
    return [f"{namespace}.taxi_hourly_agg", f"{namespace}.taxi_trips"]


def test_age_decides(spark):
    rows = [
        ("scratch", "old", NOW - timedelta(days=7, seconds=1), 1, False),
        ("scratch", "edge", NOW - timedelta(days=7), 1, False),
        ("scratch", "new", NOW, 1, False),
        ("version", "used", NOW - timedelta(days=700), 1, True),
    ]
    found = spark.createDataFrame(rows, "kind string, path string, changed timestamp, bytes long, in_use boolean")
    assert [r.path for r in expired(found, NOW).collect()] == ["old"]
    assert {r.path for r in expired(found, NOW, timedelta(0)).collect()} == {"old", "edge"}


def test_versions_in_use_stay(spark, tables):
    later = datetime.now(timezone.utc) + timedelta(days=30)
    before = spark.table(tables[0]).count()
    told = expire(spark, tables, at=later, dry=True).collect()
    assert sorted(r.removed for r in told) == [False, True]
    assert register(spark, tables).count() == 2
    expire(spark, tables, at=later)
    left = register(spark, tables).collect()
    assert [r.path for r in left] == [location(spark, tables[0])] and left[0].in_use
    assert spark.table(tables[0]).count() == before
    replace(spark.table(tables[0]), tables[0])
    assert spark.table(tables[0]).count() == before


def test_an_older_version_that_the_catalog_uses_stays(spark, tables):
    """Someone has gone back to it."""
    from tripflow.tables.catalog import point_to, versions_root

    versions = Versions(spark, versions_root(spark, tables[0]))
    point_to(spark, tables[0], versions.path(1))
    expire(spark, tables, at=datetime.now(timezone.utc) + timedelta(days=30))
    assert spark.table(tables[0]).count() == 90 and versions.numbers() == [1, 2]


def test_work_folders(spark, tables):
    work = f"{location(spark, tables[1])}/{WORK}"
    files = Files(spark, work)
    for name in ("dead", "swapping"):
        files.mark(f"{work}/{name}/inputs/part")
    files.mark(f"{work}/swapping/READY")
    for path in files.walk(work):
        files.date_back(path, 20)
    expire(spark, tables)
    assert files.names(work) == ["swapping"]


def test_scratch_folders(spark, tables, folder):
    files = Files(spark, folder)
    files.mark(f"{folder}/old/a")
    files.mark(f"{folder}/mixed/a")
    files.mark(f"{folder}/mixed/deep/b")
    files.make(f"{folder}/empty")
    files.date_back(f"{folder}/old/a", 8)
    files.date_back(f"{folder}/mixed/a", 8)
    told = {r.path.rsplit("/", 1)[1]: r.removed for r in expire(spark, (), folder).collect()}
    assert told == {"old": True, "mixed": False, "empty": False}
    assert sorted(files.names(folder)) == ["empty", "mixed"]


def test_nothing_left_behind(spark, folder):
    assert expire(spark, (), f"{folder}/none").collect() == []
