"""Groups of files: first fit by decreasing size, large files in pieces."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripflow.schemas import TRIPS
from tripflow.tables import binpack
from tripflow.tables.binpack import file_groups, first_fit
from tripflow.tables.catalog import location
from tripflow.tables.compact import compact, list_files


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=40))
def test_first_fit_by_hand(lengths):
    lengths = sorted(lengths, reverse=True)
    bins, expected = [], []
    for length in lengths:
        place = next((i for i, held in enumerate(bins) if held + length <= 100), len(bins))
        if place == len(bins):
            bins.append(0)
        bins[place] += length
        expected.append(place)
    assert first_fit(np.array(lengths, dtype=np.int64), 100).tolist() == expected


def groups(spark, files, target=100, min_files=3):
    table = spark.createDataFrame(files, "partition string, file string, length long")
    return {
        (r.partition, r.file): (r.chunk, r.bin, r.pieces)
        for r in file_groups(table, target, min_files).collect()
    }


def test_which_files_are_chosen(spark):
    files = [
        ("a", "good", 100), ("a", "1", 60), ("a", "2", 60), ("a", "3", 5), ("a", "large", 290),
        ("b", "1", 10), ("b", "2", 10),  # too few
        ("c", "large", 1000),  # alone, and split all the same
        ("d", "1", 70), ("d", "2", 70), ("d", "3", 70),  # no two fit together
        (None, "1", 1), (None, "2", 1), (None, "3", 1),
        ("e", "edge-low", 75), ("e", "edge-high", 180), ("e", "empty", 0),
    ]
    found = groups(spark, files)
    assert found == {
        ("a", "1"): (0, 0, 1), ("a", "2"): (0, 0, 1), ("a", "3"): (0, 0, 1), ("a", "large"): (0, 1, 3),
        ("c", "large"): (0, 0, 10),
        (None, "1"): (0, 0, 1), (None, "2"): (0, 0, 1), (None, "3"): (0, 0, 1),
    }


def test_long_lists_are_packed_in_runs(spark, monkeypatch):
    monkeypatch.setattr(binpack, "CHUNK", 7)
    files = [("a", f"{i:03}", 20 + i % 30) for i in range(60)]
    found = groups(spark, files)
    # A file that is alone in its group stays, at most one or two of a run.
    assert len(found) > 50 and {c for c, _, _ in found.values()} == set(range(9))
    held = {}
    for (_, name), (chunk, group, _) in found.items():
        held[chunk, group] = held.get((chunk, group), 0) + 20 + int(name) % 30
    assert max(held.values()) <= 125


def test_no_files(spark):
    assert groups(spark, []) == {}


def days(spark, table):
    found = list_files(spark, location(spark, table)).groupBy("pickup_day").count()
    return {r.pickup_day: r["count"] for r in found.collect()}


@pytest.fixture
def lone(spark, namespace, trips):
    """One file on each of four days."""
    name = f"{namespace}.{TRIPS.name}"
    rows = trips.filter("pickup_day < 5").repartition("pickup_day")
    spark.sql(f"INSERT INTO {name} BY NAME SELECT * FROM {{rows}}", rows=rows)
    return name


def test_a_lone_large_file_is_split(spark, lone, trips):
    size = list_files(spark, location(spark, lone)).agg(F.max("length")).first()[0]
    report = compact(spark, lone, target_file_size_bytes=size // 4)
    assert all(n >= 3 for n in days(spark, lone).values())
    assert {r.rewritten_files for r in report.collect()} == {1}
    held = spark.table(lone).select(*trips.columns)
    assert held.exceptAll(trips).isEmpty() and held.count() == trips.filter("pickup_day < 5").count()
    # Even runs of the old file's rows.
    found = spark.table(lone).groupBy("pickup_day", F.col("_metadata.file_name")).count()
    for day in range(1, 5):
        counts = [r["count"] for r in found.where(F.col("pickup_day") == day).collect()]
        assert max(counts) - min(counts) <= 1


def test_files_of_good_size_are_not_read(spark, lone, trips):
    """A file of good size that cannot be read at all does no harm."""
    from tripflow.tables.files import Files

    size = list_files(spark, location(spark, lone)).agg(F.max("length")).first()[0]
    rows = trips.filter("pickup_day = 2").limit(30).repartition(5)
    spark.sql(f"INSERT INTO {lone} BY NAME SELECT * FROM {{rows}}", rows=rows)
    good = list_files(spark, location(spark, lone)).where("pickup_day = 2").orderBy(F.desc("length"))
    path = good.first()["path"].removeprefix("file:")
    whole = open(path, "rb").read()
    with open(path, "wb") as spoilt:
        spoilt.write(b"x" * len(whole))
    crc = f"{path.rsplit('/', 1)[0]}/.{path.rsplit('/', 1)[1]}.crc"
    Files(spark, crc).delete(crc)
    report = compact(spark, lone, target_file_size_bytes=size).collect()
    assert [r.rewritten_files for r in report] == [5] and report[0].added_files <= 2
    with open(path, "wb") as mended:
        mended.write(whole)
    assert spark.table(lone).count() == trips.filter("pickup_day < 5").count() + 30
