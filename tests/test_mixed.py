"""Files of different schemas, their footers, and the layout of tables."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tripflow.functions.identity import with_file_ids
from tripflow.plans import jobs
from tripflow.schemas import TRIPS
from tripflow.session import settings
from tripflow.sources.events import raw_trips
from tripflow.sources.footers import footers, list_parquet
from tripflow.sources.mixed import PLACE, read_mixed
from tripflow.tables.audit import layout
from tripflow.tables.write import append

WANTED = (
    StructType().add("n", "integer").add("big", "long").add("x", "double").add("t", "timestamp")
    .add("s", "string")
)


def write(spark, folder, ddl, *rows):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(folder)


def read(spark, folder):
    found = read_mixed(spark, folder, WANTED).select(*WANTED.names)
    return sorted(map(tuple, found.collect()), key=str)


def test_types_names_and_order(spark, folder):
    write(spark, folder, "n int, big bigint, x double, s string", (1, 2, 3.5, "a"))
    write(spark, folder, "X float, N double, BIG int, more string", (0.25, 7.0, 8, "?"), (None, None, None, None), (1.0, float("nan"), 1, ""))
    write(spark, folder, "n string, s int, x decimal(8,2), big double", ("12", 5, None, 2.0**40))
    assert read(spark, folder) == sorted(
        [
            (1, 2, 3.5, None, "a"), (7, 8, 0.25, None, None), (None,) * 5, (None, 1, 1.0, None, None),
            (12, 2**40, None, None, "5"),
        ],
        key=str,
    )


@pytest.mark.parametrize(
    ("ddl", "value"),
    [("n double", 1.5), ("n double", 2.0**31), ("n bigint", 2**31), ("n string", "x"),
     ("big double", 2.0**63), ("n double", float("inf")), ("x string", "y")],
)
def test_values_that_do_not_fit_are_shown(spark, folder, ddl, value):
    write(spark, folder, ddl, (value,))
    with pytest.raises(PySparkException, match="is no"):
        read(spark, folder)


def test_timestamps_of_all_kinds(spark, folder):
    spark.sql("SELECT TIMESTAMP '2024-01-01 05:00:00' AS t").write.parquet(f"{folder}/a")
    spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 05:00:00' AS t").write.parquet(f"{folder}/b")
    with settings(spark, {"spark.sql.parquet.outputTimestampType": "INT96"}):
        spark.sql("SELECT TIMESTAMP '2024-01-01 05:00:00' AS t").write.parquet(f"{folder}/c")
    table = pa.table({"t": pa.array([1704085200000], pa.timestamp("ms"))})
    place = f"{folder}/b".removeprefix("file:")
    pq.write_table(table, f"{place}/by-arrow.parquet")
    assert {str(r[3]) for r in read(spark, folder)} == {"2024-01-01 05:00:00"}
    assert len(read(spark, folder)) == 4


def test_no_files_and_no_wanted_columns(spark, folder):
    write(spark, folder, "other int", (1,), (2,))
    assert read(spark, folder) == [(None,) * 5] * 2
    spark.range(0).write.parquet(f"{folder}-empty")
    assert read(spark, f"{folder}-empty") == []


def test_ingest_of_months_that_differ(spark, namespace, events, folder):
    raw = raw_trips(events).drop("event_id")
    raw.where("passenger_count < 4").write.mode("append").parquet(folder)
    other = raw.where("passenger_count >= 4").withColumns(
        {"passenger_count": F.col("passenger_count").cast("double"), "VendorID": F.col("VendorID").cast("bigint")}
    )
    other.write.mode("append").parquet(folder)
    jobs.ingest(spark, folder, namespace, ids="file")
    jobs.ingest(spark, folder, namespace, ids="source")
    found = spark.table(f"{namespace}.{TRIPS.name}")
    assert found.count() == 2 * 7890 == found.select("trip_id").distinct().count()


def test_columns_and_filters_reach_each_scan(spark, folder):
    write(spark, folder, "n int, x double", (1, 2.0))
    write(spark, folder, "n double, x double", (1.0, 2.0))
    plan = read_mixed(spark, folder, WANTED).where("x > 1").select("x")._jdf.queryExecution().toString()
    scans = [line for line in plan.split("== Physical Plan ==")[1].split("\n") if "FileScan" in line]
    assert len(scans) == 2
    assert all("ReadSchema: struct<x:double" in s and "GreaterThan(x,1.0)" in s for s in scans)
    assert not any("n:" in s.split("ReadSchema: ")[1] for s in scans)


def test_file_ids_leave_rows_where_they_are(spark, folder):
    spark.range(1000).repartition(5).write.parquet(folder)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "100"}):
        found = with_file_ids(spark.read.parquet(folder), "row", 7)
        assert "SortMergeJoin" not in found._jdf.queryExecution().toString()
        assert found.select("row").distinct().count() == 1000
    assert {r[0] for r in found.select(F.shiftright("row", 40)).distinct().collect()} == set(range(7, 12))


def test_file_ids_of_a_mixed_read(spark, folder):
    write(spark, folder, "n int", (1,), (2,))
    write(spark, folder, "n double", (3.0,))
    rows = read_mixed(spark, folder, WANTED)
    found = with_file_ids(rows, "row", path="_source_path", place=PLACE)
    assert found.select("row").distinct().count() == 3


def test_footers(spark, folder):
    path = folder.removeprefix("file:")
    spark.range(10).write.parquet(folder)
    pq.write_table(pa.table({"x": list(range(100))}), f"{path}/more.parquet", compression="zstd", row_group_size=30)
    found = footers(list_parquet(spark, folder)).collect()
    more = next(r for r in found if r.path.endswith("more.parquet"))
    assert (more.rows, more.row_groups, more.codecs) == (100, 4, ["ZSTD"])
    assert [(c.name, c.type) for c in more.columns] == [("x", "bigint")]
    assert sum(r.rows for r in found) == 110 and min(r.bytes for r in found) > 0


def test_layout(spark, namespace, trips):
    table = f"{namespace}.{TRIPS.name}"
    assert layout(spark, table).collect() == []
    days = trips.where("pickup_day < 3")
    append(days, table)
    append(days.where("pickup_day = 2"), table)
    found = {r.partition[-1]: r for r in layout(spark, table).collect()}
    assert found["1"].files == 1 and found["2"].files == 2
    assert found["2"].rows == 2 * days.where("pickup_day = 2").count()
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('tripflow.target-file-size-bytes' = '{found['1'].bytes}')")
    again = {r.partition[-1]: r for r in layout(spark, table).collect()}
    assert again["1"].well_sized == 1 and again["1"].share_well_sized == 1.0
