"""Compaction: same rows, fewer files, safe to interrupt."""

import re

import pytest
from pyspark.sql import functions as F

from tripflow.schemas import TRIPS
from tripflow.tables import compact as module
from tripflow.tables.catalog import location
from tripflow.tables.compact import WORK, compact, list_files, recover
from tripflow.tables.files import Files
from tripflow.tables.write import settings


def insert(df, table):
    """As the tasks deliver them: one file per task and day."""
    df.sparkSession.sql(f"INSERT INTO {table} BY NAME SELECT * FROM {{rows}}", rows=df)


@pytest.fixture
def table(spark, namespace, trips):
    """Six files per day, but two on day 3 and three on day 4."""
    name = f"{namespace}.{TRIPS.name}"
    insert(trips.filter("pickup_day NOT IN (3, 4)").repartition(6), name)
    insert(trips.filter("pickup_day = 3").repartition(2), name)
    insert(trips.filter("pickup_day = 4").repartition(3), name)
    return name


def files_per_day(spark, table):
    found = list_files(spark, location(spark, table)).groupBy("pickup_day").count()
    return {r.pickup_day: r["count"] for r in found.collect()}


def names(spark, table, day):
    found = list_files(spark, location(spark, table)).filter(F.col("pickup_day") == day)
    return {r.path for r in found.select("path").collect()}


def explained(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def same_rows(spark, table, trips):
    held = spark.table(table).select(*trips.columns)
    return (
        held.count() == trips.count()
        and held.exceptAll(trips).count() == 0
        and trips.exceptAll(held).count() == 0
    )


def test_small_files(spark, table, trips):
    untouched = names(spark, table, 3)
    before = files_per_day(spark, table)
    assert before[3] == 2 and before[4] == 3 and before[5] == 6
    report = {r.partition: r for r in compact(spark, table).collect()}
    after = files_per_day(spark, table)
    assert after[3] == 2 and names(spark, table, 3) == untouched
    assert all(n == 1 for day, n in after.items() if day != 3)
    assert len(report) == len(before) - 1
    day = report["pickup_year=2024/pickup_month=1/pickup_day=5"]
    assert day.rewritten_files == 6 and day.added_files == 1
    assert day.rewritten_bytes > day.added_bytes > 0
    assert same_rows(spark, table, trips)
    assert Files(spark, location(spark, table)).names(f"{location(spark, table)}/{WORK}") == []


def test_second_run_does_nothing(spark, table, trips):
    compact(spark, table)
    before = names(spark, table, 5)
    assert compact(spark, table).count() == 0
    assert names(spark, table, 5) == before and same_rows(spark, table, trips)


def test_good_files_stay(spark, namespace, trips):
    name = f"{namespace}.{TRIPS.name}"
    insert(trips.filter("pickup_day = 9").coalesce(1), name)
    good = names(spark, name, 9)
    size = list_files(spark, location(spark, name)).first().length
    insert(trips.filter("pickup_day = 9").limit(30).repartition(5), name)
    rows = spark.table(name).count()
    report = compact(spark, name, target_file_size_bytes=size).collect()
    assert report[0].rewritten_files == 5
    assert good < names(spark, name, 9) and len(names(spark, name, 9)) <= 3
    assert spark.table(name).count() == rows


def test_hot_partition_uses_many_files(spark, namespace, trips):
    """All rows, a third of them copies of one, on one day."""
    name = f"{namespace}.{TRIPS.name}"
    copies = F.explode(F.sequence(F.lit(1), F.lit(4000)))
    one = trips.limit(1).drop("pickup_day").withColumn("copy", copies).drop("copy")
    rows = trips.drop("pickup_day").unionByName(one).withColumn("pickup_day", F.lit(1))
    insert(rows.repartition(24), name)
    sizes = list_files(spark, location(spark, name)).agg(F.sum("length")).first()[0]
    target = sizes // 5
    compact(spark, name, target_file_size_bytes=target)
    found = [r.length for r in list_files(spark, location(spark, name)).collect()]
    assert 2 <= len(found) <= 5
    assert max(found) <= 1.25 * target
    assert spark.table(name).count() == rows.count()


def test_interrupted_while_staging(spark, table, trips, monkeypatch):
    def lost(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(module, "_report", lost)
    with pytest.raises(RuntimeError):
        compact(spark, table)
    assert same_rows(spark, table, trips)
    monkeypatch.undo()
    recover(spark, table)
    assert same_rows(spark, table, trips) and files_per_day(spark, table)[5] == 6
    compact(spark, table)
    assert same_rows(spark, table, trips) and files_per_day(spark, table)[5] == 1


@pytest.mark.parametrize("moves", [0, 3, 40, 180])
def test_interrupted_while_swapping(spark, table, trips, monkeypatch, moves):
    done = []
    move = Files.move

    def stop_after(self, source, target):
        if len(done) >= moves:
            raise RuntimeError("driver lost")
        done.append(source)
        move(self, source, target)

    monkeypatch.setattr(Files, "move", stop_after)
    with pytest.raises(RuntimeError):
        compact(spark, table)
    monkeypatch.undo()
    recover(spark, table)
    assert same_rows(spark, table, trips)
    assert files_per_day(spark, table)[5] == 1


@pytest.mark.parametrize("left", ["READY", "inputs", "old"])
def test_interrupted_while_clearing_up(spark, table, trips, monkeypatch, left):
    """After the swap the run's folder goes piece by piece."""
    delete = Files.delete

    def piecemeal(self, path):
        if path.endswith("READY") or f"/{WORK}/" not in path:
            return delete(self, path)
        for name in self.names(path):
            if name != left:
                delete(self, f"{path}/{name}")
        raise RuntimeError("driver lost")

    monkeypatch.setattr(Files, "delete", piecemeal)
    with pytest.raises(RuntimeError):
        compact(spark, table)
    monkeypatch.undo()
    spark.catalog.refreshTable(table)
    assert same_rows(spark, table, trips)
    assert compact(spark, table).count() == 0
    assert same_rows(spark, table, trips)


def test_many_files_without_broadcast(spark, table, trips):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        compact(spark, table)
    assert files_per_day(spark, table)[5] == 1 and same_rows(spark, table, trips)


def test_scan_reads_chosen_partitions(spark, table, trips):
    """One day of all gets small files again; the scan is cut to that day."""
    compact(spark, table)
    insert(trips.filter("pickup_day = 7").repartition(4), table)
    target = module.TARGET_FILE_BYTES
    inputs = module.durable(module.plan_rewrite(spark, table, target, 3), "inputs")
    assert {r.pickup_day for r in inputs.collect()} == {7}
    old = module.chosen_rows(spark, table, inputs, target)
    read = old.agg(F.count(F.lit(1)))
    read.collect()
    filters = re.findall(r"PartitionFilters: \[(.*)\]", explained(read))
    assert any("pickup_day" in f and ">= 7" in f and "<= 7" in f for f in filters)
    assert old.count() == 2 * trips.filter("pickup_day = 7").count()
    compact(spark, table)
    assert files_per_day(spark, table)[7] == 1
    assert same_rows(spark, table, trips.unionByName(trips.filter("pickup_day = 7")))


def test_partition_without_value(spark, namespace, trips):
    name = f"{namespace}.{TRIPS.name}"
    days = trips.filter("pickup_day IN (5, 6)")
    rows = days.withColumn("pickup_day", F.expr("nullif(pickup_day, 6)"))
    insert(rows.repartition(4), name)
    compact(spark, name)
    assert same_rows(spark, name, rows)
    assert list_files(spark, location(spark, name)).count() == 2


def test_swap_leaves_one_partition_incomplete_at_most(spark, table, monkeypatch):
    """Every partition's old files and new files move one after the other."""
    folders = []
    move = Files.move

    def noted(self, source, target):
        folders.append(target.split("pickup_day=")[1].split("/")[0])
        move(self, source, target)

    monkeypatch.setattr(Files, "move", noted)
    compact(spark, table)
    turns = [f for i, f in enumerate(folders) if i == 0 or folders[i - 1] != f]
    assert len(turns) == len(set(turns)) > 1


def test_files_arriving_meanwhile_stay(spark, table, trips, monkeypatch):
    """Files written after the plan was made are neither rewritten nor lost."""
    plan = module.plan_rewrite

    def plan_then_insert(*args):
        frozen = module.durable(plan(*args), "plan")
        insert(trips.filter("pickup_day = 5").repartition(4), table)
        return frozen

    monkeypatch.setattr(module, "plan_rewrite", plan_then_insert)
    compact(spark, table)
    assert files_per_day(spark, table)[5] == 5
    twice = trips.unionByName(trips.filter("pickup_day = 5"))
    assert same_rows(spark, table, twice)
