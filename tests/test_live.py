"""Statistics that follow a stream, and the hourly table by deliveries."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from tripflow.functions.moments import deviation_of, merged_moments, moments
from tripflow.operators import hourly_state
from tripflow.operators.anomaly import detect, hour_stats
from tripflow.operators.clean import clean
from tripflow.operators.hourly import hourly
from tripflow.operators.hourly_state import HourStates, hourly_from, merged_states
from tripflow.plans import jobs
from tripflow.sources.events import raw_trips
from tripflow.sources.raw import stream_raw
from tripflow.streaming import intake
from tripflow.streaming.live import LiveStatistics, detect_live


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_merged_moments_equal_those_of_all(spark):
    rows = [(k, float(v)) for k in range(3) for v in range(k, 40, k + 1)] + [(3, 5.0), (4, None), (5, 2.0), (5, 2.0)]
    table = spark.createDataFrame(rows, "k int, x double")
    parts = table.groupBy("k", (F.coalesce("x", F.lit(0)) % 7).alias("p")).agg(*moments("x", "x"))
    merged = merged_moments(parts, ["k"], "x").select("k", "x_count", "x_mean", deviation_of("x").alias("d"))
    whole = table.where("x IS NOT NULL").groupBy("k").agg(F.count("x"), F.avg("x"), F.stddev_samp("x"))
    for a, b in zip(rows_of(merged), rows_of(whole), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2])
        assert (a[3] is None) == (b[3] is None) and (a[3] is None or a[3] == pytest.approx(b[3]))


def test_large_means_do_not_cancel(spark):
    table = spark.range(1000).select(F.lit(1).alias("k"), (F.col("id") % 2 + 1e9).alias("x"), (F.col("id") % 10).alias("p"))
    parts = table.groupBy("k", "p").agg(*moments("x", "x"))
    found = merged_moments(parts, ["k"], "x").select(deviation_of("x")).first()[0]
    assert found == pytest.approx(0.50025, rel=1e-4)


@pytest.fixture
def deliveries(spark, events):
    raw = raw_trips(events)
    return [raw.where(F.col("event_id") % 4 == n) for n in range(4)]


def fed(spark, folder, namespace, deliveries, **options):
    for delivery in deliveries:
        delivery.write.mode("append").parquet(f"{folder}/raw")
        stream = clean(stream_raw(spark, f"{folder}/raw", delivery.schema), F.col("event_id"))
        detect_live(stream, f"{folder}/log", namespace, **options).awaitTermination()
    return spark.table(f"{namespace}.anomaly_events")


def test_statistics_after_all_batches_equal_those_of_all_trips(spark, folder, namespace, deliveries, trips):
    fed(spark, folder, namespace, deliveries)
    held = LiveStatistics(spark, f"{folder}/log/statistics").read()
    found = held.select("pickup_hour", F.round("fare_mean", 6), F.round(deviation_of("fare"), 6))
    stats = hour_stats(trips).select("pickup_hour", F.round("mean_fare", 6), F.round("std_fare", 6))
    assert rows_of(found) == rows_of(stats)


def test_the_first_batch_without_history_has_no_events(spark, folder, namespace, deliveries):
    assert fed(spark, folder, namespace, deliveries[:1]).count() == 0


def test_history_scores_the_first_batch(spark, folder, namespace, deliveries, trips):
    found = fed(spark, folder, namespace, deliveries[:1], history=trips)
    mine = trips.where(F.col("trip_id") % 4 == 0)
    wanted = detect(mine, hour_stats(trips), event_id="hash")
    names = ["event_id", "severity"]
    assert rows_of(found.select(names)) == rows_of(wanted.select(names)) and found.count()


def test_a_batch_that_runs_again_changes_nothing(spark, folder, namespace, deliveries, monkeypatch):
    fed(spark, folder, namespace, deliveries[:2])
    real = intake.append

    def crash(df, table):
        real(df, table)
        raise RuntimeError("stopped between writing and committing")

    with monkeypatch.context() as broken:
        broken.setattr(intake, "append", crash)
        with pytest.raises(Exception, match="stopped"):
            fed(spark, folder, namespace, deliveries[2:3])
    # The next start first repeats the broken batch.
    found = rows_of(fed(spark, folder, namespace, deliveries[3:]).drop("detected_at"))
    assert len({r[0] for r in found}) == len(found)
    import uuid

    from tripflow.session import scratch
    from tripflow.tables.catalog import create_tables

    clean_run = f"tests_{uuid.uuid4().hex[:10]}"
    create_tables(spark, clean_run, scratch(spark, "tables"))
    wanted = fed(spark, scratch(spark, "clean"), clean_run, deliveries).drop("detected_at")
    names = ["event_id", "anomaly_type", "severity"]
    mine = spark.table(f"{namespace}.anomaly_events").select(names)
    assert rows_of(mine) == rows_of(wanted.select(names))
    spark.sql(f"DROP DATABASE {clean_run} CASCADE")


# The hourly table by deliveries


def test_an_update_reads_the_delivery_and_its_months(spark, folder, trips):
    states = HourStates(spark, f"{folder}/states")
    for number, month in enumerate((1, 2, 3), 1):
        trips.withColumn("pickup_month", F.lit(month)).write.parquet(f"{folder}/trips/{number}")
        states.add(spark.read.parquet(f"{folder}/trips/{number}"), number)
    trips.withColumn("pickup_month", F.lit(2)).write.parquet(f"{folder}/trips/4")
    changed = states.add(spark.read.parquet(f"{folder}/trips/4"), 4)
    assert not [f for f in changed.inputFiles() if "/trips/" in f]
    assert rows_of(changed.select("pickup_month").distinct()) == [(2,)]
    assert changed.agg(F.sum("total_trips")).first()[0] == 2 * trips.count()
    plan = changed._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan or "PartitionFilters: [isnotnull(pickup_year" in plan


def test_folding_changes_no_result(spark, folder, trips):
    states = HourStates(spark, folder)
    for number in range(1, 4):
        states.add(trips.where(F.col("trip_id") % 3 == number - 1), number)
    before = rows_of(merged_states(states.read()).drop("fares", "fare_mean", "fare_squares"))
    assert states.fold(at_least=2) and states.deliveries() == 3
    assert not states.fold(at_least=2)
    after = rows_of(states.read().select(merged_states(states.read()).drop("fares", "fare_mean", "fare_squares").columns))
    rounded = lambda rows: [[round(x, 6) if isinstance(x, float) else x for x in r] for r in rows]
    assert rounded(before) == rounded(after)
    with pytest.raises(ValueError, match="merged"):
        states.add(trips, 2)
    states.add(trips, 4)
    assert states.read().agg(F.sum("total_trips")).first()[0] == 2 * trips.count()


def test_a_crash_while_folding_counts_nothing_twice(spark, folder, trips, monkeypatch):
    states = HourStates(spark, folder)
    for number in range(1, 4):
        states.add(trips.where(F.col("trip_id") % 3 == number - 1), number)
    real = states.files.delete
    left = [3]

    def delete(path):
        left[0] -= 1
        if left[0] < 0:
            raise KeyboardInterrupt
        real(path)

    monkeypatch.setattr(states.files, "delete", delete)
    with pytest.raises(KeyboardInterrupt):
        states.fold(at_least=2)
    again = HourStates(spark, folder)
    assert again.read().agg(F.sum("total_trips")).first()[0] == trips.count()


def test_odd_values(spark, namespace):
    """NULL and NaN fares, NULL tips, an hour without any fare."""
    base = spark.read.parquet(str(TESTDATA / "sf0.001/events.parquet"))
    trips = clean(raw_trips(base), F.col("event_id"))
    fare = F.when(F.col("pickup_hour") == 1, F.lit(None)).when(F.col("trip_id") % 5 == 0, F.lit(float("nan")))
    odd = trips.withColumn("fare_amount", fare.otherwise(F.col("fare_amount")).cast("double"))
    odd = odd.withColumn("tip_amount", F.when(F.col("pickup_hour") != 2, F.col("tip_amount")))
    for number in (1, 2):
        jobs.update_hourly(spark, odd.where(F.col("trip_id") % 2 == number - 1), number, namespace)
    found = spark.table(f"{namespace}.taxi_hourly_agg").drop("computed_at")
    wanted = hourly(odd).drop("computed_at").select(found.columns)

    def plain(rows):
        out = []
        for row in rows:
            out.append(["nan" if isinstance(x, float) and math.isnan(x) else round(x, 1) if isinstance(x, float) else x for x in row])
        return sorted(out, key=str)

    assert plain(found.collect()) == plain(wanted.collect())


def test_large_hours_have_the_sketch_s_error(spark):
    n = 200_000
    hour = {"pickup_year": 2024, "pickup_month": 1, "pickup_day": 1, "pickup_hour": 0}
    rows = spark.range(n).select(
        *[F.lit(v).alias(k) for k, v in hour.items()],
        F.lit(1).alias("passenger_count"), F.lit(1.0).alias("trip_distance"), F.lit(1.0).alias("tip_amount"),
        F.lit(1.0).alias("total_amount"), F.col("id").cast("double").alias("fare_amount"), (F.col("id") % 3).alias("p"),
    )
    parts = [hourly_state.hour_states(rows.where(F.col("p") == i)) for i in range(3)]
    merged = merged_states(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    p95 = hourly_from(merged).first()["p95_fare"]
    assert abs(p95 / n - 0.95) < 0.005


def test_first_delivery_is_number_one(spark, folder, trips):
    with pytest.raises(ValueError):
        HourStates(spark, folder).add(trips, 0)
