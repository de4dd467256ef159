"""Scores, thresholds, statistics and skewed inputs."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tripflow.operators.anomaly import classify, detect, hour_stats, score
from tripflow.operators.hourly import hour_stats_from, hourly
from tripflow.schemas import ANOMALIES

NAN = float("nan")
BOUNDARIES = {
    -6.1: ("low_fare", "HIGH"),
    -6.0: ("low_fare", "MEDIUM"),
    -4.0: ("low_fare", "LOW"),
    -3.1: ("low_fare", "LOW"),
    -3.0: None,
    0.0: None,
    3.0: None,
    3.1: ("surge_fare", "LOW"),
    4.0: ("surge_fare", "LOW"),
    4.1: ("surge_fare", "MEDIUM"),
    6.0: ("surge_fare", "MEDIUM"),
    6.1: ("surge_fare", "HIGH"),
}


def test_boundaries(spark):
    values = [*BOUNDARIES, None, NAN]
    scored = spark.createDataFrame([(v,) for v in values], "z_score double")
    found = classify(scored).collect()
    nan = [r for r in found if math.isnan(r.z_score)]
    assert [(r.anomaly_type, r.severity) for r in nan] == [("surge_fare", "HIGH")]
    plain = {r.z_score: (r.anomaly_type, r.severity) for r in found if r not in nan}
    assert plain == {z: kind for z, kind in BOUNDARIES.items() if kind}


def fares(spark, rows):
    """(hour, fare) pairs as trips."""
    return spark.createDataFrame(rows, "pickup_hour int, fare_amount double").withColumns(
        {
            "trip_id": F.monotonically_increasing_id(),
            "pickup_datetime": F.to_timestamp(F.lit("2024-01-01 00:00:00")),
            "pickup_year": F.lit(2024),
            "pickup_month": F.lit(1),
            "pickup_day": F.lit(1),
            "passenger_count": F.lit(1),
            "trip_distance": F.lit(1.0),
            "tip_amount": F.lit(0.0),
            "total_amount": F.col("fare_amount"),
        }
    )


EDGE_HOURS = (
    [(1, 5.0)]
    + [(2, 7.0)] * 20
    + [(3, 1.0 + i % 3) for i in range(40)]
    + [(3, 500.0)]
    + [(4, 1.0), (4, 2.0), (4, NAN)]
    + [(None, 9.0)]
)


def test_undefined_deviations_yield_no_event(spark):
    scored = score(fares(spark, EDGE_HOURS))
    assert scored.count() == len(EDGE_HOURS)
    assert {r.pickup_hour for r in scored.filter("z_score IS NOT NULL").collect()} == {3, 4}
    found = detect(fares(spark, EDGE_HOURS)).collect()
    # A NaN fare makes mean and deviation of its hour NaN, and NaN passes every threshold.
    assert sorted(r.anomaly_type for r in found) == ["surge_fare"] * 4
    assert sum(r.severity == "HIGH" and math.isnan(r.z_score) for r in found) == 3


@pytest.mark.parametrize("fare", [0.1, 7.35, 1e-9, 123456.789])
def test_equal_fares_have_no_spread_however_they_are_split(spark, fare):
    trips = fares(spark, [(5, fare)] * 1000 + [(6, fare + 1)]).repartition(13)
    merged = hour_stats_from(hourly(trips, moments=True))
    for stats in (hour_stats(trips), merged):
        assert {r.pickup_hour: r.std_fare for r in stats.collect()} == {5: 0.0, 6: None}
        assert detect(trips, stats).count() == 0


def test_event_columns(spark, trips):
    found = detect(trips)
    assert [(f.name, f.dataType) for f in found.schema] == [
        (f.name, f.dataType) for f in ANOMALIES.columns
    ]
    again = [detect(trips, event_id="hash").select("event_id").collect() for _ in range(2)]
    assert sorted(again[0]) == sorted(again[1])
    with pytest.raises(ValueError):
        detect(trips, event_id="other")


def test_thresholds_are_parameters(trips):
    assert detect(trips, threshold=2.0).count() > detect(trips).count()
    wide = detect(trips, steps=(3.0, 3.0)).groupBy("severity").count().collect()
    assert [r.severity for r in wide] == ["HIGH"]


def test_stats_merge_like_direct(trips):
    direct = {r.pickup_hour: r for r in hour_stats(trips).collect()}
    merged = hour_stats_from(hourly(trips, moments=True)).collect()
    assert len(merged) == len(direct) == 24
    for row in merged:
        assert row.mean_fare == pytest.approx(direct[row.pickup_hour].mean_fare, rel=1e-12)
        assert row.std_fare == pytest.approx(direct[row.pickup_hour].std_fare, rel=1e-12)


def test_merged_stats_of_edges(spark):
    rows = [(h, f) for h, f in EDGE_HOURS if h is not None and f == f]
    trips = fares(spark, rows).withColumn("pickup_day", (F.col("trip_id") % 5 + 1).cast("int"))
    direct = {r.pickup_hour: r.std_fare for r in hour_stats(trips).collect()}
    merged = hour_stats_from(hourly(trips, moments=True)).collect()
    for row in merged:
        want = direct[row.pickup_hour]
        assert row.std_fare == (want if want is None else pytest.approx(want, abs=1e-9))


def test_trips_are_not_shuffled(trips):
    plan = detect(trips)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_skewed_hour(spark):
    """A third of all trips in one hour, against plain Python."""
    rows = [(8, 10.0 + (i * 37 % 101) / 10) for i in range(3000)] + [(8, 900.0)]
    rows += [(h, 5.0 + (i * 13 % 7)) for h in range(24) if h != 8 for i in range(260)]
    found = detect(fares(spark, rows).repartition(16)).collect()
    hours = {}
    for hour, fare in rows:
        hours.setdefault(hour, []).append(fare)
    want = 0
    for values in hours.values():
        mean = sum(values) / len(values)
        sd = math.sqrt(sum((v - mean) ** 2 for v in values) / (len(values) - 1))
        want += sum(abs((v - mean) / sd) > 3 for v in values)
    assert len(found) == want == 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(0, 2), st.integers(1, 5000)), min_size=5, max_size=60
    ),
    st.integers(1, 1000),
)
def test_constant_shift_keeps_scores(spark, pairs, shift):
    rows = [(h, cents / 100) for h, cents in pairs]
    moved = [(h, cents / 100 + shift) for h, cents in pairs]
    one = [r.z_score for r in score(fares(spark, rows).coalesce(1)).orderBy("trip_id").collect()]
    two = [r.z_score for r in score(fares(spark, moved).coalesce(1)).orderBy("trip_id").collect()]
    for a, b in zip(one, two, strict=True):
        if a is None or b is None or abs(a) < 1e-6:
            continue
        assert a == pytest.approx(b, abs=1e-6)


def test_hours_cover_all_trips(trips):
    hours = hourly(trips)
    assert hours.agg(F.sum("total_trips")).first()[0] == trips.count()
    assert detect(trips).filter("abs(z_score) <= 3").count() == 0


def test_repeated_hours_raise(spark, trips):
    stats = hour_stats(trips)
    assert score(trips, stats).count() == trips.count()
    with pytest.raises(PySparkException):
        score(trips, stats.unionByName(stats)).collect()
