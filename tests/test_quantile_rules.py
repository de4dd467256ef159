"""Ordered blocks: exact quantiles and gaps against brute force, also with hot keys."""

import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tripflow.operators.hourly import hourly
from tripflow.operators.quantile import exact_quantile
from tripflow.operators.rules import detect_rules, idle_gaps


def brute(values, share):
    ordered = sorted(values, key=lambda v: (math.isnan(v), v))
    return ordered[max(math.ceil(Fraction(share) * len(ordered)), 1) - 1]


@pytest.mark.parametrize("share", ["0.95", "0.5", "1", "0", "0.001"])
@pytest.mark.parametrize("blocks", [None, 1, 7])
def test_quantile(spark, share, blocks):
    rows = [("hot", float(i * 7919 % 1013)) for i in range(2000)]
    rows += [("same", 3.0)] * 1500 + [("one", 1.5), ("two", 1.0), ("two", 2.0)]
    rows += [(None, float(i)) for i in range(60)] + [("none", None), ("hot", None)]
    df = spark.createDataFrame(rows, "key string, v double").repartition(9)
    found = {r.key: r.q for r in exact_quantile(df, ["key"], "v", share, "q", blocks).collect()}
    groups = {}
    for key, value in rows:
        if value is not None:
            groups.setdefault(key, []).append(value)
    assert found == {k: brute(v, share) for k, v in groups.items()}


def test_approximate_stays_within_rank_error(spark):
    """The sketch answers within 1/10000 of the rows' ranks, however large the group."""
    lines = spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").select(
        F.col("l_extendedprice").cast("double").alias("v")
    )
    approx = lines.agg(F.percentile_approx("v", 0.95)).first()[0]
    below, upto, total = lines.agg(
        F.count_if(F.col("v") < approx), F.count_if(F.col("v") <= approx), F.count("v")
    ).first()
    assert below / total - 1e-4 <= 0.95 <= upto / total + 1e-4


def test_hourly_modes_agree(trips):
    keys = ["pickup_year", "pickup_month", "pickup_day", "pickup_hour", "p95_fare"]
    exact, approx = hourly(trips, p95="exact"), hourly(trips)
    assert exact.count() == approx.count() == exact.join(approx, keys).count()
    with pytest.raises(ValueError):
        hourly(trips, p95="other")


def trip_rows(spark, rows):
    df = spark.createDataFrame(rows, "trip_id bigint, vendor_id int, start int, minutes int")
    return df.select(
        "trip_id",
        "vendor_id",
        F.timestamp_seconds(F.col("start") * 60).alias("pickup_datetime"),
        F.timestamp_seconds((F.col("start") + F.col("minutes")) * 60).alias("dropoff_datetime"),
        F.lit(1.0).alias("trip_distance"),
        F.lit(1.0).alias("fare_amount"),
        F.lit(1.0).alias("tip_amount"),
        F.lit(1970).alias("pickup_year"),
        F.lit(1).alias("pickup_month"),
        F.lit(0).alias("pickup_hour"),
    )


@pytest.mark.parametrize("blocks", [None, 1, 5, 40])
def test_idle_gaps(spark, blocks):
    """One vendor with most trips, many at the very same minute, some without a drop-off."""
    rows = [(i, 1, 100 if i % 3 else i, 5 + i % 4 if i % 11 else None) for i in range(400)]
    rows += [(1000 + i, None, i * 3, 2) for i in range(40)] + [(2000, 2, 5, 1)]
    found = {r.trip_id: r.idle_seconds for r in idle_gaps(trip_rows(spark, rows), blocks).collect()}
    want = {}
    for vendor in (1, 2, None):
        ended = None
        for trip, _, start, minutes in sorted(
            (r for r in rows if r[1] == vendor), key=lambda r: (r[2], r[0])
        ):
            want[trip] = None if ended is None else (start - ended) * 60.0
            ended = None if minutes is None else start + minutes
    assert found == want


def test_all_rules_in_one_pass(trips):
    far = trips.withColumns(
        {
            "trip_distance": F.pow("trip_distance", F.lit(6)),
            "tip_amount": F.ln("tip_amount"),
        }
    )
    names = ["low_tip", "outlier_distance", "long_idle"]
    together = {
        r.anomaly_type: r["count"] for r in detect_rules(far).groupBy("anomaly_type").count().collect()
    }
    alone = {n: detect_rules(far, [n]).count() for n in names}
    assert together == alone and all(alone.values())
