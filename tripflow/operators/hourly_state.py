"""The hourly table kept up to date: a delivery is added to what earlier ones have left.

Every delivery leaves its own state: one row for each hour it has trips of, with sums, moments and a
mergeable quantile sketch. States of the same hour merge in any order, so a delivery is read once,
and an update reads states of the delivery's months only, never earlier trips. A delivery has a
number; the same number again takes the place of the earlier try.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.functions.moments import merged_moments, moment_names, moments
from tripflow.operators.hourly import HOUR_KEYS, P95
from tripflow.schemas import HOURLY
from tripflow.tables.files import Files

#: Size of the sketch: exact up to about so many fares an hour, with a rank error of about 0.2 %
#: beyond.
SKETCH = 1024
MONTH = ("pickup_year", "pickup_month")
#: States of single deliveries that are kept before they are merged into one.
FOLD_AT = 32

_SUMS = {
    "total_trips": "bigint",
    "total_passengers": "bigint",
    "distance_sum": "double",
    "distance_count": "bigint",
    "tip_sum": "double",
    "tip_count": "bigint",
    "revenue": "double",
    "fare_sum": "double",
    "fare_nans": "bigint",
}
_FARE = moment_names("fare")
_KEY_TYPES = ", ".join(f"{k} int" for k in HOUR_KEYS)
STATE = (
    f"{_KEY_TYPES}, {', '.join(f'{n} {t}' for n, t in _SUMS.items())}, "
    "fare_count bigint, fare_mean double, fare_squares double, fare_low double, fare_high double, "
    "fares binary"
)


def hour_states(trips: DataFrame) -> DataFrame:
    """One row for each hour of `trips`, in the columns of STATE; combined in the scan tasks."""
    fares = F.col("fare_amount")
    return trips.groupBy(*HOUR_KEYS).agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("passenger_count").alias("total_passengers"),
        F.sum("trip_distance").alias("distance_sum"),
        F.count("trip_distance").alias("distance_count"),
        F.sum("tip_amount").alias("tip_sum"),
        F.count("tip_amount").alias("tip_count"),
        F.sum("total_amount").alias("revenue"),
        F.sum("fare_amount").alias("fare_sum"),
        F.count_if(F.isnan(fares)).alias("fare_nans"),
        *moments("fare_amount", "fare"),
        # A sketch leaves out what is not a number, which is to sort above all numbers.
        F.kll_sketch_agg_double(
            F.when(F.isnan(fares), F.lit(float("inf"))).otherwise(fares), F.lit(SKETCH)
        ).alias("fares"),
    )


def merged_states(states: DataFrame) -> DataFrame:
    """One row per hour out of the states of several deliveries."""
    keys = list(HOUR_KEYS)
    sums = states.groupBy(*keys).agg(
        *[F.sum(name).alias(name) for name in _SUMS],
        F.kll_merge_agg_double("fares", F.lit(SKETCH)).alias("fares"),
    )
    merged = sums.join(merged_moments(states, keys, "fare"), keys, "left")
    return merged.withColumn("fare_count", F.coalesce("fare_count", F.lit(0).cast("bigint")))


def _p95() -> Column:
    """The 95th percentile; fares that are not numbers are the largest, infinite ones included."""
    found = F.kll_sketch_get_quantile_double("fares", F.lit(float(P95)))
    beyond = (found == float("inf")) & (F.col("fare_nans") > 0)
    nan = F.when(beyond, F.lit(float("nan"))).otherwise(F.round(found, 2))
    return F.when(F.col("fare_count") > 0, nan)


def hourly_from(states: DataFrame) -> DataFrame:
    """Rows of the hourly table out of merged states (one row per hour)."""
    return HOURLY.project(
        states.withColumns(
            {
                "avg_trip_distance": F.round(F.try_divide("distance_sum", "distance_count"), 3),
                "avg_fare_amount": F.round(F.try_divide("fare_sum", "fare_count"), 2),
                "avg_tip_amount": F.round(F.try_divide("tip_sum", "tip_count"), 2),
                "total_revenue": F.round("revenue", 2),
                "p95_fare": _p95(),
                "computed_at": F.current_timestamp(),
            }
        )
    )


class HourStates:
    """The states of all deliveries so far, below `root`.

    A folder `span=<first>-<last>` holds the state of these deliveries together and counts once its
    mark is there. Folding writes one folder for all deliveries up to the last; a reader takes the
    longest span from the start and the single deliveries after it, so that a crash between writing
    and removing changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, root)

    def _spans(self) -> list[tuple[int, int]]:
        names = [n.removesuffix(".done") for n in self.files.names(self.root) if n.endswith(".done")]
        return sorted(tuple(map(int, n.removeprefix("span=").split("-"))) for n in names)

    def _current(self) -> list[tuple[int, int]]:
        """The spans that together hold each delivery once."""
        spans = self._spans()
        folded = max((s for s in spans if s[0] == 0), key=lambda s: s[1], default=(0, 0))
        return [s for s in spans if s == folded or s[0] > folded[1]]

    def _path(self, span: tuple[int, int]) -> str:
        return f"{self.root}/span={span[0]}-{span[1]}"

    def deliveries(self) -> int:
        """The last delivery that was added; 0 if there was none."""
        return max((last for _, last in self._spans()), default=0)

    def _write(self, states: DataFrame, span: tuple[int, int]) -> None:
        path = self._path(span)
        self.files.delete(path + ".done")
        self.files.delete(path)
        states.repartition(*MONTH).write.partitionBy(*MONTH).parquet(path)
        self.files.mark(path + ".done")

    def add(self, trips: DataFrame, number: int) -> DataFrame:
        """Add delivery `number` (from 1); gives the states of its hours, all deliveries together."""
        folded = max((last for first, last in self._spans() if first == 0), default=0)
        if number < 1 or number <= folded:
            raise ValueError(f"delivery {number} is part of a merged state already")
        self._write(hour_states(trips), (number, number))
        new = self.spark.read.schema(STATE).parquet(self._path((number, number)))
        hours = new.select(*HOUR_KEYS).distinct()
        # Months first: they prune the folders that are read.
        months = hours.select(*MONTH).distinct()
        held = self.read().join(months, list(MONTH), "left_semi")
        return merged_states(held.join(hours, list(HOUR_KEYS), "left_semi"))

    def read(self) -> DataFrame:
        """States of all deliveries: an hour has a row for each span that has trips of it."""
        spans = self._current()
        if not spans:
            return self.spark.createDataFrame([], STATE)
        paths = [self._path(s) for s in spans]
        reader = self.spark.read.schema(STATE).option("basePath", self.root)
        return reader.parquet(*paths).select(*HOUR_KEYS, *_SUMS, *_FARE, "fares")

    def fold(self, at_least: int = FOLD_AT) -> bool:
        """Merge the single deliveries into one state, if there are so many; says whether it did."""
        spans = self._current()
        if len(spans) < max(at_least, 2):
            return False
        whole = (0, max(last for _, last in spans))
        self._write(merged_states(self.read()), whole)
        for span in spans:
            self.files.delete(self._path(span) + ".done")
            self.files.delete(self._path(span))
        return True
