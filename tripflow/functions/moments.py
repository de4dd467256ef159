"""Number, mean, spread and range of a measure, as columns that can be merged.

Merging takes each part's mean against the common one, so that no digits cancel out as in a sum of
squares. A measure may hold NaN, which then is its mean and spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripflow.functions.scores import flat

PARTS = ("count", "mean", "squares", "low", "high")


def moment_names(prefix: str) -> list[str]:
    return [f"{prefix}_{part}" for part in PARTS]


def moments(value: str, prefix: str) -> list[Column]:
    """`<prefix>_count`, `_mean`, `_squares` (summed squared deviations), `_low`, `_high`."""
    count = F.count(value)
    columns = (count, F.avg(value), F.var_pop(value) * count, F.min(value), F.max(value))
    return [c.alias(name) for c, name in zip(columns, moment_names(prefix))]


def merged_moments(rows: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """The moments of all of a key's parts together, one row per key.

    The window holds a key's parts, not its measurements; a key without any measurement is left out.
    """
    count, mean, squares, low, high = moment_names(prefix)
    parts = rows.where(F.col(count) > 0)
    over = Window.partitionBy(*keys)
    common = F.sum(F.col(count) * F.col(mean)).over(over) / F.sum(count).over(over)
    shifted = parts.withColumns({"_mean": common, "_shift": F.col(mean) - common})
    return shifted.groupBy(*keys).agg(
        F.sum(count).alias(count),
        F.first("_mean").alias(mean),
        F.sum(F.col(squares) + F.col(count) * F.pow("_shift", F.lit(2))).alias(squares),
        F.min(low).alias(low),
        F.max(high).alias(high),
    )


def deviation_of(prefix: str) -> Column:
    """Sample deviation out of moments: NULL for one value, exactly 0 for equal ones."""
    count, _, squares, low, high = moment_names(prefix)
    same = flat(F.col(low), F.col(high), F.col(count))
    spread = F.sqrt(F.try_divide(F.col(squares), F.col(count) - 1))
    return F.when(same, F.lit(0.0)).otherwise(spread)
