"""Exact quantiles per group that never gather a group in one task."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripflow.operators.blocks import ordered_blocks


def exact_quantile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    share: str,
    name: str,
    blocks: int | None = None,
) -> DataFrame:
    """The smallest value of each group at or below which `share` of its rows lie.

    Values are counted first, so repeats cost nothing, then ordered in blocks. The block totals
    tell which block holds the wanted rank, and only that block is ranked. NULLs are ignored;
    groups without any value are left out.
    """
    keys = list(keys)
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    ordered = ordered_blocks(counted, [*keys, value], blocks)

    totals = ordered.groupBy(*keys, "block").agg(F.sum("rows").alias("block_rows"))
    group = W.partitionBy(*keys)
    upto = F.sum("block_rows").over(group.orderBy("block"))
    # Decimal arithmetic: the product of a binary fraction may land just above a whole number.
    rank = F.ceil(F.lit(Decimal(share)) * F.sum("block_rows").over(group)).cast("bigint")
    chosen = (
        totals.select(
            *keys,
            "block",
            (upto - F.col("block_rows")).alias("before"),
            upto.alias("upto"),
            F.greatest(rank, F.lit(1)).alias("rank"),
        )
        .filter((F.col("before") < F.col("rank")) & (F.col("rank") <= F.col("upto")))
        .drop("upto")
    )

    renamed = chosen.withColumnsRenamed({c: f"chosen_{c}" for c in [*keys, "block"]})
    same = [F.col(c).eqNullSafe(F.col(f"chosen_{c}")) for c in [*keys, "block"]]
    within = ordered.join(renamed, on=same, how="inner")
    reached = F.col("before") + F.sum("rows").over(
        W.partitionBy(*keys, "block").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    )
    return (
        within.withColumn("reached", reached)
        .filter(
            (F.col("reached") >= F.col("rank")) & (F.col("reached") - F.col("rows") < F.col("rank"))
        )
        .select(*keys, F.col(value).alias(name))
    )
