"""A total order over a large table, cut into blocks of similar size.

Windows over one key put the whole key into one task. Cutting the order into range partitions
first lets each block be worked on alone; what crosses a block's edge is one row per block and key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.session import durable


def ordered_blocks(df: DataFrame, order: Sequence[str], blocks: int | None = None) -> DataFrame:
    """`df` with a column `block` that ascends along `order`.

    `order` should tell rows apart, for then a frequent leading value is spread over many blocks.
    The blocks are written out, as a block number must not change between two uses.
    """
    if blocks:
        ranged = df.repartitionByRange(blocks, *order)
    else:
        ranged = df.repartitionByRange(*order)
    return durable(ranged.withColumn("block", F.spark_partition_id()), "blocks")
