"""Which files to rewrite together: first fit, by decreasing size, within each partition.

Only lists of files pass through here. A partition's list is sorted in Spark and cut into runs of
CHUNK files, each packed by itself, so that no task holds more than a run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The accepted range of file sizes, as shares of the target.
SIZE_RANGE = (0.75, 1.8)
#: What a group may hold, as a share of the target: merged files come out smaller than their parts.
FILL = 1.25
CHUNK = 10_000


def badly_sized(size: Column, target: int) -> Column:
    return ~size.between(SIZE_RANGE[0] * target, SIZE_RANGE[1] * target)


def first_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The group of each file, numbered from 0 as groups are opened; files come largest first."""
    room = np.zeros(len(lengths), dtype=np.int64)
    groups, opened = np.zeros(len(lengths), dtype=np.int64), 0
    for i, length in enumerate(lengths.tolist()):
        fits = room[:opened] >= length
        group = int(fits.argmax()) if fits.any() else opened
        if group == opened:
            room[group] = capacity
            opened += 1
        room[group] -= length
        groups[i] = group
    return groups


def _packed(capacity: int):
    def pack(files: pa.Table) -> pa.Table:
        files = files.sort_by([("length", "descending"), ("file", "ascending")])
        lengths = files.column("length").to_numpy()
        groups = np.zeros(len(lengths), dtype=np.int64)
        whole = files.column("pieces").to_numpy() == 1
        groups[whole] = first_fit(lengths[whole], capacity)
        # Files to be split are groups of their own, after the others.
        groups[~whole] = groups[whole].max(initial=-1) + 1 + np.arange((~whole).sum())
        return files.append_column("bin", pa.array(groups)).select(
            ["partition", "file", "length", "chunk", "bin", "pieces"]
        )

    return pack


def file_groups(files: DataFrame, target: int, min_files: int) -> DataFrame:
    """partition, file, length, chunk, bin, pieces: the files worth rewriting, and with which others.

    `files`: partition, file, length. Files below the accepted range are packed into bins of FILL *
    `target` bytes, largest first, each into the first bin with room. A bin counts if it has two
    files or more, and its partition `min_files` badly sized ones. A file above the range is alone
    in its bin and split into `pieces`, whatever the partition holds.
    """
    bad = files.select("partition", "file", "length").where(badly_sized(F.col("length"), target))
    over = Window.partitionBy("partition")
    place = F.row_number().over(over.orderBy(F.desc("length"), "file"))
    large = F.col("length") > SIZE_RANGE[1] * target
    pieces = F.when(large, F.round(F.col("length") / target)).otherwise(1).cast("long")
    listed = bad.withColumns(
        {
            "chunk": F.floor((place - 1) / CHUNK),
            "among": F.count(F.lit(1)).over(over),
            "pieces": pieces,
        }
    )
    worth = listed.where((F.col("among") >= min_files) | (F.col("pieces") > 1)).drop("among")
    packed = worth.groupBy("partition", "chunk").applyInArrow(
        _packed(int(FILL * target)),
        "partition string, file string, length long, chunk long, bin long, pieces long",
    )
    mates = F.count(F.lit(1)).over(Window.partitionBy("partition", "chunk", "bin"))
    return packed.withColumn("mates", mates).where("mates > 1 OR pieces > 1").drop("mates")
