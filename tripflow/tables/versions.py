"""Numbered versions of a set of rows, each written once; the last finished one counts.

A version is a folder, and a mark beside it once it is complete. A crash leaves a folder without a
mark, which nobody reads and the next writer of that number removes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tripflow.tables.files import Files

DONE = ".done"


class Versions:
    """The versions below `root`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, root)

    def numbers(self) -> list[int]:
        """Complete versions, ascending."""
        names = self.files.names(self.root)
        return sorted(int(n[1 : -len(DONE)]) for n in names if n.endswith(DONE))

    def path(self, number: int) -> str:
        return f"{self.root}/v{number:012d}"

    def last(self, before: int | None = None) -> int | None:
        """The last complete version, or the last below `before`."""
        return max((n for n in self.numbers() if before is None or n < before), default=None)

    def write(self, rows: DataFrame, number: int, partitions: Sequence[str] = ()) -> str:
        """Write version `number`, in place of what an earlier try may have left; gives its path."""
        path = self.path(number)
        self.files.delete(path + DONE)
        self.files.delete(path)
        rows.write.partitionBy(*partitions).parquet(path)
        self.files.mark(path + DONE)
        return path

    def prune(self, keep: int) -> None:
        """Remove all but the last `keep`; a mark goes before its folder."""
        for number in self.numbers()[:-keep]:
            self.files.delete(self.path(number) + DONE)
            self.files.delete(self.path(number))
