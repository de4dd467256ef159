"""Row and event identifiers."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Bits of an id that hold a row's place in its file.
FILE_SHIFT = 40


#: Files whose numbers are broadcast; beyond, Spark chooses how to join them.
BROADCAST_FILES = 100_000
_FILE, _ROW = "_metadata.file_path", "_metadata.row_index"


def source_row_id(path: str = _FILE, place: str = _ROW) -> Column:
    """64-bit id of a row by its Parquet file and its position there.

    The same on every run and attempt, and allowed on streams; by default usable only directly on a
    file scan.
    """
    return F.xxhash64(F.col(path), F.col(place))


def _plain_path(uri: str) -> str:
    """A file as its rows name it; the scan's list has it as a URI."""
    return re.sub("^file:/+", "file:/", unquote(uri))


def with_file_ids(
    rows: DataFrame, name: str, first_file: int = 0, path: str = _FILE, place: str = _ROW
) -> DataFrame:
    """`rows` of a file scan with an exact id: number of the file, and the row's place in it.

    Files are numbered by path from `first_file`; numbers have 23 bits and places 40, so no two
    rows share an id. The numbers come from the scan's list of files, one small row each, and the
    rows stay where they are.
    """
    spark = rows.sparkSession
    listed = sorted(map(_plain_path, rows.inputFiles()))
    numbered = spark.createDataFrame(
        [(p, first_file + i) for i, p in enumerate(listed)], "_path string, _file long"
    )
    if len(listed) <= BROADCAST_FILES:
        numbered = F.broadcast(numbered)
    scanned = rows.withColumns({"_path": F.col(path), "_place": F.col(place)})
    # A file that is not listed would be lost without a word.
    number = F.coalesce("_file", F.raise_error(F.concat(F.lit("unlisted file "), "_path")).cast("long"))
    met = scanned.join(numbered, "_path", "left")
    return met.withColumn(name, number * (1 << FILE_SHIFT) + F.col("_place")).drop("_path", "_place", "_file")


def content_id(*columns: str) -> Column:
    """64-bit id from the values of `columns`; rows with equal values share it."""
    return F.xxhash64(*columns)


def event_id(kind: str) -> Column:
    """`uuid`: random; `hash`: derived from trip_id and anomaly_type, so reruns give the same id."""
    if kind == "uuid":
        return F.expr("uuid()")
    if kind == "hash":
        return F.sha2(F.concat_ws("|", F.col("trip_id"), F.col("anomaly_type")), 256)
    raise ValueError(f"unknown event id kind {kind!r}")
