"""Footers of Parquet files as a table, read on the executors; no column of the files is read."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = (
    "path string, bytes long, rows long, row_groups long, codecs array<string>, "
    "columns array<struct<name: string, type: string>>"
)
#: Files whose footers one task reads.
FILES_PER_TASK = 64
# Hadoop's names of file systems that Arrow knows under another.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _opened(path: str):
    from pyarrow import fs

    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    system, place = fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")
    return system.open_input_file(place)


def _columns(metadata) -> list[dict]:
    """Names and Spark types of a file's columns, in lower case where Spark has none of its own."""
    from pyspark.sql.pandas.types import from_arrow_type

    old = {c.path: c.physical_type == "INT96" for c in map(metadata.schema.column, range(metadata.num_columns))}
    found = []
    for field in metadata.schema.to_arrow_schema():
        try:
            kind = from_arrow_type(field.type).simpleString()
        except Exception:  # a type that Spark has not
            kind = str(field.type)
        # Timestamps of this old form have no zone in the file, but are moments to Spark.
        found.append({"name": field.name, "type": "timestamp" if old.get(field.name) else kind})
    return found


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq

    for batch in batches:
        found = []
        for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
            with _opened(path) as source:
                about = pq.ParquetFile(source).metadata
            groups = [about.row_group(i) for i in range(about.num_row_groups)]
            codecs = {g.column(i).compression for g in groups for i in range(g.num_columns)}
            found.append(
                {
                    "path": path, "bytes": length, "rows": about.num_rows,
                    "row_groups": len(groups), "codecs": sorted(codecs), "columns": _columns(about),
                }
            )
        names = ["path", "bytes", "rows", "row_groups", "codecs", "columns"]
        kinds = [
            pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()),
            pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())])),
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[n] for f in found], k) for n, k in zip(names, kinds)], names=names
        )


def list_parquet(spark: SparkSession, folder: str) -> DataFrame:
    """path, length of the Parquet files below `folder`; lists, but opens none of them."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    return reader.option("recursiveFileLookup", "true").load(folder).select("path", "length")


def footers(files: DataFrame) -> DataFrame:
    """path, bytes, rows, row_groups, codecs, columns of each file of `files` (path, length).

    Executors open the paths through Arrow, which needs access to the store as Spark has.
    """
    tasks = max(1, -(-files.count() // FILES_PER_TASK))
    return files.select("path", "length").repartition(tasks, F.xxhash64("path")).mapInArrow(_read, SCHEMA)
