"""Rows of a table of documents as the operators of this subpackage use them.

Every operator keeps to these rules unless its docstring says otherwise:

* A missing text counts as an empty one; a missing `doc_id` counts as larger than any other.
* Rows that repeat, also with one `doc_id` and different texts, are rows of their own: they are
  told apart by `doc_id` and the text, and equal rows get equal results. Joins tell texts apart by
  96 bits, of two unrelated functions: `tkey`, the checksum, which also orders them, and `tsum`.
* Columns that the operator does not ask for are ignored, whatever their names; results have only
  the columns that the docstring lists.
* An empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.session import configure

#: Place of a missing doc_id in the order of documents.
LAST = (1 << 63) - 1
KEY = ["ord", "tkey", "tsum"]
KEY_TYPES = "ord long, tkey int, tsum long"
#: Rows of one Arrow batch: with texts of a few MB it still fits a Python worker.
BATCH_ROWS = 256


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of this subpackage's Python steps."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def checksum(name: str = "text") -> Column:
    return (F.crc32(text_of(name)) - (1 << 31)).cast("int")


def text_sum(name: str = "text") -> Column:
    """Tells apart texts whose checksums are equal: many rows may share a doc_id or have none."""
    return F.xxhash64(text_of(name))


def keyed(docs: DataFrame) -> DataFrame:
    """ord, tkey, tsum, text: what tells rows apart, and the text."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("ord"),
        checksum().alias("tkey"),
        text_sum().alias("tsum"),
        text_of().alias("text"),
    )


def with_key(docs: DataFrame) -> DataFrame:
    """`docs` with _ord, _tkey, _tsum: what tells rows apart, beside columns of any name."""
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    return docs.withColumns({"_ord": ids, "_tkey": checksum(), "_tsum": text_sum()})


def doc_id() -> Column:
    """`ord` as an id again."""
    return F.when(F.col("ord") != LAST, F.col("ord")).alias("doc_id")


def packed(rows: DataFrame) -> DataFrame:
    """ord, tkey, tsum, packed: texts compressed, for a shuffle that has to carry them."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [squeeze.compress(x.encode()) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in KEY), pa.array(texts, pa.binary())],
                names=[*KEY, "packed"],
            )

    return rows.select(*KEY, "text").mapInArrow(pack, f"{KEY_TYPES}, packed binary")


#: Bits of a sieve, a power of two: 2 MB, whatever the input.
SIEVE_BITS = 1 << 24


def sieved(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """`rows` (of `keyed`) without most of those whose key is not in `wanted`; loses none that is.

    A bit for each hash of a wanted key, in a set of fixed size that every task gets: the more keys
    are wanted the more others pass, up to all. It spares the shuffle of a join on the key the texts
    that the join would drop.
    """
    bit = F.pmod(F.xxhash64(*KEY), F.lit(SIEVE_BITS))
    octets = (
        wanted.select(bit.alias("b"))
        .groupBy(F.expr("b div 8").alias("octet"))
        .agg(F.bit_or(F.expr("shiftleft(1, CAST(b % 8 AS INT))")).alias("bits"))
        .toArrow()
    )
    sieve = np.zeros(SIEVE_BITS // 8, dtype=np.uint8)
    sieve[octets.column("octet").to_numpy()] = octets.column("bits").to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(sieve)

    def pick(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            places = batch.column("_bit").to_numpy()
            passed = (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1
            yield batch.drop_columns(["_bit"]).filter(pa.array(passed.astype(bool)))

    return rows.select(*KEY, "text", bit.alias("_bit")).mapInArrow(pick, f"{KEY_TYPES}, text string")


def unpacked(column: pa.Array) -> pa.Array:
    open_up = zstandard.ZstdDecompressor()
    texts = [open_up.decompress(x.as_py()) for x in column]
    return pa.array(texts, pa.large_binary())


def lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    """One list per row out of flat values and the number of values of each row."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
