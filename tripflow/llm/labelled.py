"""Labelled rows for classifiers: which may be learnt from, and a bounded sample of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.rows import text_of

#: Most labelled rows that a classifier is fitted on.
SAMPLE = 12_000
#: Rows whose checksum of doc_id has this remainder modulo FOLDS are held out from learning.
FOLDS = 4
HELD_OUT = 2


def held_out(doc_id: str = "doc_id") -> Column:
    """A missing doc_id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def training_rows(docs: DataFrame, labels: DataFrame, name: str, sample: int = SAMPLE) -> DataFrame:
    """doc_id, text, label of at most `sample` rows that may be learnt from.

    Chosen by the hash of doc_id among all labelled ones, so the choice does not depend on the
    order or split of the input. Missing labels and ids are left out; of several labels of one
    document the highest counts, and of several texts of one id the one of the lowest hash.
    """
    known = (
        labels.where(F.col(name).isNotNull() & F.col("doc_id").isNotNull())
        .where(~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.max(F.col(name).cast("int")).alias("label"))
    )
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    # At most `sample` rows of two numbers.
    met = texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["_id"])
    # Tasks keep one text of an id each, so an id on very many rows sends few of them.
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")
    return met.groupBy("doc_id", "label").agg(first).select("doc_id", "first.text", "label")
