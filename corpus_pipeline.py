"""A corpus for training out of `documents`: five stages, each written and read again.

Rows that fail the quality rules go, one row of each group of near duplicates stays, passages that
an earlier document already has are cut out, documents that leak a benchmark item go, and what is
left is interleaved by source. Each stage sees all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripflow.llm.decontaminate import decontaminate
from tripflow.llm.mixing import mix_sources
from tripflow.llm.near_dup import keep_one
from tripflow.llm.quality import judged
from tripflow.llm.rows import documents, prepare
from tripflow.llm.substring import cut_repeats
from tripflow.session import scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return judged(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return cut_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

#: Similarity over components and edit distances are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of `documents`, with the columns of documents and the place of each row."""
    docs = documents(prepare(spark), sf_dir)
    for name, stage in STAGES:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
