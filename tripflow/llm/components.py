"""Connected components of a graph given as links, without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.session import durable


def components(links: DataFrame) -> DataFrame:
    """v, label: each linked vertex and the smallest vertex it can reach.

    `links` has columns a and b of one orderable type, each link in one direction or both. Each
    round gives a vertex the smallest label around it and then that label's own label, so that
    the distance covered doubles; rounds end when no label changes. Rounds are written to the
    shared folder: a lost executor costs a re-read.
    """
    edges = durable(
        links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links"
    )
    labels = durable(
        edges.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("label")),
        "labels",
    )
    while True:
        around = (
            edges.join(labels.withColumnRenamed("v", "b"), "b")
            .groupBy(F.col("a").alias("v"))
            .agg(F.min("label").alias("near"))
        )
        near = labels.join(around, "v").select(
            "v", "label", F.least("label", "near").alias("next")
        )
        onward = labels.select(F.col("v").alias("next"), F.col("label").alias("jump"))
        after = durable(
            near.join(onward, "next").select(
                "v", F.least("next", "jump").alias("label"), F.col("label").alias("old")
            ),
            "labels",
        )
        changed = not after.where("label != old").isEmpty()
        labels = after.select("v", "label")
        if not changed:
            return labels
