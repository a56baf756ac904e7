"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.durable import durable


def components(links: DataFrame) -> DataFrame:
    """node, label: every node of ``links`` (a, b) with the smallest node that can be reached from it.

    Each round a node takes the smallest label among its own, its neighbours' and its label's; the last at least doubles
    the reach, so rounds grow with the logarithm of the longest path. All joins are between stored tables, so adaptive
    execution can split a node with very many links. Only the number of changes reaches the driver.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = durable(both.filter("a <> b").distinct())
    labels = durable(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    while True:
        of = labels.select(F.col("node").alias("b"), "label")
        seen = both.join(of, "b").select(F.col("a").alias("node"), "label")
        reached = labels.select("node", F.col("label").alias("b")).join(of, "b").select("node", "label")
        offers = labels.select("node", "label", F.col("label").alias("old")).unionByName(
            seen.union(reached).withColumn("old", F.lit(None).cast(labels.schema["label"].dataType))
        )
        merged = durable(offers.groupBy("node").agg(F.min("label").alias("label"), F.max("old").alias("old")))
        labels = merged.select("node", "label")
        if merged.filter("label <> old").isEmpty():
            return labels
