"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from classweave.llm.frames import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that is reachable over the links, for every node that has one.

    Each round every node takes the smallest label among its own and its neighbours', and then that label's own label, so
    the rounds grow with the logarithm of a chain. A node with very many links is one row per link in a join that
    adaptive execution splits, and one row per task in the minimum. Each round is written to the shared folder.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    both = written(both.union(both.select("v", "u")).where("u != v").distinct(), "edges")
    labels = written(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("label")).select(F.col("u").alias("node"), "label"), "labels")
    while True:
        reached = both.join(labels, F.col("u") == F.col("node")).groupBy("v").agg(F.min("label").alias("near"))
        moved = labels.join(reached, F.col("node") == F.col("v")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        upper = labels.select(F.col("node").alias("up"), F.col("label").alias("top"))
        shorter = written(moved.join(upper, F.col("label") == F.col("up")).select("node", "old", F.least("label", "top").alias("label")), "labels")
        labels = shorter.select("node", "label")
        if shorter.where("old != label").isEmpty():
            return labels.withColumnRenamed("label", "component")
