"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.llm.common import written


def connected(edges: DataFrame) -> DataFrame:
    """`node`, `label` of every node of the edges `a`, `b`: the smallest node of its component.

    Each round gives a node the smallest label among its neighbours' and its own, and then the label of that label,
    so that labels travel ever longer ways. Rounds are tables in the shared folder, so that a join can split a label
    that many nodes have; the driver sees how many labels changed.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.where("a != b").distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("next"))
        nearer = written(nearer, "labels")
        ends = nearer.select(F.col("node").alias("next"), F.col("next").alias("end"))
        labels = written(nearer.join(ends, "next", "left").select("node", F.least("next", "end").alias("label"), "label").toDF("node", "label", "old"), "labels")
        if labels.where("label != old").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
