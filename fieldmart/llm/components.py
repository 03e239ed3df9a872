"""Connected components of a graph given by its edges, with joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def roots(edges: DataFrame) -> DataFrame:
    """(vertex, root) for edges (a, b): the smallest vertex of each vertex' component.

    In each round a vertex takes the smallest label around it and then the label of its label, so the
    way to go is about halved. Each round is cut from the one before.
    """
    both = cut(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = cut(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("vertex"), F.least("a", "b").alias("root")))
    while True:
        around = both.join(labels, both.b == labels.vertex).groupBy("a").agg(F.min("root").alias("near"))
        lower = labels.join(around, labels.vertex == around.a).select("vertex", F.least("root", "near").alias("root"), F.col("root").alias("before"))
        lower = cut(lower)
        jump = lower.select(F.col("vertex").alias("at"), F.col("root").alias("further"))
        moved = cut(lower.join(jump, lower.root == jump.at).select("vertex", F.least("root", "further").alias("root"), "before"))
        labels = moved.select("vertex", "root")
        if moved.filter("root <> before").isEmpty():
            return labels
