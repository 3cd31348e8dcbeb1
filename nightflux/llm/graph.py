"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightflux.session import cut


def components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node reaches: columns ``node`` and ``component``.

    ``edges`` has the columns ``a`` and ``b``; direction, loops and repeats do not matter,
    edges with a null end are none, and nodes without an edge have no row.  Each turn points
    every node at its smallest neighbour, takes one pointer jump and contracts the edges, so
    the graph shrinks; no neighbour list is ever gathered.  The mapping of each turn
    is kept as a table in the shared folder and composed once at the end.
    """
    edges = cut(edges.where("a < b or a > b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    label = nodes.withColumn("component", F.col("node"))
    while not edges.isEmpty():
        near = edges.union(edges.select("b", "a")).groupBy("a").agg(F.min("b").alias("near"))
        near = cut(near.select(F.col("a").alias("node"), F.least("a", "near").alias("parent")))
        up = near.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
        step = cut(near.join(up, "parent").select("node", "root"))
        left, right = (step.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
        edges = edges.join(left, "a").join(right, "b").where("ra <> rb")
        edges = cut(edges.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
        label = label.join(step.select(F.col("node").alias("component"), "root"), "component", "left")
        label = label.select("node", F.coalesce("root", "component").alias("component"))
    return label
