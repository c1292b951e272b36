"""Connected components of links, in Spark, by hooking and pointer jumping.

Each round every node takes the smallest neighbour below it as its parent, parents are followed to their roots, and
links are redrawn between roots. At least half of the linked nodes vanish in a round, so rounds grow with the logarithm of
the number of nodes. Every table of a round is written to the shared folder; joins on a hub's id are ordinary
equi-joins, which adaptive execution splits, and the minimum is pre-aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidtide.session import written


def _roots(parents: DataFrame) -> DataFrame:
    """node, root from node, parent; a parent without a row is a root."""
    while True:
        up = parents.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = parents.join(up, "parent", "left").select("node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved"))
        jumped = written(jumped, "jumped")
        parents = jumped.select("node", "parent")
        if jumped.where("moved").isEmpty():
            return parents.select("node", F.col("parent").alias("root"))


def components(links: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node of ``links`` (a, b) with a component below itself.

    Nodes that are their component's smallest get no row; neither do self links. No links give an empty table.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    maps: DataFrame | None = None
    while not edges.isEmpty():
        roots = written(_roots(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent"))), "roots")
        if maps is None:
            maps = roots
        else:
            moved = roots.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            maps = maps.join(moved, "root", "left").select("node", F.coalesce("higher", "root").alias("root")).unionByName(roots)
        maps = written(maps, "labels")
        for end in ("a", "b"):
            edges = edges.join(roots.withColumnRenamed("node", end), end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
        edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if maps is None:
        kind = links.schema["a"].dataType.simpleString()
        return links.sparkSession.createDataFrame([], f"node {kind}, component {kind}")
    return maps.withColumnRenamed("root", "component")
