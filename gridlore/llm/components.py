"""Connected components of a graph of links, by contraction."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlore.sources.shared import materialize


def _roots(parents: DataFrame) -> DataFrame:
    """``(node, root)`` from ``(node, parent)``, a parent being less than its node; by doubling."""
    while True:
        up = parents.select(F.col("node").alias("_parent"), F.col("parent").alias("_grand"))
        jumped = parents.join(up, F.col("parent") == F.col("_parent"), "left")
        jumped = materialize(
            jumped.select(
                "node", F.coalesce("_grand", "parent").alias("parent"),
                F.col("_grand").isNotNull().alias("_moved"),
            ),
            "parents",
        )
        parents = jumped.select("node", "parent")
        if jumped.where("_moved").isEmpty():
            return parents.withColumnRenamed("parent", "root")


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for each end of a link ``(a, b)``; a root is the least node of its component.

    Each round joins every node to its least neighbour and goes on with the
    links between the groups, of which there are at most half as many as nodes.
    """
    spark = links.sparkSession
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = materialize(edges.where("a < b").distinct(), "links")
    found = None
    while not edges.isEmpty():
        parents = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent"))
        roots = _roots(materialize(parents, "parents"))
        if found is None:
            found = roots
        else:
            up = roots.select(F.col("node").alias("_node"), F.col("root").alias("_root"))
            moved = found.join(up, F.col("root") == F.col("_node"), "left")
            moved = moved.select("node", F.coalesce("_root", "root").alias("root"))
            found = materialize(moved.unionByName(roots), "components")
        for end in ("a", "b"):
            up = roots.select(F.col("node").alias(end), F.col("root").alias("_root"))
            edges = edges.join(up, end, "left")
            edges = edges.withColumn(end, F.coalesce("_root", end)).drop("_root")
        edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges = materialize(edges.where("a < b").distinct(), "links")
    if found is None:
        return spark.createDataFrame([], "node bigint, root bigint")
    own = found.select(F.col("root").alias("node")).distinct().withColumn("root", F.col("node"))
    return found.unionByName(own).distinct()
