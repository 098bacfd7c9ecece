"""Connected components of a distributed graph by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_marts.llm.shared import drop_saved, saved


def components(edges: DataFrame) -> DataFrame:
    """`(id, component)` of every node that has an edge; smallest id of its component.

    `edges` has `u` and `v`. Each round every node points to the smallest node
    next to it and edges move to those. A round leaves at most half of the nodes
    of a component, so rounds grow with the logarithm of the largest one. A node
    with very many edges is reduced before the shuffle. Only counts reach the driver.
    """
    left = saved(_proper(edges), "edges")
    label: DataFrame | None = None
    while left.take(1):
        both = left.unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parents = both.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("least"))
        parents = saved(parents.select("id", F.least("id", "least").alias("parent")), "parents")
        up, vp = (parents.select(F.col("id").alias(c), F.col("parent").alias(f"{c}p")) for c in "uv")
        moved = left.join(up, "u").join(vp, "v").select(F.col("up").alias("u"), F.col("vp").alias("v"))
        following = saved(_proper(moved), "edges")
        if label is None:
            new = parents.select("id", F.col("parent").alias("component"))
        else:
            step = parents.select(F.col("id").alias("component"), "parent")
            new = label.join(step, "component", "left")
            new = new.select("id", F.coalesce("parent", "component").alias("component"))
        new = saved(new, "labels")
        for old in (left, parents, label):
            if old is not None:
                drop_saved(old)
        left, label = following, new
    if label is None:
        return left.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return label


def _proper(edges: DataFrame) -> DataFrame:
    """Edges between two nodes, each once, smaller node first."""
    ends = edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    return ends.where("u < v").distinct()
