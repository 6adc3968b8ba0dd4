"""Connected components of a graph given by its edges, in alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import written


def _with_least(edges: DataFrame) -> DataFrame:
    """u, v, least: each edge with the least of u and its neighbours. Hot nodes are pre-aggregated."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return edges.join(least, "u").withColumn("least", F.least("u", "least"))


def components(edges: DataFrame) -> DataFrame:
    """node, component: the least node reachable, for every node of the edges (a, b).

    Large-star steps hang each node's larger neighbours on the least one, small-star steps the
    smaller ones, until nothing changes; every edge is then a node and its component. The number
    of edges never grows, and each step is written to the shared folder.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = written(edges, "edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        small = _with_least(large)
        small = small.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(
            small.select("u", F.col("least").alias("v"))).where("u <> v").distinct()
        edges = written(small, "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        before = state
