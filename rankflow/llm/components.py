"""Connected components by alternating large-star and small-star steps.

Every step is one aggregation and one join of the links; the number of steps grows
with the logarithm of the largest component. All links stay in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import store


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on the smallest of them.

    ``edges``: columns a < b. Large star: a node's larger neighbours go to the smallest
    node among it and its neighbours. Small star: its smaller neighbours and itself do.
    """
    if large:
        seen = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        seen = seen.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        seen = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = seen.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    if large:
        moved = seen.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        moved = seen.join(least, "u").where("v != m").select(F.col("m").alias("a"), F.col("v").alias("b"))
        moved = moved.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return moved.where("a != b").distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, component_id: the smallest ``lead`` of each component, for all nodes with a link.

    ``edges``: columns a < b; ``nodes``: node, lead. No links, no rows.
    """
    edges = store(edges)
    before = _state(edges)
    while before[0]:
        edges = store(_star(_star(edges, large=True), large=False))
        after = _state(edges)
        if after == before:
            break
        before = after
    hung = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    member = hung.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
    roots = member.join(nodes, "node").groupBy("root").agg(F.min("lead").alias("component_id"))
    return member.join(roots, "root").select("node", "component_id")
