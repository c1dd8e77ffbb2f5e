"""Joining per-source facts to edges when a few sources own most of the edges.

A plain join would send all edges of a source to one task. Sources with more
than ``edges / MAX_HOT`` edges are therefore joined by broadcast: there can be
at most ``MAX_HOT`` of them, whatever the graph looks like. All other sources
are small enough for a shuffled join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bound on broadcast sources, and the degree below which none is hot.
MAX_HOT = 10_000
MIN_HOT_DEGREE = 200_000


@dataclass
class Split:
    """Edges joined to the facts of their source, in two disjoint parts."""

    ordinary: DataFrame  # hash-partitioned by source
    hot: DataFrame | None  # spread like the input

    def all(self) -> DataFrame:
        return self.ordinary if self.hot is None else self.ordinary.unionByName(self.hot)


def join_sources(
    edges: DataFrame,
    facts: DataFrame,
    max_hot: int = MAX_HOT,
    min_hot_degree: int = MIN_HOT_DEGREE,
) -> Split:
    """Inner join of edges and ``facts`` (``src, out_degree, …``, one per source).

    ``out_degree`` must be at least the number of rows of the source in
    ``edges``. The facts are read several times, so they should be stored.
    """
    sizes = facts.agg(F.sum("out_degree").alias("total"), F.max("out_degree").alias("most")).first()
    threshold = max(min_hot_degree, (sizes["total"] or 0) // max_hot)
    if (sizes["most"] or 0) <= threshold:
        return Split(edges.join(facts, "src"), None)
    is_hot: Column = F.col("out_degree") > threshold
    hot = F.broadcast(facts.where(is_hot))
    ordinary = edges.join(hot.select("src"), "src", "left_anti").join(facts.where(~is_hot), "src")
    return Split(ordinary, edges.join(hot, "src"))
