"""Physical layout of a graph for repeated rank steps.

Nodes get dense numbers once, through a dictionary that stays in Spark. The numbers tell
what a step must know of a node, so the state holds nothing but number and rank: sources
with very many edges come first, then other sources in falling order of degree, then nodes whose
edges weigh nothing, then nodes without out-edges. A node with a number from ``givers`` on is
dangling; one below ``hot_ids`` is a hot source.

Edges are translated to numbers, merged per pair, hash-partitioned and sorted by source, next
to a state hash-partitioned and sorted by number; sorted numbers are stored as small
differences by the column cache. Every step then merges the two without moving the edges: the
only data shuffled per step are the partial inflow sums.

Hot sources, more than ``hot_degree`` out-edges each, are at most ``edges / hot_degree``, so
their ranks may be broadcast, and their edges stay spread over all tasks however uneven the
graph is.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.operators import graph
from rankflow.operators.sizing import choose_partitions
from rankflow.operators.skew import MIN_HOT_DEGREE, join_sources
from rankflow.session import passing_shuffles

# Upper bounds on broadcast hot sources: per partition of the layout, and at all.
_HOT_SOURCES_PER_PARTITION = 4
_MAX_HOT_SOURCES = 100_000
# The dictionary is broadcast for the translation of edges if it has so many bytes at most.
_BROADCAST_BYTES = 16 << 20
_BYTES_PER_NODE = 64
# Kinds of nodes, in the order of their numbers: a source by the bits of its degree, most first.
_WEIGHTLESS, _SINK = 100, 101


@dataclass(frozen=True)
class Facts:
    """Counts of a graph."""

    nodes: int
    edges: int
    max_degree: int
    max_weight: float
    name_bytes: int
    max_touch: int


@dataclass
class Layout:
    """A graph ready for rank steps."""

    names: DataFrame  # id, node: the dictionary, by id, sorted
    spread: DataFrame  # src, dst and shares: edges of ordinary sources, by src, sorted
    hot: DataFrame | None  # the same of hot sources, by pair
    partitions: int
    facts: Facts
    hot_ids: int  # sources with a smaller id are hot
    givers: dict[bool, int]  # first id without out-weight; True: weights count, False: edges do
    split: frozenset[bool]  # kinds of weight for which edges hold weight and total, not their quotient
    translate: Callable[[int, int], DataFrame]  # src, dst, w, total, degree: the edges as numbers, one of so many slices by target
    facts_of_nodes: DataFrame  # id, out_degree, out_weight
    source: DataFrame | None = None  # held edges from which the layout is built

    def release_source(self) -> None:
        """Free the edges as they came, once the layout itself is stored."""
        if self.source is not None:
            self.source.unpersist()
            self.source = None

    def release(self) -> None:
        """Free the stored edges."""
        self.release_source()
        self.spread.unpersist()
        if self.hot is not None:
            self.hot.unpersist()


def choose_hot_degree(edge_count: int, partitions: int, requested: int | None = None) -> int:
    """Smallest degree that counts as hot; bounds the number of hot sources."""
    floor = edge_count // _MAX_HOT_SOURCES
    if requested is not None:
        return max(requested, floor)
    even = edge_count // (_HOT_SOURCES_PER_PARTITION * partitions)
    return max(MIN_HOT_DEGREE, even, floor)


def _numbered(edges: DataFrame, universe: DataFrame | None) -> DataFrame:
    """Stored rows node, out_weight, out_degree, touches, kind, _id in order of kind within a partition."""
    rows = graph.endpoints(edges)
    if universe is not None:
        isolated = universe.select(
            F.col("node").cast(edges.schema["src"].dataType),
            F.lit(0.0).alias("out_weight"),
            F.lit(0).cast("long").alias("out_degree"),
        )
        rows = rows.unionByName(isolated.where(F.col("node").isNotNull()))
    table = rows.groupBy("node").agg(
        F.sum("out_weight").alias("out_weight"),
        F.sum("out_degree").alias("out_degree"),
        F.count(F.lit(1)).alias("touches"),
    )
    by_degree = 64 - F.length(F.bin("out_degree"))
    kind = F.when(F.col("out_degree") == 0, _SINK).when(F.col("out_weight") == 0, _WEIGHTLESS).otherwise(by_degree)
    ordered = table.withColumn("kind", kind.cast("int")).sortWithinPartitions("kind", "node")
    return ordered.withColumn("_id", F.monotonically_increasing_id()).checkpoint()


def _dense(numbered: DataFrame) -> DataFrame:
    """Replace ``_id`` by ``id``: 0, 1, 2, … in order of kind.

    Rows of a kind are neighbours in their partition; what lies before them there and
    elsewhere is one number per partition and kind.
    """
    part = F.shiftright("_id", 33).alias("_part")
    sizes = numbered.groupBy(part, "kind").agg(F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first"))
    before = Window.orderBy("kind", "_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0).cast("long")))
    placed = numbered.withColumn("_part", part).join(starts.drop("_rows"), ["_part", "kind"])
    return placed.withColumn("id", F.col("_start") + F.col("_id") - F.col("_first")).drop("_part", "_start", "_first", "_id")


def _translate(edges: DataFrame, names: DataFrame, facts: Facts) -> DataFrame:
    """Edges src, dst as numbers, with w and the totals of the source."""
    if facts.nodes * _BYTES_PER_NODE + facts.name_bytes <= _BROADCAST_BYTES:
        names = F.broadcast(names)
    targets = names.select(F.col("node").alias("dst"), F.col("id").alias("_dst"), F.col("touches"))
    sources = names.select(
        F.col("node").alias("src"), F.col("id").alias("_src"), "out_degree", F.col("out_weight").alias("total")
    )
    if facts.max_touch <= MIN_HOT_DEGREE:
        met = edges.join(targets.drop("touches"), "dst").join(sources, "src")
    else:  # hubs meet their numbers by broadcast, on either side
        swapped = edges.select(F.col("dst").alias("src"), F.col("src").alias("_other"), "w")
        by_target = targets.select(F.col("dst").alias("src"), "_dst", F.col("touches").alias("out_degree"))
        met = join_sources(swapped, by_target).all().select(F.col("_other").alias("src"), "_dst", "w")
        met = join_sources(met, sources).all()
    return met.select(F.col("_src").alias("src"), F.col("_dst").alias("dst"), "w", "total", F.col("out_degree").alias("degree"))


def share_columns(weighted: bool, split: bool) -> tuple[str, ...]:
    """Names of the edge columns that hold the shares of one kind of weight."""
    kind = "w" if weighted else "u"
    return (f"{kind}_part", f"{kind}_total") if split else (f"{kind}_share",)


def _shares(kinds: set[bool], split: frozenset[bool]) -> list[Column]:
    columns = []
    for weighted in sorted(kinds):
        part, total = (F.col("w"), F.col("total")) if weighted else (F.col("copies").cast("double"), F.col("degree").cast("double"))
        names = share_columns(weighted, weighted in split)
        values = (part, total) if weighted in split else (F.when(total > 0, part / total).otherwise(F.lit(0.0)),)
        columns += [value.alias(name) for name, value in zip(names, values, strict=True)]
    return columns


def _merged(edges: DataFrame, shares: list[Column]) -> DataFrame:
    """One row per pair of numbers with its shares; repeated pairs add up."""
    sums = edges.groupBy("src", "dst").agg(
        F.sum("w").alias("w"), F.count(F.lit(1)).alias("copies"), F.max("total").alias("total"), F.max("degree").alias("degree")
    )
    return sums.select("src", "dst", *shares)


def build_layout(
    edges: DataFrame,
    kinds: set[bool],
    split: frozenset[bool] = frozenset(),
    universe: DataFrame | None = None,
    partitions: int | None = None,
    hot_degree: int | None = None,
) -> Layout:
    """Number the nodes of ``src, dst, w`` edges and lay out both.

    ``kinds``: whether weights (True), plain edges (False) or both will be followed; ``split``: those
    of which steps need weight and total apart. Edges are read three times, so they should be held.
    """
    spark = edges.sparkSession
    with passing_shuffles(spark):
        numbered = _numbered(edges, universe)
    degree, weight, size = F.col("out_degree"), F.col("out_weight"), F.octet_length(F.col("node").cast("string"))
    by_kind = numbered.groupBy("kind").agg(
        F.count(F.lit(1)).alias("nodes"),
        F.sum(degree).alias("edges"),
        F.max(degree).alias("most"),
        F.max(weight).alias("heaviest"),
        F.sum(size).alias("bytes"),
        F.max("touches").alias("touch"),
    )
    rows = {r["kind"]: r for r in by_kind.collect()}  # 66 kinds at most
    values = rows.values()
    facts = Facts(
        sum(r["nodes"] for r in values),
        sum(r["edges"] for r in values),
        max((r["most"] for r in values), default=0),
        max((math.nan if math.isnan(r["heaviest"]) else r["heaviest"] for r in values), key=_nan_last, default=0.0),
        sum(r["bytes"] for r in values),
        max((r["touch"] for r in values), default=0),
    )
    if partitions is None:
        partitions = choose_partitions(facts.edges, int(spark.conf.get("spark.sql.shuffle.partitions")))
    hot_degree = choose_hot_degree(facts.edges, partitions, hot_degree)
    # degrees of a kind differ by a factor under 2; a kind is hot if all its degrees are above the limit
    hot_ids = sum(r["nodes"] for kind, r in rows.items() if kind < _WEIGHTLESS and 1 << (63 - kind) > hot_degree)
    sources = sum(r["nodes"] for kind, r in rows.items() if kind < _WEIGHTLESS)
    givers = {True: sources, False: sources + (rows[_WEIGHTLESS]["nodes"] if _WEIGHTLESS in rows else 0)}

    with passing_shuffles(spark):
        table = _dense(numbered).repartition(partitions, "id").sortWithinPartitions("id").checkpoint()
    shares = _shares(kinds, split)

    def translate(index: int = 0, slices: int = 1) -> DataFrame:
        own = edges if slices == 1 else edges.where(F.pmod(F.xxhash64("dst"), F.lit(slices)) == index)
        return _translate(own, table, facts).where(F.col("src") < max(givers[k] for k in kinds))

    translated = translate()
    hot = None
    ordinary = translated
    if hot_ids:
        ordinary = translated.where(F.col("src") >= hot_ids)
        hot = _merged(translated.where(F.col("src") < hot_ids), shares)
        hot = hot.repartition(partitions, "src", "dst").persist(StorageLevel.MEMORY_AND_DISK)
    spread = (
        _merged(ordinary.repartition(partitions, "src"), shares)
        .sortWithinPartitions("src")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    nodes = table.select("id", "out_degree", "out_weight")
    return Layout(table.select("id", "node"), spread, hot, partitions, facts, hot_ids, givers, split, translate, nodes)


def _nan_last(x: float) -> tuple[bool, float]:
    return math.isnan(x), x
