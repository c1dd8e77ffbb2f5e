"""Graph construction: node table, degrees, transitions, adjacency, summary.

Edges are ``src, dst`` with an optional ``w DOUBLE``. Ids are strings as read
from text; a table with integer ids works as well, and faster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.operators.order import dense_index
from rankflow.operators.skew import MIN_HOT_DEGREE, Split, join_sources
from rankflow.session import ensure_checkpoint_dir

# A neighbour list longer than this is spread over several rows.
ADJACENCY_BLOCK = 100_000


def with_weight(edges: DataFrame, weighted: bool = False) -> DataFrame:
    """``src, dst, w``: the edge weight, or 1.0 per edge when unweighted."""
    weight = F.col("w").cast("double") if weighted else F.lit(1.0)
    return edges.select("src", "dst", weight.alias("w"))


def is_bad_weight(weight: Column) -> Column:
    """Weights that have no meaning as a share: null, NaN, infinite, negative."""
    return weight.isNull() | F.isnan(weight) | (weight < 0) | (weight == float("inf"))


def endpoints(edges: DataFrame) -> DataFrame:
    """Two rows per edge, ``node, out_weight, out_degree``; the target's are 0.

    One pass over the edges, so an expensive edge source is evaluated once.
    """
    source = F.struct(
        F.col("src").alias("node"), F.col("w").alias("out_weight"), F.lit(1).cast("long").alias("out_degree")
    )
    target = F.struct(
        F.col("dst").alias("node"), F.lit(0.0).alias("out_weight"), F.lit(0).cast("long").alias("out_degree")
    )
    return edges.select(F.inline(F.array(source, target)))


def node_table(
    edges: DataFrame, weighted: bool = False, universe: DataFrame | None = None
) -> DataFrame:
    """``node, out_weight, out_degree`` for every node, zeros for sinks.

    ``universe`` (column ``node``) adds nodes that no edge mentions. Partial
    aggregation leaves at most one row per node and task to shuffle, so a hub
    costs no more than any other node.
    """
    rows = endpoints(with_weight(edges, weighted))
    if universe is not None:
        isolated = universe.select(
            F.col("node").cast(edges.schema["src"].dataType),
            F.lit(0.0).alias("out_weight"),
            F.lit(0).cast("long").alias("out_degree"),
        )
        rows = rows.unionByName(isolated.where(F.col("node").isNotNull()))
    return rows.groupBy("node").agg(
        F.sum("out_weight").alias("out_weight"), F.sum("out_degree").alias("out_degree")
    )


def node_set(edges: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Every distinct endpoint, plus the optional universe."""
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node"))
    if universe is not None:
        nodes = nodes.union(universe.select(F.col("node").cast(edges.schema["src"].dataType)))
    return nodes.distinct()


def out_degree(edges: DataFrame) -> DataFrame:
    """Number of out-edges per source, parallel edges counted."""
    return edges.groupBy(F.col("src").alias("node")).agg(F.count("dst").alias("out_degree"))


def out_weight(edges: DataFrame, weighted: bool = True) -> DataFrame:
    """Total out-weight per node, 0 for sinks."""
    return node_table(edges, weighted).select("node", "out_weight")


def dangling_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes without positive out-weight, from a node table.

    Sinks, isolated nodes and nodes whose edges all weigh 0.
    """
    return nodes.where("out_weight = 0").select("node")


def nodes_without_out_edges(edges: DataFrame) -> DataFrame:
    """Endpoints that are never a source (set difference on node ids)."""
    sources = edges.select(F.col("src").alias("node")).distinct()
    return edges.select(F.col("dst").alias("node")).distinct().join(sources, "node", "left_anti")


def cyclic_weights(edges: DataFrame, cycle: int = 5) -> DataFrame:
    """``src, dst, w``: weights 1, 2, …, ``cycle``, 1, … by the place of an edge in the order of its ids.

    Places are numbered without a global window.
    """
    placed = dense_index(edges.select("src", "dst"), F.col("src"), F.col("dst"), name="place")
    return placed.select("src", "dst", (F.col("place") % cycle + 1).cast("double").alias("w"))


def merge_parallel(edges: DataFrame) -> DataFrame:
    """One row per ``(src, dst)``: total weight and number of parallel edges.

    Map-side combining shrinks a heavily repeated pair before the shuffle.
    """
    return edges.groupBy("src", "dst").agg(
        F.sum("w").alias("w"), F.count(F.lit(1)).alias("copies")
    )


def stored_node_table(
    edges: DataFrame, weighted: bool = False, universe: DataFrame | None = None
) -> DataFrame:
    """A node table written once, for operators that read it several times."""
    ensure_checkpoint_dir(edges.sparkSession)
    return node_table(edges, weighted, universe).checkpoint()


def transition_probabilities(
    edges: DataFrame, weighted: bool = True, min_hot_degree: int = MIN_HOT_DEGREE
) -> DataFrame:
    """``src, dst, prob`` with ``prob = w / W(src)``, sources with W > 0 only."""
    flat = with_weight(edges, weighted)
    givers = stored_node_table(flat, weighted=True).where("out_weight > 0")
    facts = givers.withColumnRenamed("node", "src")
    joined = join_sources(merge_parallel(flat), facts, min_hot_degree=min_hot_degree).all()
    return joined.select("src", "dst", (F.col("w") / F.col("out_weight")).alias("prob"))


def _block_lists(split: Split, block: Column, item: Column, *facts: str) -> DataFrame:
    """Collect items per ``node, block`` (and facts of the node); hubs are first spread by block."""

    def collect(rows: DataFrame, spread: bool) -> DataFrame:
        numbered = rows.select(
            F.col("src").alias("node"), block.cast("int").alias("block"), item.alias("item"), *facts
        )
        if spread:
            numbered = numbered.repartition("node", "block")
        return numbered.groupBy("node", "block", *facts).agg(F.collect_list("item").alias("items"))

    lists = collect(split.ordinary, spread=False)
    return lists if split.hot is None else lists.unionByName(collect(split.hot, spread=True))


def adjacency(
    edges: DataFrame,
    universe: DataFrame | None = None,
    block_size: int = ADJACENCY_BLOCK,
    min_hot_degree: int = MIN_HOT_DEGREE,
    ranks: DataFrame | None = None,
) -> DataFrame:
    """``node, block, neighbors ARRAY<STRING>`` for every node.

    Parallel edges are listed as often as they occur; a sink has one empty list.
    A node with at most ``block_size`` out-edges has exactly one row. A longer
    list is cut by target hash into several rows, numbered by ``block``, and
    blocks of one hub are collected by different tasks.

    With ``ranks`` (``node, rank``) the rows are node state: the nodes that have
    a rank, and the full rank on every row. The rank joins the degrees, one row
    per node, so a hub's blocks never meet in one task.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    table = node_table(edges, universe=universe).select("node", "out_degree")
    kept = []
    if ranks is not None:
        kept = ["rank"]
        table = table.join(ranks.select("node", "rank"), "node")
    degrees = table.checkpoint()
    pairs = merge_parallel(with_weight(edges)).select("src", "dst", "copies")
    slices = F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("copies") / block_size) - 1))
    pieces = pairs.withColumn("slice", slices).withColumn(
        "size", F.least(F.lit(block_size).cast("long"), F.col("copies") - F.col("slice") * block_size)
    )
    facts = degrees.where("out_degree > 0").withColumnRenamed("node", "src")
    blocks = F.ceil(F.col("out_degree") / block_size)
    lists = _block_lists(
        join_sources(pieces, facts, min_hot_degree=min_hot_degree),
        F.pmod(F.xxhash64("dst", "slice"), blocks),
        F.array_repeat("dst", F.col("size").cast("int")),
        *kept,
    )
    filled = lists.select("node", "block", *kept, F.array_sort(F.flatten("items")).alias("neighbors"))
    empty = degrees.where("out_degree = 0").select(
        "node", F.lit(0).alias("block"), *kept, F.array().cast("array<string>").alias("neighbors")
    )
    return filled.unionByName(empty)


def weighted_adjacency(
    edges: DataFrame, block_size: int = ADJACENCY_BLOCK, min_hot_degree: int = MIN_HOT_DEGREE
) -> DataFrame:
    """``node, block, neighbors ARRAY<STRUCT<dst, w>>``, parallel edges merged.

    Blocks as in ``adjacency``; nodes without out-edges are left out.
    """
    merged = merge_parallel(with_weight(edges, weighted=True)).drop("copies")
    degrees = stored_node_table(edges).where("out_degree > 0")
    facts = degrees.select(F.col("node").alias("src"), "out_degree")
    blocks = F.ceil(F.col("out_degree") / block_size)
    lists = _block_lists(
        join_sources(merged, facts, min_hot_degree=min_hot_degree),
        F.pmod(F.xxhash64("dst"), blocks),
        F.struct("dst", "w"),
    )
    return lists.select("node", "block", F.array_sort("items").alias("neighbors"))


def summary(nodes: DataFrame) -> DataFrame:
    """One row of counts from a node table: nodes, edges, dangling nodes."""
    return nodes.agg(
        F.count(F.lit(1)).alias("nodes"),
        F.coalesce(F.sum("out_degree"), F.lit(0).cast("long")).alias("edges"),
        F.count_if(F.col("out_weight") == 0).alias("dangling"),
    )
