"""Synthetic graphs and repair of dangling nodes.

Preferential attachment is sequential by definition: a new node links to old
ones in proportion to their degree. It parallelises because drawing a node by
degree equals drawing a slot of the flat edge list uniformly, and the content of
a slot can be traced back alone from seeded draws (Batagelj and Brandes 2005;
Sanders and Schulz 2016). No task needs the graph built so far.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions.draws import draw_below
from rankflow.operators import graph
from rankflow.operators.order import dense_index
from rankflow.session import ensure_checkpoint_dir
from rankflow.sources.edges import write_edges

# Attachment degree, seed, batch sizes, and the weight range.
ATTACHMENT = 3
SEED = 42
SIZES = (1000, 5000, 10000, 50000, 100000)
MAX_WEIGHT = 10

# Hops tried while tracing a slot. A hop ends the trace with probability 1/2, so
# a longer trace has odds of 2**-64; it then resolves to the newest candidate.
_HOPS = 64


def integer_weight(seed: int, *key: Column) -> Column:
    """A weight from 1 to 10 drawn for the key."""
    return (draw_below(seed, F.lit(MAX_WEIGHT).cast("long"), F.lit("w"), *key) + 1).cast("double")


def _older_node(slot: Column, m: int, seed: int) -> Column:
    """The node that a slot of the flat edge list holds.

    Edge ``k`` owns slot ``2k`` (its new node ``m + k div m``) and slot ``2k+1``
    (its target). The first new node links to the seed nodes ``0..m-1``; any
    later target copies a slot drawn from the edges of all earlier nodes.
    """

    def hop(slot: Column, _: Column) -> Column:
        owner = F.floor(slot / 2)
        open_target = (slot % 2 == 1) & (owner >= m)
        earlier = F.floor(owner / m) * (2 * m)
        return F.when(open_target, draw_below(seed, earlier, slot)).otherwise(slot)

    end = F.aggregate(F.sequence(F.lit(1), F.lit(_HOPS)), slot, hop)
    owner = F.floor(end / 2)
    node = F.when(end % 2 == 0, m + F.floor(owner / m)).when(owner < m, owner)
    # the odds are 2 ** -_HOPS an edge; an invented target would be worse than a failure
    return F.coalesce(node, F.raise_error(F.lit("an edge was not traced to its end")).cast("long"))


def _drawn_targets(first: int, stop: int, m: int, seed: int) -> Column:
    """Draws ``first .. stop-1`` of a node, repeats included.

    The first ``m`` are the node's own slots; further ones are drawn for the node and
    the number of the draw, from the edges of all earlier nodes as well.
    """
    before = (F.col("node") - m) * m  # edges of earlier nodes

    def target(draw: Column) -> Column:
        again = draw_below(seed, before * 2, F.lit("again"), F.col("node"), draw)
        return _older_node(F.when(draw < m, (before + draw) * 2 + 1).otherwise(again), m, seed)

    return F.transform(F.sequence(F.lit(first).cast("long"), F.lit(stop - 1).cast("long")), target)


def scale_free_edges(
    nodes: DataFrame, count: int, m: int = ATTACHMENT, seed: int = SEED, weighted: bool = False
) -> DataFrame:
    """Scale-free directed edges over the nodes ``id = 0 .. count-1``.

    Every node from ``m`` on links to ``m`` different earlier nodes, oriented from
    the lower to the higher id: ``m * (count - m)`` edges. A target that is drawn
    again for a node is replaced by the node's next draw. Nodes that are still short
    draw on in rounds, twice as often in each, row by row and without a shuffle;
    their number falls by a large factor every time.
    """
    if count <= m:
        raise ValueError(f"{m} links per node need more than {count} nodes")
    ensure_checkpoint_dir(nodes.sparkSession)
    new = nodes.where(F.col("id") >= m).select(F.col("id").cast("long").alias("node"))
    short = new.withColumn("targets", F.array().cast("array<bigint>"))
    complete, first, stop = None, 0, 2 * m
    while True:
        drawn = F.concat("targets", _drawn_targets(first, stop, m, seed))
        if first == 0:  # the first new node has its own slots only, and they hold different nodes
            own = _drawn_targets(0, m, m, seed)
            drawn = F.when(F.col("node") == m, own).otherwise(drawn)
        rows = short.withColumn("targets", F.slice(F.array_distinct(drawn), 1, m)).checkpoint()
        whole = rows.where(F.size("targets") == m)
        complete = whole if complete is None else complete.unionByName(whole)
        short = rows.where(F.size("targets") < m)
        if short.isEmpty():
            break
        first, stop = stop, 2 * stop
    linked = complete.select("node", F.explode("targets").alias("older"))
    edges = linked.select(F.col("older").cast("string").alias("src"), F.col("node").cast("string").alias("dst"))
    if not weighted:
        return edges
    return edges.withColumn("w", integer_weight(seed, F.col("src"), F.col("dst")))


def generate(
    spark: SparkSession,
    nodes: int,
    m: int = ATTACHMENT,
    seed: int = SEED,
    weighted: bool = False,
    remove_dangling: bool = True,
) -> DataFrame:
    """A scale-free graph of a given size, by default without dangling nodes."""
    ids = spark.range(nodes)
    edges = scale_free_edges(ids, nodes, m, seed, weighted)
    if not remove_dangling:
        return edges
    universe = ids.select(F.col("id").cast("string").alias("node"))
    return repair_dangling(edges, universe, seed, weighted)


def generate_batch(
    spark: SparkSession,
    folder: str,
    sizes: Iterable[int] = SIZES,
    m: int = ATTACHMENT,
    seed: int = SEED,
    weighted: bool = False,
) -> list[str]:
    """Write one generated graph per size; returns the folders written."""
    written = []
    for size in sizes:
        path = f"{folder.rstrip('/')}/graph_{size}"
        write_edges(generate(spark, size, m, seed, weighted), path)
        written.append(path)
    return written


def repair_links(edges: DataFrame, universe: DataFrame | None = None, seed: int = SEED) -> DataFrame:
    """One edge ``src, dst`` from every node without out-edges to another node.

    Nodes are numbered in id order; sink ``i`` of ``n`` links to node
    ``(i + 1 + draw below n-1) mod n``, which is never itself. A graph of one
    node has no other node, hence no link.
    """
    degrees = graph.stored_node_table(edges, universe=universe).select("node", "out_degree")
    size = degrees.count()
    numbered = dense_index(degrees, F.col("node").asc(), rows=size)
    sinks = numbered.where((F.col("out_degree") == 0) & F.lit(size > 1))
    jump = draw_below(seed, F.lit(max(size - 1, 1)), F.col("node"))
    chosen = sinks.select(
        F.col("node").alias("src"), ((F.col("index") + 1 + jump) % F.lit(size)).alias("index")
    )
    return chosen.join(numbered.select("index", F.col("node").alias("dst")), "index").select("src", "dst")


def repair_dangling(
    edges: DataFrame,
    universe: DataFrame | None = None,
    seed: int = SEED,
    weighted: bool = False,
) -> DataFrame:
    """The edges plus one out-link for every node that had none."""
    links = repair_links(edges, universe, seed)
    if weighted:
        links = links.withColumn("w", integer_weight(seed, F.col("src"), F.col("dst")))
    return edges.unionByName(links)


