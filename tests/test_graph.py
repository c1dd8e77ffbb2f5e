"""Graph construction and ordering."""

from collections import Counter

import pytest
from conftest import LEAKY, as_dict, pairs
from pyspark.sql import functions as F

from rankflow.operators import compare, graph, order, skew


def rows(frame):
    return sorted(tuple(row) for row in frame.collect())


def test_node_table(leaky):
    table = {r["node"]: (r["out_weight"], r["out_degree"]) for r in graph.node_table(leaky).collect()}
    assert table == {
        "1": (2.0, 2), "2": (2.0, 2), "3": (1.0, 1), "4": (0.0, 0), "5": (2.0, 2), "6": (0.0, 0),
    }
    assert rows(graph.dangling_nodes(graph.node_table(leaky))) == [("4",), ("6",)]
    assert rows(graph.nodes_without_out_edges(leaky)) == [("4",), ("6",)]
    assert graph.summary(graph.node_table(leaky)).first() == (6, 7, 2)


def test_node_set_and_degree(leaky, spark):
    extra = spark.createDataFrame([("9",)], "node STRING")
    assert rows(graph.node_set(leaky, extra)) == [(n,) for n in "1234569"]
    assert rows(graph.out_degree(leaky)) == [("1", 2), ("2", 2), ("3", 1), ("5", 2)]


def test_transitions_sum_to_one(ring_weighted):
    moves = graph.transition_probabilities(ring_weighted)
    assert moves.count() == 22
    sums = moves.groupBy("src").agg(F.sum("prob").alias("total")).collect()
    assert all(row["total"] == pytest.approx(1.0) for row in sums)


def test_transitions_leave_out_weightless_sources(make_edges):
    edges = make_edges([("a", "b", 0.0), ("b", "a", 2.0), ("b", "c", 2.0), ("b", "c", 4.0)])
    assert rows(graph.transition_probabilities(edges)) == [("b", "a", 0.25), ("b", "c", 0.75)]


def test_adjacency_one_row_per_small_node(leaky):
    lists = {r["node"]: (r["block"], r["neighbors"]) for r in graph.adjacency(leaky).collect()}
    assert lists["1"] == (0, ["2", "3"])
    assert lists["4"] == (0, [])
    assert len(lists) == 6


@pytest.mark.parametrize("min_hot_degree", [100, 10_000])
def test_adjacency_splits_hubs_without_losing_edges(make_edges, min_hot_degree):
    hub = [("hub", f"n{i}") for i in range(500)] + [("hub", "n0")] * 700 + [("a", "b"), ("a", "b")]
    lists = graph.adjacency(make_edges(hub), block_size=50, min_hot_degree=min_hot_degree).collect()
    seen = Counter()
    for row in lists:
        seen.update((row["node"], target) for target in row["neighbors"])
    assert seen == Counter(hub)
    sizes = [len(row["neighbors"]) for row in lists if row["node"] == "hub"]
    assert len(sizes) > 10 and max(sizes) < 400
    assert [row["neighbors"] for row in lists if row["node"] == "a"] == [["b", "b"]]


def test_hot_sources_are_joined_by_broadcast(make_edges, ring_weighted):
    edges = make_edges([("hub", f"n{i}") for i in range(300)] + [(f"n{i}", "hub") for i in range(300)])
    facts = graph.node_table(edges).withColumnRenamed("node", "src").cache()
    split = skew.join_sources(edges, facts, min_hot_degree=50)
    assert split.hot.count() == 300 and split.ordinary.count() == 300
    assert split.all().where("out_degree = 300").count() == 300
    # the bound on hot sources wins over a low threshold
    assert skew.join_sources(edges, facts, max_hot=1, min_hot_degree=1).hot is None
    moves = [graph.transition_probabilities(ring_weighted, min_hot_degree=m) for m in (2, 100)]
    assert rows(moves[0]) == rows(moves[1])


def test_weighted_adjacency(make_edges):
    edges = make_edges([("a", "b", 1.0), ("a", "b", 2.0), ("a", "c", 5.0)])
    row = graph.weighted_adjacency(edges).first()
    assert (row["node"], row["block"]) == ("a", 0)
    assert [tuple(link) for link in row["neighbors"]] == [("b", 3.0), ("c", 5.0)]
    for min_hot_degree in (1, 100):
        split = graph.weighted_adjacency(edges, block_size=1, min_hot_degree=min_hot_degree).collect()
        assert sorted(t for row in split for t in row["neighbors"]) == [("b", 3.0), ("c", 5.0)]


def test_dense_index_counts_on_over_all_ranges(spark):
    table = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    indexed = order.dense_index(table, F.col("v").asc()).collect()
    assert sorted((r["v"], r["index"]) for r in indexed) == [(i, i) for i in range(1000)]


def test_positions_break_ties_by_node(spark):
    ranks = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.9)], "node STRING, rank DOUBLE")
    placed = {r["node"]: r["position"] for r in order.positions(ranks).collect()}
    assert placed == {"c": 1, "a": 2, "b": 3}
    assert [r["node"] for r in order.sorted_ranks(ranks).collect()] == ["c", "a", "b"]
    assert [r["node"] for r in order.top_n(ranks, 2).collect()] == ["c", "a"]


def test_node_ids_order_as_text(spark):
    ranks = spark.createDataFrame([("2", 0.5), ("10", 0.5)], "node STRING, rank DOUBLE")
    assert [r["node"] for r in order.top_n(ranks, 2).collect()] == ["10", "2"]


def test_comparison(spark):
    a = spark.createDataFrame([("x", 0.5), ("y", 0.25)], "node STRING, rank DOUBLE")
    b = spark.createDataFrame([("x", 0.75), ("z", 0.25)], "node STRING, rank DOUBLE")
    assert compare.keyset_mismatch(a, b).first() == (1, 1)
    assert compare.max_abs_diff(a, b, on_mismatch="null").first()[0] is None
    with pytest.raises(Exception, match="one side only"):
        compare.max_abs_diff(a, b).collect()
    assert compare.max_abs_diff(a, a).first()[0] == 0.0
    c = spark.createDataFrame([("x", 0.5), ("y", 0.75)], "node STRING, rank DOUBLE")
    assert compare.l1_delta(a, c).first()[0] == 0.5
    assert compare.delta_counter(a, c).first() == (50_000_000, 0.5)
    assert compare.total(c).first()[0] == 1.25
    assert compare.spread(c).first()[0] == pytest.approx(0.125)


def test_invariants(spark, leaky):
    table = graph.node_table(leaky)
    good = table.select("node", F.lit(1 / 6).alias("rank"))
    assert compare.invariants(good, table).first() == (True, 0, 0, 0)
    bad = good.where("node != '1'").withColumn("rank", F.when(F.col("node") == "4", 0.0).otherwise(F.col("rank")))
    assert compare.invariants(bad, table).first() == (False, 1, 0, 1)
    assert len(pairs(LEAKY)) == 7 and as_dict(good)
