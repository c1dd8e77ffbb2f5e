"""Synthetic graphs, repair, and run statistics."""

import pytest
from pyspark.sql import functions as F

from rankflow.operators import graph, measure, synth
from rankflow.sources import edges as edge_source


def test_scale_free_shape(spark):
    edges = synth.generate(spark, 3000, remove_dangling=False).cache()
    count = edges.count()
    assert count == 3 * (3000 - 3)
    assert edges.where(F.col("src").cast("int") >= F.col("dst").cast("int")).isEmpty()
    assert edges.distinct().count() == count
    assert graph.node_set(edges).count() == 3000
    both = edges.select(F.explode(F.array("src", "dst")).alias("n")).groupBy("n").count()
    top, smallest = both.agg(F.max("count"), F.min("count")).first()
    assert top > 60 and smallest >= 1  # heavy tail: the mean degree is 6


@pytest.mark.parametrize(("nodes", "m"), [(2, 1), (9, 4), (60, 12), (700, 5)])
def test_every_node_has_m_different_targets(spark, nodes, m):
    edges = synth.scale_free_edges(spark.range(nodes), nodes, m)
    found = [(int(r["src"]), int(r["dst"])) for r in edges.collect()]
    assert len(set(found)) == len(found) == m * (nodes - m)
    assert all(s < d and d >= m for s, d in found)


def test_generation_depends_on_the_seed_only(spark):
    first = sorted(map(tuple, synth.generate(spark, 300, seed=1).collect()))
    assert first == sorted(map(tuple, synth.generate(spark, 300, seed=1).repartition(3).collect()))
    assert first != sorted(map(tuple, synth.generate(spark, 300, seed=2).collect()))


def test_generated_graph_has_no_dangling_node(spark):
    edges = synth.generate(spark, 500, weighted=True).cache()
    assert graph.summary(graph.node_table(edges, weighted=True)).first()["dangling"] == 0
    assert edges.where("src = dst").isEmpty()
    weights = {r["w"] for r in edges.select("w").distinct().collect()}
    assert weights == set(map(float, range(1, 11)))


def test_repair_adds_one_link_per_sink(leaky):
    fixed = synth.repair_dangling(leaky)
    added = fixed.exceptAll(leaky).collect()
    assert sorted(r["src"] for r in added) == ["4", "6"]
    assert all(r["src"] != r["dst"] for r in added)
    assert graph.nodes_without_out_edges(fixed).isEmpty()


def test_repair_of_two_nodes_and_of_one(spark, make_edges):
    assert sorted(map(tuple, synth.repair_dangling(make_edges("a>b")).collect())) == [("a", "b"), ("b", "a")]
    alone = spark.createDataFrame([("a",)], "node STRING")
    assert synth.repair_links(make_edges([]), alone).isEmpty()


def test_too_few_nodes(spark):
    with pytest.raises(ValueError, match="links per node"):
        synth.generate(spark, 3)


def test_batch(spark, tmp_path):
    written = synth.generate_batch(spark, str(tmp_path), [20, 40])
    assert [path.rsplit("/", 1)[1] for path in written] == ["graph_20", "graph_40"]
    for path, size in zip(written, (20, 40), strict=True):
        assert graph.node_set(edge_source.read_edges(spark, path)).count() == size


def _runs(spark):
    rows = [
        ("b", "Base", 100, 300, 1.0, 10.0, 30, 0.0),
        ("b", "Base", 100, 300, 2.0, 12.0, 30, 0.0),
        ("f", "Fast", 100, 300, 0.5, None, 30, 2e-9),
        ("f", "Fast", 200, 600, 0.7, None, 30, 5e-9),
    ]
    return spark.createDataFrame(
        rows,
        "framework STRING, label STRING, n_nodes INT, n_edges INT, time_s DOUBLE, peak_mem_mb DOUBLE, "
        "iterations INT, max_diff_vs_core DOUBLE",
    )


def test_summary_of_repeats(spark):
    got = {(r["label"], r["n_nodes"]): r for r in measure.summarize(_runs(spark)).collect()}
    base = got["Base", 100]
    assert (base["time_s"], base["time_s_std"], base["n_runs"]) == (1.5, 0.7071, 2)
    assert (base["peak_mem_mb"], base["peak_mem_mb_std"]) == (11.0, 1.4)
    fast = got["Fast", 200]
    assert (fast["time_s_std"], fast["peak_mem_mb"], fast["peak_mem_mb_std"]) == (0.0, None, None)


def test_measured_series(spark):
    results = measure.summarize(_runs(spark)).cache()
    assert [tuple(r)[:2] for r in measure.runtime_series(results).collect()] == [
        ("Base", 100), ("Fast", 100), ("Fast", 200),
    ]
    assert [r["label"] for r in measure.memory_series(results).collect()] == ["Base"]
    assert [tuple(r) for r in measure.speedup(results, "Base").collect()] == [
        ("Base", 100, 1.0), ("Fast", 100, 3.0),
    ]
    assert measure.speedup(results, "Absent").isEmpty()
    assert [tuple(r) for r in measure.worst_error(results).collect()] == [("Base", 1e-16), ("Fast", 5e-9)]
