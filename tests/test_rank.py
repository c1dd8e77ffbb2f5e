"""Ranking: published values, brute force, edge cases, errors."""

import json
import math
import os
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import as_dict, close, golden

from rankflow import run
from rankflow.operators import chain, compare, fixed_point, graph, layout, rank, sizing
from rankflow.plans.variants import VARIANTS

TIGHT = {"epsilon": 1e-12, "max_iter": 100}

RING_13 = golden(
    "1=0.1758255550, 3=0.1690824940, 5=0.1497090814, 4=0.1481105960, 2=0.1117466976, "
    "6=0.0778570082, 8=0.0502688678, 9=0.0462583335, 7=0.0364009990, 10=0.0347403674"
)
RING_LIMIT = golden(
    "1=0.1758175834, 3=0.1691642457, 5=0.1499568365, 4=0.1483812520, 2=0.1118400487, "
    "6=0.0780620321, 8=0.0499595693, 9=0.0460249932, 7=0.0362328170, 10=0.0345606221"
)
RING_DELTAS = [
    0.31166667, 0.13245833, 0.09553056, 0.06307576, 0.03338061, 0.02400836, 0.01225663,
    0.00911718, 0.00497875, 0.00378381, 0.00214685, 0.00158056, 0.00092578,
]


def brute_force(edges, steps, damping=0.85, scores=None, extra=(), redistribute=True, start=None):
    """Plain loop over the formula; edges are (src, dst, weight)."""
    nodes = sorted({n for s, d, _ in edges for n in (s, d)} | set(extra))
    weight = dict.fromkeys(nodes, 0.0)
    for s, _, w in edges:
        weight[s] += w
    if scores is None:
        p = dict.fromkeys(nodes, 1 / len(nodes))
    else:
        positive = {n: max(0.0, scores.get(n, 0.0)) for n in nodes}
        p = {n: v / sum(positive.values()) for n, v in positive.items()}
    ranks = dict.fromkeys(nodes, 1 / len(nodes) if start is None else start)
    for _ in range(steps):
        lost = sum(r for n, r in ranks.items() if weight[n] == 0) if redistribute else 0.0
        new = {n: (1 - damping + damping * lost) * p[n] for n in nodes}
        for s, d, w in edges:
            if weight[s] > 0:
                new[d] += damping * ranks[s] * w / weight[s]
        ranks = new
    return ranks


def test_standard_stops_like_published(ring):
    result = run(ring)
    assert (result.iterations, result.converged, result.num_nodes) == (13, True, 10)
    assert close(as_dict(result.ranks), RING_13)
    assert [round(d, 8) for d in result.deltas] == RING_DELTAS
    assert result.total() == pytest.approx(1.0, abs=1e-12)
    assert [r["node"] for r in result.top(3).collect()] == ["1", "3", "5"]
    assert result.top(50).count() == 10


def test_standard_limit(ring):
    assert close(as_dict(run(ring, **TIGHT).ranks), RING_LIMIT)


def test_personalized_limit(ring):
    one = golden(
        "1=0.3003463820, 3=0.2061304655, 5=0.1476257274, 2=0.1446529582, 4=0.1412241873, "
        "6=0.0600202796, 10=0, 7=0, 8=0, 9=0"
    )
    two = golden(
        "1=0.2692058604, 3=0.2372709871, 5=0.1608604491, 4=0.1412241873, 2=0.1314182365, "
        "6=0.0600202796, 10=0, 7=0, 8=0, 9=0"
    )
    assert close(as_dict(run(ring, personalization={"1": 1.0}, **TIGHT).ranks), one)
    assert close(as_dict(run(ring, personalization={"1": 1.0, "3": 0.5}, **TIGHT).ranks), two)


def test_weighted(ring_weighted):
    stop = golden(
        "1=0.2257212813, 3=0.2044780699, 4=0.1384938950, 5=0.0910632337, 2=0.0910627921, "
        "6=0.0856394353, 9=0.0497316277, 8=0.0464464832, 10=0.0391703321, 7=0.0281928497"
    )
    result = run(ring_weighted, weighted=True)
    assert result.iterations == 14
    assert close(as_dict(result.ranks), stop)


def test_weight_column_is_ignored_when_unweighted(ring_weighted):
    assert close(as_dict(run(ring_weighted).ranks), RING_13)


def test_dangling_redistributed(leaky):
    stop = golden(
        "1=0.2877849558, 3=0.2747057571, 2=0.1765270285, 4=0.1293720045, 6=0.0773424107, "
        "5=0.0542678433"
    )
    result = run(leaky)
    assert result.iterations == 11
    assert close(as_dict(result.ranks), stop)
    to_one = golden(
        "1=0.4522328999, 3=0.2738835500, 2=0.1921989825, 4=0.0816845676, 5=0, 6=0"
    )
    assert close(as_dict(run(leaky, personalization={"1": 1.0}, **TIGHT).ranks), to_one)


def test_dangling_dropped(leaky):
    stop = golden(
        "1=0.1335370459, 3=0.1274005989, 2=0.0818919215, 4=0.0598836775, 6=0.0356250000, "
        "5=0.0250000000"
    )
    result = run(leaky, dangling="drop")
    assert result.iterations == 16
    assert close(as_dict(result.ranks), stop)
    assert result.total() == pytest.approx(0.4633382438, abs=1e-9)
    assert compare.mass_leak(result.ranks).first()["leak"] == pytest.approx(1 - 0.4633382438, abs=1e-9)


def test_start_at_one(ring):
    result = run(ring, dangling="drop", init="one")
    assert result.iterations == 46
    assert result.total() == pytest.approx(1.0050993297, abs=1e-9)
    assert as_dict(result.ranks)["1"] == pytest.approx(0.1768045502, abs=1e-9)


def test_rounded_variants_stay_close(ring):
    exact = as_dict(run(ring, epsilon=0.0, max_iter=20, dangling="drop").ranks)
    text = as_dict(run(ring, **VARIANTS["single_pass_text"]).ranks)
    assert close(text, exact, 1e-6)
    assert all(round(value, 8) == value for value in text.values())
    unit = as_dict(run(ring, **VARIANTS["unit_start_text"]).ranks)
    full = as_dict(run(ring, epsilon=0.0, max_iter=20, dangling="drop", init="one").ranks)
    assert close(unit, full, 1e-6)


def test_step_budget(ring):
    none = run(ring, max_iter=0)
    assert (none.iterations, none.converged, none.deltas) == (0, False, [])
    assert close(as_dict(none.ranks), dict.fromkeys(RING_13, 0.1))
    assert none.history.count() == 0
    some = run(ring, epsilon=0.0, max_iter=3)
    assert (some.iterations, some.converged) == (3, False)


def test_stop_is_strict(make_edges):
    cycle = make_edges("a>b b>a")
    result = run(cycle, epsilon=0.0, max_iter=4)
    assert (result.deltas, result.converged) == ([0.0] * 4, False)
    assert [r["node"] for r in result.top(2).collect()] == ["a", "b"]


def random_graph(seed, nodes=40, edges=200):
    rng = random.Random(seed)
    names = [f"n{i}" for i in range(nodes)]
    # squared draws give hubs; repeated pairs and self-loops occur
    pick = lambda: names[int(nodes * rng.random() ** 2)]
    return [(pick(), pick(), float(rng.choice([0, 1, 1, 2, 5]))) for _ in range(edges)]


@pytest.mark.parametrize("hot_degree", [None, 3])
@pytest.mark.parametrize("redistribute", [True, False])
def test_brute_force_with_and_without_hot_sources(make_edges, hot_degree, redistribute):
    edges = random_graph(7)
    scores = {"n0": 2.0, "n5": 1.0, "n7": -4.0, "absent": 9.0}
    result = run(
        make_edges(edges),
        epsilon=0.0,
        max_iter=6,
        weighted=True,
        personalization=scores,
        dangling="teleport" if redistribute else "drop",
        partitions=3,
        hot_degree=hot_degree,
    )
    expected = brute_force(edges, 6, scores=scores, redistribute=redistribute)
    assert close(as_dict(result.ranks), expected, 1e-12)


def test_one_source_with_a_third_of_all_edges(make_edges):
    hub = [("hub", f"n{i}", 1.0) for i in range(300)]
    rest = [(f"n{i}", f"n{(i * 7 + 1) % 300}", 1.0) for i in range(600 // 2)] * 2
    edges = hub + rest + [("n1", "hub", 1.0)]
    built = rank.prepare(make_edges(edges), [rank.RankSpec()], partitions=4, hot_degree=50).layout
    assert (built.facts.nodes, built.hot_ids) == (301, 1)
    assert built.names.where("id = 0").first()["node"] == "hub"
    assert built.hot is not None and built.hot.count() == 300
    assert built.spread.where("src = 0").isEmpty()
    built.release()
    result = run(make_edges(edges), epsilon=0.0, max_iter=5, partitions=4, hot_degree=50)
    assert close(as_dict(result.ranks), brute_force(edges, 5), 1e-12)


def test_numbers_are_dense_and_tell_the_kind_of_node(make_edges):
    edges = random_graph(3) + [("weightless", "n0", 0.0), ("n1", "sink", 1.0)]
    built = rank.prepare(make_edges(edges), [rank.RankSpec(weighted=True), rank.RankSpec()], partitions=3).layout
    names = {r["node"]: r["id"] for r in built.names.collect()}
    assert sorted(names.values()) == list(range(len(names)))
    weight, degree = dict.fromkeys(names, 0.0), dict.fromkeys(names, 0)
    for s, _, w in edges:
        weight[s] += w
        degree[s] += 1
    assert {n for n, i in names.items() if i >= built.givers[True]} == {n for n, w in weight.items() if w == 0}
    assert {n for n, i in names.items() if i >= built.givers[False]} == {n for n, d in degree.items() if d == 0}
    by_number = sorted((i, degree[n].bit_length()) for n, i in names.items() if weight[n] > 0)
    assert [bits for _, bits in by_number] == sorted((bits for _, bits in by_number), reverse=True)
    built.release()


def test_hubs_are_translated_by_broadcast(make_edges, monkeypatch):
    """Neither a hub of sources nor one of targets meets its number in one task."""
    monkeypatch.setattr(layout, "MIN_HOT_DEGREE", 40)
    monkeypatch.setattr(layout, "_BROADCAST_BYTES", 0)
    edges = [("hub", f"n{i}", 1.0) for i in range(100)] + [(f"n{i}", "goal", 2.0) for i in range(100)] + [("goal", "n1", 1.0)]
    result = run(make_edges(edges), epsilon=0.0, max_iter=4, weighted=True, partitions=3)
    assert close(as_dict(result.ranks), brute_force(edges, 4), 1e-12)


def test_parallel_edges_count_twice(make_edges):
    edges = [("a", "b", 1.0), ("a", "b", 1.0), ("a", "c", 1.0), ("b", "a", 1.0), ("c", "a", 1.0)]
    ranks = as_dict(run(make_edges(edges), epsilon=0.0, max_iter=5).ranks)
    assert close(ranks, brute_force(edges, 5), 1e-12)
    assert ranks["b"] > ranks["c"]


def test_self_loop_is_not_dangling(make_edges):
    result = run(make_edges("a>a b>a"))
    assert result.total() == pytest.approx(1.0)
    assert result.history.where("dangling_mass > 0").isEmpty()


def test_zero_weights_are_dangling(make_edges):
    edges = make_edges([("a", "b", 0.0)])
    table = graph.node_table(edges, weighted=True)
    assert graph.dangling_nodes(table).count() == 2
    assert close(as_dict(run(edges, weighted=True).ranks), {"a": 0.5, "b": 0.5})


def test_node_universe(spark, make_edges):
    universe = spark.createDataFrame([("c",), ("a",), ("c",)], "node STRING")
    result = run(make_edges("a>b"), nodes=universe, epsilon=0.0, max_iter=4)
    assert result.num_nodes == 3
    assert close(as_dict(result.ranks), brute_force([("a", "b", 1.0)], 4, extra=["c"]), 1e-12)


def test_isolated_nodes_alone_are_a_graph(spark, make_edges):
    universe = spark.createDataFrame([("x",), ("y",)], "node STRING")
    result = run(make_edges([]), nodes=universe)
    assert close(as_dict(result.ranks), {"x": 0.5, "y": 0.5})


def test_null_endpoints_are_dropped(make_edges):
    result = run(make_edges([("a", "b"), (None, "b"), ("a", None), ("b", "a")]))
    assert as_dict(result.ranks).keys() == {"a", "b"}


def test_integer_ids(spark, ring):
    edges = ring.selectExpr("CAST(src AS BIGINT) AS src", "CAST(dst AS BIGINT) AS dst")
    extra = spark.createDataFrame([(77,)], "node BIGINT")
    result = run(edges, nodes=extra, personalization={"1": 1.0, 3: 0.5}, epsilon=0.0, max_iter=4)
    text = run(ring, nodes=extra, personalization={"1": 1.0, "3": 0.5}, epsilon=0.0, max_iter=4)
    assert dict(result.ranks.dtypes)["node"] == "bigint"
    assert close({str(k): v for k, v in as_dict(result.ranks).items()}, as_dict(text.ranks), 1e-15)


def test_personalization_as_table(spark, ring):
    scores = spark.createDataFrame([("1", 1.0), ("3", 0.5)], "node STRING, score DOUBLE")
    table = as_dict(run(ring, personalization=scores, epsilon=0.0, max_iter=5).ranks)
    plain = as_dict(run(ring, personalization={"1": 1.0, "3": 0.5}, epsilon=0.0, max_iter=5).ranks)
    assert close(table, plain, 1e-15)


@pytest.mark.parametrize("damping", [1.0, 1.5, -0.1])
def test_damping_range(ring, damping):
    with pytest.raises(ValueError, match="damping"):
        run(ring, damping=damping)


def test_empty_graph(make_edges):
    with pytest.raises(ValueError, match="no nodes"):
        run(make_edges([]))


def test_useless_personalization(ring):
    for scores in ({"absent": 1.0}, {"1": -1.0}, {}):
        with pytest.raises(ValueError, match="positive restart"):
            run(ring, personalization=scores)


@pytest.mark.parametrize("weight", [-1.0, float("nan"), float("inf"), None])
def test_bad_weights(make_edges, weight):
    with pytest.raises(ValueError, match="weights"):
        run(make_edges([("a", "b", 1.0), ("b", "a", weight)]), weighted=True)


def test_unknown_options(ring):
    with pytest.raises(ValueError, match="dangling"):
        run(ring, dangling="keep")
    with pytest.raises(ValueError, match="init"):
        run(ring, init="zero")


def test_session_settings_are_restored(spark, ring):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run(ring, epsilon=0.0, max_iter=1)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


@pytest.mark.parametrize("sets", [1, 3])
def test_step_shuffles_only_the_inflow(ring, capsys, sets):
    """No exchange and no sort for edges or state: one exchange per step, whatever the number of sets."""
    batch = rank.prepare(ring, [rank.RankSpec(damping=0.5 + k / 10) for k in range(sets)], partitions=3)
    with batch.settings():
        start = batch.start()
        held = batch.held_at_start(start)
        state, seen = batch.settle(batch.step(start, held))
        assert state.columns == ["id", *[f"rank{k}" for k in range(sets)]]
        batch.step(state, [batch.measured(seen, k)[1] for k in range(sets)]).explain()
    plan = capsys.readouterr().out.split("InMemoryRelation")[0]
    assert plan.count("Exchange") == 1
    assert plan.count("SortMergeJoin") == 2
    assert plan.count("Sort [") == 1  # the inflow, after its aggregation
    batch.layout.release()


def test_sets_run_together_as_they_do_alone(spark, make_edges):
    edges = make_edges(random_graph(11))
    stored = spark.createDataFrame([("n0", 0.5), ("n3", 0.5)], "node STRING, rank DOUBLE")
    options = [
        {"damping": 0.5},
        {"weighted": True, "epsilon": 1e-6},
        {"weighted": True, "personalization": {"n1": 1.0, "n2": 3.0}, "max_iter": 4, "epsilon": 0.0},
        {"dangling": "drop", "init": "one", "precision": 8, "share_precision": 10},
        {"personalization": {"n5": 1.0}, "epsilon": 1e-2},
        {"init": stored, "max_iter": 3},
        {"max_iter": 0},
    ]
    together = rank.run_many(edges, [rank.RankSpec(**o) for o in options], partitions=3)
    assert len({r.iterations for r in together}) > 4
    for option, result in zip(options, together, strict=True):
        alone = run(edges, partitions=3, **option)
        assert (result.iterations, result.converged) == (alone.iterations, alone.converged)
        assert close(as_dict(result.ranks), as_dict(alone.ranks), 1e-12)
        assert close(dict(enumerate(result.deltas)), dict(enumerate(alone.deltas)), 1e-12)


def test_history_does_not_depend_on_partitions(make_edges):
    """The same bits at 4 and at 32 partitions, and whatever the order of the edges."""
    rows = random_graph(5, nodes=300, edges=3000)
    runs = [
        run(make_edges(edges).repartition(parts), epsilon=0.0, max_iter=8, weighted=True, partitions=parts)
        for edges, parts in ((rows, 4), (rows[::-1], 32))
    ]
    histories = [[tuple(r) for r in result.history.orderBy("iteration").collect()] for result in runs]
    assert histories[0] == histories[1]
    assert as_dict(runs[0].ranks) == as_dict(runs[1].ranks)
    assert close(as_dict(runs[0].ranks), brute_force(rows, 8), 1e-14)
    plain = run(make_edges(rows), epsilon=0.0, max_iter=8, weighted=True, exact_sums=False)
    assert close(as_dict(plain.ranks), as_dict(runs[0].ranks), 1e-14)


def test_sums_in_limbs(spark):
    rng = random.Random(2)
    values = [rng.random() * 10.0 ** -rng.randint(0, 25) for _ in range(2000)] + [0.0, 1.0]
    rows = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    bits = fixed_point.first_bits(sum(values))
    high, low = fixed_point.limbs("v", bits)
    seen = rows.selectExpr(f"sum({high}) AS h", f"sum({low}) AS l").first()
    assert fixed_point.value(seen["h"], seen["l"], bits) == pytest.approx(math.fsum(values), rel=1e-15)
    assert fixed_point.value(None, None, bits) == 0.0


def test_rounding_rules(spark):
    """Halves: of the shortest decimal text, or of the exact value; true halves are rare."""
    values = [0.5, 1.5, 2.5, 0.125, 0.375, 2.675, 1.005, 0.285, 0.1, 1e-9, 0.3, 1 / 3, 4.5, 0.0625, 0.1875]
    rng = random.Random(9)
    values += [round(rng.random(), d) + 5 * 10.0 ** -(d + 1) for d in range(1, 11) for _ in range(40)]
    rows = spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    for digits in (0, 1, 2, 3, 4, 8, 10, 11):
        texts = [f"{fixed_point.rounded('v', digits, rule)} AS {rule}" for rule in ("up", "even")]
        for value, row in zip(values, rows.selectExpr(*texts).collect(), strict=True):
            assert row["even"] == float(f"{value:.{digits}f}"), (value, digits)
            short = Decimal(repr(value)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP)
            assert row["up"] == float(short), (value, digits)
    assert float(f"{2.5:.0f}") == 2.0 and float(f"{0.125:.2f}") == 0.12 and float(f"{2.675:.2f}") == 2.67
    with pytest.raises(ValueError, match="digits"):
        fixed_point.rounded("v", 12, "even")


def test_rounding_rules_differ_in_a_run(make_edges):
    """Four nodes share a half, so each of their ranks ends in a true half at three digits."""
    edges = make_edges([("a", "b"), ("b", "a"), ("c", "a"), ("d", "a"), ("e", "a"), ("f", "a"), ("g", "a"), ("h", "a")])
    up, even = rank.run_many(
        edges, [rank.RankSpec(damping=0.5, epsilon=0.0, max_iter=1, precision=3, rounding=rule) for rule in ("up", "even")]
    )
    assert as_dict(up.ranks)["c"] == 0.063 and as_dict(even.ranks)["c"] == 0.062


def test_partition_choice():
    assert sizing.choose_partitions(0, 200) == 1
    assert sizing.choose_partitions(10_000_000, 200) == 200
    huge = sizing.choose_partitions(10**12, 200)
    assert 10**12 / huge <= 32_000_000
    assert layout.choose_hot_degree(10**12, huge) * 4 * huge >= 10**12 * 0.99
    assert layout.choose_hot_degree(100, 4) == 200_000


def test_history_checks(leaky):
    history = run(leaky).history
    steps = compare.history_steps(history).orderBy("iteration").collect()
    assert steps[0]["previous_delta"] is None
    assert all(row["falling"] for row in steps)
    assert compare.iterations_to_converge(history, 1e-3).first() == (11, True)
    assert compare.iterations_to_converge(history, 1e-9).first() == (11, False)


def test_damping_matters(ring):
    low, high = run(ring, damping=0.5).ranks, run(ring, damping=0.95).ranks
    assert compare.max_abs_diff(low, high).first()[0] > 1e-3


def test_resumed_run_equals_one_run(make_edges, ring_weighted):
    first = run(ring_weighted, epsilon=0.0, max_iter=4, weighted=True)
    twice = first.ranks.unionAll(first.ranks)  # slices of a hub repeat its rank
    second = run(ring_weighted, epsilon=0.0, max_iter=3, weighted=True, init=twice)
    whole = run(ring_weighted, epsilon=0.0, max_iter=7, weighted=True)
    assert close(as_dict(second.ranks), as_dict(whole.ranks))
    assert close(dict(enumerate(second.deltas)), dict(enumerate(whole.deltas[4:])))


def test_resume_with_missing_and_unknown_nodes(spark, make_edges):
    state = spark.createDataFrame([("a", 1.0), ("z", 5.0)], "node STRING, rank DOUBLE")
    edges = make_edges([("a", "b"), ("b", "a"), ("c", "a")])
    ranks = as_dict(run(edges, epsilon=0.0, max_iter=1, init=state).ranks)
    assert close(ranks, {"a": 0.05, "b": 0.9, "c": 0.05})


def test_stop_by_whole_units(ring):
    exact = run(ring, epsilon=0.1, max_iter=20)
    coarse = run(ring, epsilon=0.1, max_iter=20, unit_digits=1)
    assert coarse.iterations <= exact.iterations
    assert all(abs(d * 10 - round(d * 10)) < 1e-9 for d in coarse.deltas)
    fine = run(ring, epsilon=1e-3, max_iter=20, unit_digits=8)
    assert fine.iterations == 13 and abs(fine.deltas[0] - 0.31166667) < 1e-7


def test_at_most_two_states_stay_on_disk(spark, ring):
    rank.ensure_checkpoint_dir(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(spark.sparkContext.getCheckpointDir())
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())

    def folders():
        return {str(entry.getPath().getName()) for entry in files.listStatus(path)}

    before = folders()
    result = run(ring, epsilon=0.0, max_iter=20)
    assert len(folders() - before) <= 3  # the node table and two states
    assert result.ranks.count() == 10


def test_source_is_held_until_released(spark, tmp_path, make_edges):
    make_edges([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")]).write.parquet(str(tmp_path / "edges"))
    built = rank.prepare(spark.read.parquet(str(tmp_path / "edges")), [rank.RankSpec()]).layout
    assert built.source.is_cached
    built.release()
    assert built.source is None


@pytest.mark.parametrize("rule", [{}, {"dangling": "teleport"}, {"init": "one", "precision": 8, "share_precision": 10}])
def test_chain_of_files_equals_a_run(tmp_path, leaky, rule):
    result = chain.run_chain(leaky, str(tmp_path / "chain"), chain.ChainRule(**rule), epsilon=1e-3, max_iter=50)
    alone = run(leaky, **({"dangling": "drop"} | rule))
    assert (result.iterations, result.converged, result.num_nodes) == (alone.iterations, True, 6)
    assert close(as_dict(result.ranks), as_dict(alone.ranks), 1e-12)
    assert close(dict(enumerate(result.deltas)), dict(enumerate(alone.deltas)), 1e-12)


@pytest.mark.parametrize("style", ["tsv", "json", "pipe"])
def test_broken_chain_goes_on_from_the_last_whole_state(spark, tmp_path, ring, monkeypatch, style):
    folder, rule = str(tmp_path / "chain"), chain.ChainRule(style=style, precision=8)
    commit = chain.Manifest.commit

    def killed(self, entry):
        if entry["iteration"] == 4:  # the state is written, its entry isn't
            raise KeyboardInterrupt
        commit(self, entry)

    monkeypatch.setattr(chain.Manifest, "commit", killed)
    with pytest.raises(KeyboardInterrupt):
        chain.run_chain(ring, folder, rule, epsilon=0.0, max_iter=7)
    monkeypatch.undo()
    assert {"state-000003", "state-000004"} <= set(os.listdir(folder))
    marked = os.path.join(folder, "state-000004", "part-damaged")
    with open(marked, "w", encoding="utf-8") as out:
        out.write("half a line")
    result = chain.run_chain(None, folder, rule, epsilon=0.0, max_iter=7, spark=spark)
    assert result.iterations == 7 and not os.path.exists(marked)
    assert [n for n in os.listdir(folder) if n.startswith("state")] == ["state-000007"]
    whole = run(ring, dangling="drop", precision=8, epsilon=0.0, max_iter=7)
    assert close(as_dict(result.ranks), as_dict(whole.ranks), 1e-12)
    assert [r["iteration"] for r in result.history.collect()] == list(range(1, 8))
    again = chain.run_chain(None, folder, rule, epsilon=0.0, max_iter=7, spark=spark)
    assert as_dict(again.ranks) == as_dict(result.ranks)
    with pytest.raises(ValueError, match="begun with"):
        chain.run_chain(None, folder, chain.ChainRule(damping=0.5), spark=spark)
    with open(os.path.join(folder, "manifest", "000003.json"), encoding="utf-8") as entry:
        assert json.loads(entry.read())["iteration"] == 3


def test_chain_needs_a_beginning(spark, tmp_path, make_edges):
    with pytest.raises(ValueError, match="no committed state"):
        chain.run_chain(None, str(tmp_path / "none"), spark=spark)
    with pytest.raises(ValueError, match="no nodes"):
        chain.run_chain(make_edges([]), str(tmp_path / "empty"))
