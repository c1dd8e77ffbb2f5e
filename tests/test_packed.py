"""Steps on packed edges against steps on rows, and what they leave behind."""

import random
import time

import numpy as np
import pytest

from rankflow.operators import packed, rank


def some_edges(seed, nodes=50, edges=400):
    rng = random.Random(seed)
    return [(f"n{rng.randrange(nodes)}", f"n{rng.randrange(nodes + 10)}", float(rng.randrange(4))) for _ in range(edges)]


def outcome(results):
    return [(sorted(map(tuple, r.ranks.collect())), sorted(map(tuple, r.history.collect())), r.converged) for r in results]


@pytest.mark.parametrize("hot_degree", [None, 12])
def test_packed_steps_have_the_bits_of_steps_on_rows(spark, make_edges, monkeypatch, hot_degree):
    """Several parts, rows and slices; repeated pairs, sinks, weightless and hot sources."""
    monkeypatch.setattr(packed, "_PART_EDGES", 150)
    monkeypatch.setattr(packed, "_ROW_EDGES", 20)
    edges = make_edges(some_edges(1)).cache()
    stored = spark.createDataFrame([("n0", 0.5), ("n3", 0.5)], "node STRING, rank DOUBLE")
    specs = [
        rank.RankSpec(epsilon=0.0, max_iter=5),
        rank.RankSpec(weighted=True, epsilon=1e-2, personalization={"n3": 1.0, "n5": 2.0}),
        rank.RankSpec(weighted=True, epsilon=1e-2, dangling="drop", precision=8, rounding="even"),
        rank.RankSpec(init="one", dangling="drop", unit_digits=8, max_iter=4),
        rank.RankSpec(init=stored, max_iter=3),
    ]
    arrays = outcome(rank.run_many(edges, specs, partitions=3, hot_degree=hot_degree))
    monkeypatch.setattr(rank, "can_pack", lambda spec: False)
    assert arrays == outcome(rank.run_many(edges, specs, partitions=3, hot_degree=hot_degree))


def test_keys_place_one_part_in_a_partition(spark):
    for parts in (1, 7, 211):
        keys = packed.part_keys(parts)
        rows = spark.createDataFrame([(k,) for k in keys], "k INT").selectExpr("k", f"pmod(hash(k), {parts}) AS part").collect()
        assert [{r["k"]: r["part"] for r in rows}[k] for k in keys] == list(range(parts))


def test_even_rounding_of_arrays():
    rng = random.Random(4)
    values = [round(rng.random(), d) + 5 * 10.0 ** -(d + 1) for d in range(1, 9) for _ in range(60)] + [0.0, 2.5, 0.125]
    for digits in (0, 1, 2, 8):
        assert packed._nearest_even(np.array(values), digits).tolist() == [float(f"{v:.{digits}f}") for v in values]


@pytest.mark.parametrize("options", [{}, {"precision": 8}])
def test_shuffles_of_steps_do_not_pile_up(spark, ring, options):
    """their files used to stay until the driver collected its garbage; on arrays and on rows alike."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        names = files.mkString("\n").split("\n")
        return {name for name in names if "/shuffle_" in name}

    before = shuffled()
    result = rank.run(ring, epsilon=0.0, max_iter=8, partitions=3, **options)
    for _ in range(40):  # they are deleted in the background
        if len(shuffled() - before) <= 6:
            break
        time.sleep(0.25)
    assert len(shuffled() - before) <= 6
    assert result.iterations == 8


def test_guessed_size_of_a_state_does_not_grow(ring):
    """it had twice as many digits after every step, and planning read all of them."""
    batch = rank.prepare(ring, [rank.RankSpec()], partitions=3)
    steps = packed.PackedSteps(batch)
    steps.pack()
    with batch.settings():
        state = batch.start()
        held = batch.held_at_start(state)
        state, sizes = steps.start(state), []
        for _ in range(3):
            state, seen = steps.advance(state, held, [0])
            held = [batch.measured(seen, 0)[1]]
            sizes.append(state._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    assert len(set(sizes)) == 1
    steps.release()
    batch.layout.release()
