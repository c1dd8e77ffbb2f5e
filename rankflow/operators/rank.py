"""Damped random-walk ranking of the nodes of a directed graph.

One step, for every node ``u`` with restart share ``p(u)``::

    rank'(u) = (1-d)·p(u) + d·[ Σ_{v→u} w(v,u)/W(v)·rank(v) + p(u)·D ]

``D`` is the rank held by nodes without out-weight, or 0 when that mass is
dropped. Steps repeat until the summed absolute change is below ``epsilon``.

Several parameter sets run over one graph together: the state has one rank for each, a
step moves the inflow of all of them in one shuffle, and a set whose run has ended is
carried along unchanged.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rankflow.operators import fixed_point, graph, order
from rankflow.operators.fixed_point import double, rounded
from rankflow.operators.layout import Layout, build_layout, share_columns
from rankflow.operators.packed import PackedSteps, can_pack
from rankflow.session import ensure_checkpoint_dir, passing_shuffles, scoped_conf
from rankflow.sources.edges import drop_null_endpoints

DAMPING = 0.85
EPSILON = 1e-3
MAX_ITER = 100

HISTORY_SCHEMA = "iteration INT, delta DOUBLE, dangling_mass DOUBLE, total DOUBLE"


@dataclass
class RankResult:
    """Ranks of a finished run and how it got there."""

    ranks: DataFrame  # node, rank
    history: DataFrame  # one row per executed iteration
    num_nodes: int
    iterations: int
    converged: bool
    deltas: list[float]
    damping: float

    def top(self, n: int = 5) -> DataFrame:
        """The n best nodes, ties by node id."""
        return order.top_n(self.ranks, n)

    def total(self) -> float:
        """Sum of all ranks; 1 unless mass was dropped."""
        return self.ranks.agg(F.sum("rank")).first()[0]


@dataclass(frozen=True)
class RankSpec:
    """One parameter set.

    ``weighted`` uses column ``w``. ``personalization`` maps nodes to restart
    scores (a mapping, or a DataFrame ``node, score``). ``dangling`` is
    ``"teleport"`` (rank of dangling nodes restarts) or ``"drop"``. ``init`` is
    ``"uniform"`` (1/N), ``"one"``, or a DataFrame ``node, rank`` from which the
    run goes on. ``precision`` rounds the state in every step,
    ``share_precision`` the rank sent per unit of weight, both by the rule
    ``rounding``, ``"up"`` or ``"even"`` (see ``fixed_point``). ``unit_digits``
    lets the run stop by the change counted in whole units of that many
    decimals. ``epsilon=0`` runs exactly ``max_iter`` steps.
    """

    damping: float = DAMPING
    epsilon: float = EPSILON
    max_iter: int = MAX_ITER
    weighted: bool = False
    personalization: Mapping[str, float] | DataFrame | None = None
    dangling: str = "teleport"
    init: str | DataFrame = "uniform"
    precision: int | None = None
    share_precision: int | None = None
    unit_digits: int | None = None
    rounding: str = "up"

    def __post_init__(self) -> None:
        if not 0.0 <= self.damping < 1.0:
            raise ValueError(f"damping is {self.damping}; it must be at least 0 and under 1")
        if self.dangling not in ("teleport", "drop"):
            raise ValueError(f"dangling must be 'teleport' or 'drop', got {self.dangling!r}")
        if not self.resumed and self.init not in ("uniform", "one"):
            raise ValueError(f"init must be 'uniform', 'one' or a DataFrame, got {self.init!r}")
        if self.rounding not in ("up", "even"):
            raise ValueError(f"rounding must be 'up' or 'even', got {self.rounding!r}")

    @property
    def resumed(self) -> bool:
        """Whether the run goes on from stored ranks."""
        return isinstance(self.init, DataFrame)


# A step is built anew in every iteration, so it is written as SQL text: one
# call per operator instead of one per expression node.


@dataclass
class Batch:
    """A graph laid out for its parameter sets; state is ``id, rank0, rank1, …``."""

    layout: Layout
    specs: Sequence[RankSpec]
    restart: DataFrame | None  # id, p0, p1, … of the personalized sets, by id, sorted
    exact_sums: bool
    bits: int = 60  # of the first limb of exact sums, set by ``held_at_start``

    @property
    def spark(self) -> SparkSession:
        return self.layout.names.sparkSession

    @property
    def everyone(self) -> list[int]:
        return list(range(len(self.specs)))

    @contextmanager
    def settings(self) -> Iterator[None]:
        """Settings under which a step keeps the layout's partitioning.

        The layout already fixes partition counts and handles hot keys. A static
        plan keeps the partitioning and sort order of checkpointed state, and merge
        joins use both; hot sources are still broadcast on request.
        """
        fixed = {
            "spark.sql.adaptive.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": str(self.layout.partitions),
        }
        with scoped_conf(self.spark, fixed):
            yield

    def _start_value(self, spec: RankSpec) -> float:
        start = 1.0 if spec.init == "one" else 1.0 / self.layout.facts.nodes
        return start if spec.precision is None else round(start, spec.precision)

    def start(self) -> DataFrame:
        """The state before the first step.

        Stored ranks may repeat a node (slices of a hub carry the same rank); a
        node without a rank starts at 0, an unknown node is left out.
        """
        state, ranks = self.layout.names, []
        for k, spec in enumerate(self.specs):
            if not spec.resumed:
                ranks.append(f"{double(self._start_value(spec))} AS rank{k}")
                continue
            own = state.schema["node"].dataType
            known = spec.init.select(F.col("node").cast(own), F.col("rank").cast("double"))
            known = known.groupBy("node").agg(F.max("rank").alias(f"stored{k}"))
            state = state.join(known, "node", "left")
            stored = rounded(f"coalesce(stored{k}, 0D)", spec.precision, spec.rounding)
            ranks.append(f"{stored} AS rank{k}")
        laid = state.selectExpr("id", *ranks)
        if any(spec.resumed for spec in self.specs):  # joined by name, so back to its place
            laid = laid.repartition(self.layout.partitions, "id").sortWithinPartitions("id").checkpoint()
        return laid

    def held_at_start(self, state: DataFrame) -> list[float]:
        """Rank of dangling nodes before the first step. Sets the scale of exact sums."""
        facts, held, most = self.layout.facts, [], 1.0
        for k, spec in enumerate(self.specs):
            dangling = facts.nodes - self.layout.givers[spec.weighted]
            if spec.resumed:
                sink = self._is_dangling(k)
                seen = state.selectExpr(f"sum(rank{k}) AS total", f"sum(IF({sink}, rank{k}, 0D)) AS mass").first()
                held.append(seen["mass"])
                most = max(most, seen["total"])
            else:
                held.append(dangling * self._start_value(spec))
                most = max(most, facts.nodes * self._start_value(spec))
        self.bits = fixed_point.first_bits(most)
        return held

    def _is_dangling(self, k: int) -> str:
        return f"id >= {self.layout.givers[self.specs[k].weighted]}"

    def _flow(self, k: int) -> str:
        """Rank that goes over an edge."""
        spec = self.specs[k]
        split = spec.weighted in self.layout.split
        names = share_columns(spec.weighted, split)
        if not split:
            return f"{names[0]} * rank{k}"
        part, total = names
        share = rounded(f"rank{k} / {total}", spec.share_precision, spec.rounding)
        return f"IF({total} > 0D, {part} * {share}, 0D)"

    def inflow(self, state: DataFrame, active: Sequence[int] | None = None) -> DataFrame:
        """``id, inflow0, …``: rank arriving over edges, nodes without any left out."""
        active = self.everyone if active is None else active
        reach = max(self.layout.givers[self.specs[k].weighted] for k in active)
        shares = state.where(f"id < {reach}").selectExpr("id AS src", *[f"rank{k}" for k in active])
        flow = ("dst AS id", *[f"{self._flow(k)} AS flow{k}" for k in active])
        flows = self.layout.spread.join(shares, "src").selectExpr(*flow)
        if self.layout.hot is not None:
            few = F.broadcast(shares.where(f"src < {self.layout.hot_ids}"))
            flows = flows.unionAll(self.layout.hot.join(few, "src").selectExpr(*flow))
        if not self.exact_sums:
            return flows.groupBy("id").agg(*[F.expr(f"sum(flow{k}) AS inflow{k}") for k in active])
        cuts = [fixed_point.limbs(f"flow{k}", self.bits) for k in active]
        halves = [f"{text} AS {name}{k}" for k, pair in zip(active, cuts, strict=True) for name, text in zip("hl", pair, strict=True)]
        sums = [F.expr(f"sum({name}{k}) AS {name}{k}") for k in active for name in "hl"]
        summed = flows.selectExpr("id", *halves).groupBy("id").agg(*sums)
        return summed.selectExpr("id", *[f"{fixed_point.joined(f'h{k}', f'l{k}', self.bits)} AS inflow{k}" for k in active])

    def step(self, state: DataFrame, held: Sequence[float], active: Sequence[int] | None = None) -> DataFrame:
        """One iteration of the active sets: state in; state and ``previous0, …`` out.

        The previous rank is on the same row, so the change needs no extra join.
        """
        active = self.everyone if active is None else active
        joined = state.join(self.inflow(state, active), "id", "left")
        if self.restart is not None:
            joined = joined.join(self.restart, "id", "left")
        columns = []
        for k, spec in enumerate(self.specs):
            if k not in active:
                columns.append(f"rank{k}")
                continue
            mass = held[k] if spec.dangling == "teleport" else 0.0
            share = double(1.0 / self.layout.facts.nodes) if spec.personalization is None else f"coalesce(p{k}, 0D)"
            restarted = f"{double(1.0 - spec.damping + spec.damping * mass)} * {share}"
            rank = f"{restarted} + {double(spec.damping)} * coalesce(inflow{k}, 0D)"
            columns.append(f"{rounded(rank, spec.precision, spec.rounding)} AS rank{k}")
            columns.append(f"rank{k} AS previous{k}")
        return joined.selectExpr("id", *columns)

    def metrics(self, k: int) -> dict[str, str]:
        """SQL texts of what is measured about a step of a set."""
        spec = self.specs[k]
        change = f"abs(rank{k} - previous{k})"
        measured = {"delta": change, "mass": f"IF({self._is_dangling(k)}, rank{k}, 0D)", "total": f"rank{k}"}
        found = {}
        if spec.unit_digits is not None:  # whole units, halves rounded up
            scale = double(10.0**spec.unit_digits)
            found[f"delta{k}"] = f"sum(CAST(floor({change} * {scale} + 0.5D) AS BIGINT)) / {scale}"
            del measured["delta"]
        for name, text in measured.items():
            if self.exact_sums:
                found |= {f"{name}{k}{part}": f"sum({x})" for part, x in zip("hl", fixed_point.limbs(text, self.bits), strict=True)}
            else:
                found[f"{name}{k}"] = f"sum({text})"
        return found

    def _value(self, seen: dict, name: str) -> float:
        if name in seen:
            return float(seen[name] or 0.0)
        return fixed_point.value(seen[f"{name}h"], seen[f"{name}l"], self.bits)

    def measured(self, seen: dict, k: int) -> tuple[float, float, float]:
        """Change, rank held by dangling nodes, total rank, from the values of ``metrics``."""
        return tuple(self._value(seen, f"{name}{k}") for name in ("delta", "mass", "total"))

    def settle(self, stepped: DataFrame, active: Sequence[int] | None = None) -> tuple[DataFrame, dict]:
        """Checkpoint a state without its previous ranks, and measure the step in the same job.

        The metrics sit in the last stage of the job, where Spark counts every
        partition exactly once even if tasks are retried.
        """
        active = self.everyone if active is None else active
        seen = Observation()
        metrics = [F.expr(f"{text} AS {name}") for k in active for name, text in self.metrics(k).items()]
        kept = stepped.observe(seen, *metrics).select("id", *[f"rank{k}" for k in self.everyone])
        return kept.checkpoint(), seen.get

    def named(self, state: DataFrame) -> DataFrame:
        """The state with ``node`` in place of its number."""
        return self.layout.names.join(state, "id").drop("id")


def discard(state: DataFrame) -> None:
    """Delete the files of a checkpointed state that nothing reads any more."""
    spark = state.sparkSession
    written = state._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if written.isDefined():
        folder = spark._jvm.org.apache.hadoop.fs.Path(written.get())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _restart_scores(
    spark: SparkSession, personalization: Mapping[str, float] | DataFrame
) -> DataFrame:
    """Non-negative scores, ``node, score``; repeated nodes add up."""
    if isinstance(personalization, DataFrame):
        scores = personalization.select(F.col("node").cast("string"), F.col("score").cast("double"))
    else:
        rows = [(str(node), float(score)) for node, score in personalization.items()]
        scores = spark.createDataFrame(rows, "node STRING, score DOUBLE")
    return scores.groupBy("node").agg(F.greatest(F.lit(0.0), F.sum("score")).alias("score"))


def _restart_table(layout: Layout, specs: Sequence[RankSpec]) -> DataFrame | None:
    """``id, p0, p1, …``: restart shares of all personalized sets, laid out like the state."""
    spark, rows = layout.names.sparkSession, None
    chosen = [k for k, spec in enumerate(specs) if spec.personalization is not None]
    for k in chosen:
        scores = _restart_scores(spark, specs[k].personalization).where("score > 0")
        scores = scores.withColumn("node", F.col("node").cast(layout.names.schema["node"].dataType))
        scores = scores.withColumn("spec", F.lit(k))
        rows = scores if rows is None else rows.unionByName(scores)
    if rows is None:
        return None
    known = rows.join(layout.names, "node")
    columns = [F.sum(F.when(F.col("spec") == k, F.col("score"))).alias(f"p{k}") for k in chosen]
    table = known.groupBy("id").agg(*columns).checkpoint()
    sums = table.agg(*[F.sum(f"p{k}").alias(f"p{k}") for k in chosen]).first()
    if any(not sums[f"p{k}"] for k in chosen):
        raise ValueError("no node has a positive restart score")
    shares = table.selectExpr("id", *[f"p{k} / {double(sums[f'p{k}'])} AS p{k}" for k in chosen])
    return shares.repartition(layout.partitions, "id").sortWithinPartitions("id").checkpoint()


def prepare(
    edges: DataFrame,
    specs: Sequence[RankSpec],
    nodes: DataFrame | None = None,
    partitions: int | None = None,
    hot_degree: int | None = None,
    exact_sums: bool = True,
) -> Batch:
    """Check the input and lay it out for all parameter sets."""
    ensure_checkpoint_dir(edges.sparkSession)
    kinds = {spec.weighted for spec in specs}
    flat = graph.with_weight(drop_null_endpoints(edges), True in kinds)
    if not edges.is_cached:  # the node table and the layout read it, hot sources once more
        flat = flat.persist(StorageLevel.MEMORY_AND_DISK)
    # A meaningless weight turns its source's out-weight into NaN.
    marked = F.when(graph.is_bad_weight(F.col("w")), F.lit(float("nan"))).otherwise(F.col("w"))
    split = frozenset(spec.weighted for spec in specs if spec.share_precision is not None)
    layout = None
    try:
        layout = build_layout(flat.withColumn("w", marked), kinds, split, nodes, partitions, hot_degree)
        layout.source = flat if flat.is_cached and not edges.is_cached else None
        if not layout.facts.nodes:
            raise ValueError("there are no nodes to rank")
        if not math.isfinite(layout.facts.max_weight):
            raise ValueError("edge weights must be finite and not negative")
        return Batch(layout, specs, _restart_table(layout, specs), exact_sums)
    except BaseException:
        if layout is not None:
            layout.release()
        if not edges.is_cached:
            flat.unpersist()
        raise


def run_many(
    edges: DataFrame,
    specs: Sequence[RankSpec],
    nodes: DataFrame | None = None,
    partitions: int | None = None,
    hot_degree: int | None = None,
    exact_sums: bool = True,
) -> list[RankResult]:
    """Rank the nodes of a graph under several parameter sets at once.

    All sets share the layout of the graph and one shuffle a step. Each set has
    its own stop rule and keeps the ranks at which it stopped. Every result equals
    that of a run of its own.

    The source of the edges is evaluated once and held until the first step is
    done, unless the caller holds it already. At most two states are on disk at
    any time. One call per session at a time: a run sets its session's partition
    count and adaptive execution, and puts them back.

    ``nodes`` (column ``node``) adds isolated nodes. With ``exact_sums`` inflow and
    metrics don't depend on partitions or the order of rows, to the last bit; without,
    a step shuffles 8 bytes less a row and set. Totals of weights are sums of
    doubles as the edges come.
    """
    spark = edges.sparkSession
    batch = prepare(edges, specs, nodes, partitions, hot_degree, exact_sums)
    history: list[list[tuple[int, float, float, float]]] = [[] for _ in specs]
    converged = [False] * len(specs)
    packed: PackedSteps | None = None
    try:
        active = [k for k, spec in enumerate(specs) if spec.max_iter > 0]
        if active and exact_sums and all(map(can_pack, specs)):
            packed = PackedSteps(batch)
            packed.pack()
        with batch.settings():
            state = batch.start()
            held = batch.held_at_start(state)
            stored = packed is not None or any(spec.resumed for spec in specs)
            if packed is not None:
                state = packed.start(state)
            iteration = 0
            while active:
                iteration += 1
                before = state
                if packed is None:
                    with passing_shuffles(spark):
                        state, seen = batch.settle(batch.step(before, held, active), active)
                else:
                    state, seen = packed.advance(before, held, active)
                if iteration == 1:
                    batch.layout.release_source()
                if iteration > 1 or stored:
                    discard(before)
                for k in active:
                    delta, held[k], total = batch.measured(seen, k)
                    history[k].append((iteration, delta, held[k], total))
                    converged[k] = delta < specs[k].epsilon
                active = [k for k in active if not converged[k] and iteration < specs[k].max_iter]
    finally:
        batch.layout.release()
        if packed is not None:
            packed.release()
    if packed is not None:
        state = packed.rows(state)
    return [
        RankResult(
            ranks=batch.named(state.selectExpr("id", f"rank{k} AS rank")),
            history=spark.createDataFrame(history[k], HISTORY_SCHEMA),
            num_nodes=batch.layout.facts.nodes,
            iterations=len(history[k]),
            converged=converged[k],
            deltas=[row[1] for row in history[k]],
            damping=spec.damping,
        )
        for k, spec in enumerate(specs)
    ]


def run(
    edges: DataFrame,
    *,
    nodes: DataFrame | None = None,
    partitions: int | None = None,
    hot_degree: int | None = None,
    exact_sums: bool = True,
    **options,
) -> RankResult:
    """Rank the nodes of a graph; ``options`` are the fields of ``RankSpec``.

    See ``run_many`` for the other arguments.
    """
    return run_many(edges, [RankSpec(**options)], nodes, partitions, hot_degree, exact_sums)[0]
