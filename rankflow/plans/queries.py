"""Every operator as a named query on the star-schema tables, with SQL twins.

Ranks and other sums of doubles are rounded on both sides, because engines add
in different orders. Runs that are compared use a fixed number of steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions.text import score_rows
from rankflow.operators import chain, compare, fixed_point, graph, measure, order, rank, synth
from rankflow.plans import lenses, oracles
from rankflow.plans.variants import VARIANTS
from rankflow.session import shared_path
from rankflow.sources import edges as edge_source
from rankflow.sources import ranks as rank_source
from rankflow.sources import runs as run_source
from rankflow.sources import state as state_source

# Queries about a fixed number of steps.
STEPS = 10
DIGITS = 10
# All other runs go on until the change is under STOP; BUDGET is out of reach at
# damping 0.85, where it takes log(2 / STOP) / log(1 / 0.85) = 47 steps at most.
STOP = 1e-3
BUDGET = 50
# The curve and the list of the best go on to a fine threshold, the curve for CURVE steps at most.
FINE, CURVE, LIMIT = 1e-9, 50, 200


@dataclass(frozen=True)
class Query:
    """A query and, where SQL can express it, the SQL that must agree."""

    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[name] = Query(build, sql)
        return build

    return add


def rounded(name: str, digits: int = DIGITS) -> Column:
    return F.round(name, digits).alias(name)


@contextmanager
def held(edges: DataFrame) -> Iterator[DataFrame]:
    """Keep an aggregated lens while several runs read it."""
    edges = edges.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield edges
    finally:
        edges.unpersist()


def fixed_run(edges: DataFrame, steps: int = STEPS, **options) -> rank.RankResult:
    """A run of exactly ``steps`` steps."""
    return rank.run(edges, epsilon=0.0, max_iter=steps, **options)


def finished(edges: DataFrame, **options) -> rank.RankResult:
    """A run to its end."""
    return rank.run(edges, epsilon=STOP, max_iter=BUDGET, **options)


def trade_run(spark: SparkSession, folder: str, steps: int = STEPS, **options) -> rank.RankResult:
    """A run of exactly ``steps`` steps on the trade graph."""
    return fixed_run(lenses.trade(spark, folder), steps, **options)


def rounded_ranks(result: rank.RankResult, digits: int = DIGITS) -> DataFrame:
    return result.ranks.select("node", rounded("rank", digits))


def _ranks_sql(steps: int = STEPS, digits: int = DIGITS, **options) -> str:
    return oracles.query(
        oracles.rank_ctes(steps=steps, **options), f"SELECT node, round(rank, {digits}) AS rank FROM r{steps}"
    )


# --- edge text -----------------------------------------------------------------

_SPACE = "' ' || chr(9)"
_FIELDS = f"""{lenses.EDGE_LINES_SQL},
fields AS (SELECT string_split(line, chr(9)) AS f FROM (
  SELECT trim(value, {_SPACE}) AS line FROM edge_lines) WHERE line <> '' {{comment}})"""


def _parse_sql(where: str, skip_comments: bool, trim_fields: bool, weight: str = "") -> str:
    comment = "AND NOT starts_with(line, '#')" if skip_comments else ""
    trim = (lambda i: f"trim(f[{i}], {_SPACE})") if trim_fields else (lambda i: f"f[{i}]")
    return oracles.query(
        _FIELDS.format(comment=comment),
        f"SELECT {trim(1)} AS src, {trim(2)} AS dst{weight} FROM fields WHERE {where}",
    )


@register("parse_edges_core", _parse_sql("len(f) >= 2", True, True))
def parse_edges_core(spark, folder):
    return edge_source.parse_edges(lenses.edge_lines(spark, folder), "core")


@register(
    "parse_edges_weighted",
    _parse_sql(
        "len(f) >= 3 AND TRY_CAST(f[3] AS DOUBLE) IS NOT NULL",
        True,
        True,
        ", CAST(f[3] AS DOUBLE) AS w",
    ),
)
def parse_edges_weighted(spark, folder):
    lines = lenses.edge_lines(spark, folder)
    return edge_source.parse_edges(lines, "core", weighted=True, on_bad_weight="skip")


@register("parse_edges_first2", _parse_sql("len(f) >= 2", False, False))
def parse_edges_first2(spark, folder):
    return edge_source.parse_edges(lenses.edge_lines(spark, folder), "first2")


@register("parse_edges_exact2", _parse_sql("len(f) = 2", False, False))
def parse_edges_exact2(spark, folder):
    return edge_source.parse_edges(lenses.edge_lines(spark, folder), "exact2")


@register("parse_edges_exact2_nocomment", _parse_sql("len(f) = 2", True, True))
def parse_edges_exact2_nocomment(spark, folder):
    return edge_source.parse_edges(lenses.edge_lines(spark, folder), "exact2_nocomment")


# --- graph construction --------------------------------------------------------


@register(
    "node_set",
    oracles.query(lenses.SUPPLY_SQL, "SELECT src AS node FROM supply UNION SELECT dst FROM supply"),
)
def node_set(spark, folder):
    return graph.node_set(lenses.supply(spark, folder))


@register(
    "node_count",
    oracles.query(
        lenses.SUPPLY_SQL,
        """SELECT count(*) AS nodes FROM (SELECT src FROM supply UNION SELECT dst FROM supply)""",
    ),
)
def node_count(spark, folder):
    return graph.node_set(lenses.supply(spark, folder)).agg(F.count("node").alias("nodes"))


@register(
    "out_degree",
    oracles.query(
        lenses.SUPPLY_SQL, "SELECT src AS node, count(dst) AS out_degree FROM supply GROUP BY src"
    ),
)
def out_degree(spark, folder):
    return graph.out_degree(lenses.supply(spark, folder))


@register(
    "out_weight",
    oracles.query(
        oracles.graph_ctes("trade"), "SELECT node, round(out_weight, 2) AS out_weight FROM nodes"
    ),
)
def out_weight(spark, folder):
    weights = graph.out_weight(lenses.trade(spark, folder))
    return weights.select("node", rounded("out_weight", 2))


@register(
    "transition_probs",
    oracles.query(oracles.graph_ctes("trade"), f"SELECT src, dst, round(prob, {DIGITS}) AS prob FROM tr"),
)
def transition_probs(spark, folder):
    moves = graph.transition_probabilities(lenses.trade(spark, folder))
    return moves.select("src", "dst", rounded("prob"))


@register(
    "dangling_nodes",
    oracles.query(oracles.graph_ctes("trade"), "SELECT node FROM nodes WHERE out_weight = 0"),
)
def dangling_nodes(spark, folder):
    return graph.dangling_nodes(graph.node_table(lenses.trade(spark, folder), weighted=True))


@register(
    "nodes_without_out_edges",
    oracles.query(lenses.TRADE_SQL, "SELECT dst AS node FROM trade EXCEPT SELECT src FROM trade"),
)
def nodes_without_out_edges(spark, folder):
    return graph.nodes_without_out_edges(lenses.trade(spark, folder))


_LISTS_SQL = """lists AS (
  SELECT node, coalesce(string_agg(dst, ',' ORDER BY dst), '') AS neighbors
  FROM nodes LEFT JOIN e ON node = src GROUP BY node)"""


@register(
    "adjacency_all_nodes",
    oracles.query(
        oracles.graph_ctes("trade_unweighted") + "," + _LISTS_SQL,
        "SELECT node, 0 AS block, neighbors FROM lists",
    ),
)
def adjacency_all_nodes(spark, folder):
    lists = graph.adjacency(lenses.trade(spark, folder))
    return lists.select("node", "block", F.array_join("neighbors", ",").alias("neighbors"))


@register(
    "weighted_adjacency",
    oracles.query(
        lenses.TRADE_SQL,
        """SELECT src AS node, 0 AS block,
  string_agg(dst || ':' || CAST(CAST(w AS DECIMAL(18,2)) AS VARCHAR), ',' ORDER BY dst) AS links
  FROM trade GROUP BY src""",
    ),
)
def weighted_adjacency(spark, folder):
    lists = graph.weighted_adjacency(lenses.trade(spark, folder))
    shown = F.transform(
        "neighbors",
        lambda link: F.concat(link["dst"], F.lit(":"), link["w"].cast("decimal(18,2)").cast("string")),
    )
    return lists.select("node", "block", F.array_join(shown, ",").alias("links"))


@register(
    "graph_summary",
    oracles.query(
        oracles.graph_ctes("trade"),
        """SELECT count(*) AS nodes, sum(out_degree)::BIGINT AS edges,
  count(*) FILTER (WHERE out_weight = 0) AS dangling FROM nodes""",
    ),
)
def graph_summary(spark, folder):
    return graph.summary(graph.node_table(lenses.trade(spark, folder), weighted=True))


# --- node state ----------------------------------------------------------------


def _state(spark: SparkSession, folder: str) -> DataFrame:
    ranks = trade_run(spark, folder, 1).ranks
    return graph.adjacency(lenses.trade(spark, folder), ranks=ranks)


def _shown_state(state: DataFrame, digits: int) -> DataFrame:
    return state.select(
        "node",
        rounded("rank", digits),
        F.size("neighbors").alias("out_degree"),
        F.array_join("neighbors", ",").alias("neighbors"),
    )


def _state_sql(digits: int) -> str:
    ctes = oracles.rank_ctes("trade_unweighted", 1) + "," + _LISTS_SQL
    return oracles.query(
        ctes,
        f"""SELECT node, round(rank, {digits}) AS rank, out_degree::INTEGER AS out_degree, neighbors
  FROM lists JOIN r1 USING (node) JOIN nodes USING (node)""",
    )


@register("state_roundtrip_pipe", _state_sql(8))
def state_roundtrip_pipe(spark, folder):
    lines = state_source.format_pipe(_state(spark, folder))
    return _shown_state(state_source.parse_pipe(lines), 8)


@register("state_roundtrip_tsv", _state_sql(DIGITS))
def state_roundtrip_tsv(spark, folder):
    lines = state_source.format_tsv(_state(spark, folder))
    return _shown_state(state_source.parse_tsv(lines), DIGITS)


@register("state_roundtrip_json", _state_sql(DIGITS))
def state_roundtrip_json(spark, folder):
    lines = state_source.format_json(_state(spark, folder))
    return _shown_state(state_source.parse_json(lines), DIGITS)


@register(
    "rank_from_state",
    oracles.query(
        oracles.rank_ctes("trade_unweighted", 1), "SELECT node, round(rank, 8) AS rank FROM r1"
    ),
)
def rank_from_state(spark, folder):
    lines = state_source.format_pipe(_state(spark, folder))
    return state_source.parse_pipe_ranks(lines)


# --- single steps ---------------------------------------------------------------


def _one_step(edges: DataFrame, redistribute: bool = True) -> tuple[rank.Batch, DataFrame]:
    """A weighted run and its stored state after one step, previous ranks included."""
    spec = rank.RankSpec(weighted=True, dangling="teleport" if redistribute else "drop")
    batch = rank.prepare(edges, [spec])
    with batch.settings():
        start = batch.start()
        stepped = batch.step(start, batch.held_at_start(start)).checkpoint()
    batch.layout.release()
    return batch, stepped


_ONE_STEP_SQL = oracles.rank_ctes("trade", 1)


@register(
    "contributions_step",
    oracles.query(
        oracles.rank_ctes("trade", 0),
        f"""SELECT dst AS node, round(sum(prob * rank), {DIGITS}) AS inflow
  FROM tr JOIN r0 ON src = node GROUP BY dst""",
    ),
)
def contributions_step(spark, folder):
    batch = rank.prepare(lenses.trade(spark, folder), [rank.RankSpec(weighted=True)])
    inflow = batch.inflow(batch.start()).checkpoint()
    batch.layout.release()
    return batch.named(inflow).select("node", F.round("inflow0", DIGITS).alias("inflow"))


def _stepped_ranks(batch: rank.Batch, stepped: DataFrame, column: str = "rank0") -> DataFrame:
    return batch.named(stepped).select("node", F.col(column).alias("rank"))


@register("rank_one_step", _ranks_sql(1, graph="trade"))
def rank_one_step(spark, folder):
    return _stepped_ranks(*_one_step(lenses.trade(spark, folder))).select("node", rounded("rank"))


@register("rank_one_step_drop", _ranks_sql(1, graph="trade", redistribute=False))
def rank_one_step_drop(spark, folder):
    return _stepped_ranks(*_one_step(lenses.trade(spark, folder), False)).select("node", rounded("rank"))


@register(
    "dangling_mass_step",
    oracles.query(_ONE_STEP_SQL, f"SELECT round(mass, {DIGITS}) AS dangling_mass FROM dm1"),
)
def dangling_mass_step(spark, folder):
    batch, stepped = _one_step(lenses.trade(spark, folder))
    limbs = stepped.selectExpr(*[f"{text} AS {name}" for name, text in batch.metrics(0).items()])
    mass = limbs.selectExpr(f"{fixed_point.joined('mass0h', 'mass0l', batch.bits)} AS dangling_mass")
    return mass.select(rounded("dangling_mass"))


_BOTH = "FROM r1 JOIN r0 USING (node)"


@register(
    "l1_delta_step",
    oracles.query(_ONE_STEP_SQL, f"SELECT round(sum(abs(r1.rank - r0.rank)), {DIGITS}) AS delta {_BOTH}"),
)
def l1_delta_step(spark, folder):
    step = _one_step(lenses.trade(spark, folder))
    return compare.l1_delta(_stepped_ranks(*step, "previous0"), _stepped_ranks(*step)).select(rounded("delta"))


@register(
    "delta_counter",
    oracles.query(
        _ONE_STEP_SQL,
        f"""SELECT sum(floor(abs(r1.rank - r0.rank) * 1e8 + 0.5e0)::BIGINT)::BIGINT AS delta_units,
  sum(floor(abs(r1.rank - r0.rank) * 1e8 + 0.5e0)::BIGINT)::BIGINT / 1e8 AS delta {_BOTH}""",
    ),
)
def delta_counter(spark, folder):
    step = _one_step(lenses.trade(spark, folder))
    return compare.delta_counter(_stepped_ranks(*step, "previous0"), _stepped_ranks(*step))


# --- ranking runs ----------------------------------------------------------------


@register("rank_standard", _ranks_sql(graph="supply"))
def rank_standard(spark, folder):
    return rounded_ranks(fixed_run(lenses.supply(spark, folder)))


@register("rank_weighted", _ranks_sql(graph="trade"))
def rank_weighted(spark, folder):
    return rounded_ranks(trade_run(spark, folder, weighted=True))


@register(
    "rank_personalized",
    _ranks_sql(graph="supply", restart="SELECT 'c' || c_custkey AS node, c_acctbal AS score FROM customer"),
)
def rank_personalized(spark, folder):
    customers = lenses.table(spark, folder, "customer")
    scores = customers.select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("node"),
        F.col("c_acctbal").alias("score"),
    )
    return rounded_ranks(fixed_run(lenses.supply(spark, folder), personalization=scores))


@register(
    "rank_weighted_personalized",
    _ranks_sql(
        graph="nation_trade",
        restart="""SELECT n_name AS node, sum(s_acctbal) AS score
  FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""",
    ),
)
def rank_weighted_personalized(spark, folder):
    suppliers = lenses.table(spark, folder, "supplier").groupBy("s_nationkey").agg(
        F.sum("s_acctbal").alias("score")
    )
    nations = lenses.table(spark, folder, "nation")
    scores = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("node"), "score"
    )
    edges = lenses.nation_trade(spark, folder)
    return rounded_ranks(fixed_run(edges, weighted=True, personalization=scores))


@register(
    "rank_scores_text",
    _ranks_sql(graph="trade", restart="SELECT 'c' || c_custkey AS node, c_acctbal AS score FROM customer"),
)
def rank_scores_text(spark, folder):
    """Restart scores from lines of text; the first line of a node is replaced by its last."""
    customers = lenses.table(spark, folder, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("=")).alias("node"), F.col("c_acctbal").cast("string").alias("score")
    )
    lines = customers.select(F.explode(F.array(F.concat("node", F.lit("-1")), F.concat(F.lit(" "), "node", "score"))).alias("value"))
    path = shared_path(spark, "scores")
    lines.write.text(path)
    scores = score_rows(spark.read.text(path))
    return rounded_ranks(trade_run(spark, folder, weighted=True, personalization=scores))


_CYCLIC_SQL = (
    lenses.TRADE_SQL
    + """,
cyclic AS (
  SELECT src, dst, ((row_number() OVER (ORDER BY src, dst) - 1) % 5 + 1)::DOUBLE AS w FROM trade),"""
)


@register(
    "rank_cyclic_weights",
    oracles.query(
        _CYCLIC_SQL + oracles.rank_ctes("cyclic", STEPS), f"SELECT node, round(rank, {DIGITS}) AS rank FROM r{STEPS}"
    ),
)
def rank_cyclic_weights(spark, folder):
    """Weights 1 to 5 by the place of an edge."""
    return rounded_ranks(fixed_run(graph.cyclic_weights(lenses.trade(spark, folder)), weighted=True))


@register("rank_node_universe", _ranks_sql(graph="trade", universe=True))
def rank_node_universe(spark, folder):
    universe = lenses.customer_universe(spark, folder)
    return rounded_ranks(trade_run(spark, folder, weighted=True, nodes=universe))


@register("rank_drop_dangling", _ranks_sql(graph="trade_unweighted", redistribute=False))
def rank_drop_dangling(spark, folder):
    return rounded_ranks(trade_run(spark, folder, dangling="drop"))


@register("rank_init_one", _ranks_sql(graph="supply", redistribute=False, init="1e0"))
def rank_init_one(spark, folder):
    return rounded_ranks(fixed_run(lenses.supply(spark, folder), dangling="drop", init="one"))


# State of 8 decimals leaves nothing to round off: the two sides must agree in every digit.


@register(
    "rank_rounded_state",
    _ranks_sql(digits=8, graph="trade", redistribute=False, precision=8, rounding="even"),
)
def rank_rounded_state(spark, folder):
    """State through text of 8 decimals, true halves to the even side."""
    result = trade_run(spark, folder, weighted=True, dangling="drop", precision=8, rounding="even")
    return rounded_ranks(result, 8)


@register(
    "rank_rounded_share",
    _ranks_sql(
        digits=8, graph="trade_unweighted", redistribute=False, init="1e0", precision=8, share_precision=10
    ),
)
def rank_rounded_share(spark, folder):
    """Shares of 10 and state of 8 decimals, halves of the shortest decimal text up."""
    options = VARIANTS["unit_start_text"] | {"max_iter": STEPS, "epsilon": 0.0}
    return rounded_ranks(rank.run(lenses.trade(spark, folder), **options), 8)


@register("rank_copurchase", _ranks_sql(graph="copurchase"))
def rank_copurchase(spark, folder):
    """A weighted graph with long cycles, parallel edges and self-loops."""
    return rounded_ranks(fixed_run(lenses.copurchase(spark, folder), weighted=True))


# --- convergence -----------------------------------------------------------------

_CONVERGED_SQL = oracles.finished_ctes("trade", BUDGET, STOP)


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return finished(lenses.trade(spark, folder), weighted=True).history


@register(
    "rank_history",
    oracles.query(
        _CONVERGED_SQL,
        f"""SELECT iteration, round(delta, {DIGITS}) AS delta, round(dangling_mass, {DIGITS}) AS dangling_mass,
  round(total, {DIGITS}) AS total FROM history JOIN stopped ON iteration <= k""",
    ),
)
def rank_history(spark, folder):
    return _history(spark, folder).select(
        "iteration", rounded("delta"), rounded("dangling_mass"), rounded("total")
    )


@register(
    "history_monotone",
    oracles.query(
        _CONVERGED_SQL,
        f"""SELECT iteration, round(delta, {DIGITS}) AS delta, round(before, {DIGITS}) AS previous_delta,
  before IS NULL OR delta <= before + 1e-12 AS falling
  FROM (SELECT *, lag(delta) OVER (ORDER BY iteration) AS before FROM history JOIN stopped ON iteration <= k)""",
    ),
)
def history_monotone(spark, folder):
    steps = compare.history_steps(_history(spark, folder))
    return steps.select("iteration", rounded("delta"), rounded("previous_delta"), "falling")


@register(
    "iterations_to_converge",
    oracles.query(_CONVERGED_SQL, "SELECT k AS iterations, converged FROM stopped"),
)
def iterations_to_converge(spark, folder):
    return compare.iterations_to_converge(_history(spark, folder), STOP)


@register(
    "rank_until_converged",
    oracles.query(
        _CONVERGED_SQL,
        f"SELECT node, round(rank, {DIGITS}) AS rank, converged FROM done, stopped",
    ),
)
def rank_until_converged(spark, folder):
    result = finished(lenses.trade(spark, folder), weighted=True)
    return rounded_ranks(result).withColumn("converged", F.lit(result.converged))


_UNITS = "sum(floor(abs(a.rank - b.rank) * 1e8 + 0.5e0)::BIGINT)::BIGINT / 1e8"


@register(
    "rank_counter_stop",
    oracles.query(
        oracles.rank_ctes("copurchase", BUDGET) + "," + oracles.history_cte(BUDGET, change=_UNITS),
        f"""SELECT iteration, round(delta, {DIGITS}) AS delta FROM history WHERE iteration <= (
  SELECT min(iteration) FROM history WHERE delta < {STOP!r})""",
    ),
)
def rank_counter_stop(spark, folder):
    result = finished(lenses.copurchase(spark, folder), weighted=True, unit_digits=8)
    return result.history.select("iteration", rounded("delta"))


_LOW, _HIGH = 0.50, 0.95
_FAR = 150  # steps that are enough at damping 0.95


def _damping_sql(graph: str) -> str:
    low = oracles.finished_ctes(graph, BUDGET, STOP, "_low", damping=_LOW)
    high = oracles.finished_ctes(graph, _FAR, STOP, "_high", damping=_HIGH)
    return oracles.query(
        f"{low},\n{high}",
        f"""SELECT round(max(abs(a.rank - b.rank)), {DIGITS}) AS max_abs_diff,
  any_value(l.k) AS low_iterations, any_value(h.k) AS high_iterations
  FROM done_low a JOIN done_high b USING (node), stopped_low l, stopped_high h""",
    )


def _damping_report(edges: DataFrame, **options) -> DataFrame:
    """How far two dampings differ when each has run to its threshold; one pass for both."""
    specs = [rank.RankSpec(damping=d, epsilon=STOP, max_iter=_FAR, **options) for d in (_LOW, _HIGH)]
    low, high = rank.run_many(edges, specs)
    report = compare.max_abs_diff(low.ranks, high.ranks).select(rounded("max_abs_diff"))
    steps = {"low_iterations": F.lit(low.iterations), "high_iterations": F.lit(high.iterations)}
    return report.withColumns(steps)


@register("damping_sensitivity", _damping_sql("supply"))
def damping_sensitivity(spark, folder):
    return _damping_report(lenses.supply(spark, folder))


@register("damping_sensitivity_weighted", _damping_sql("copurchase"))
def damping_sensitivity_weighted(spark, folder):
    return _damping_report(lenses.copurchase(spark, folder), weighted=True)


@register(
    "convergence_curve",
    oracles.query(
        oracles.finished_ctes("basket", CURVE, FINE),
        f"""SELECT iteration, round(delta, {DIGITS}) AS delta FROM history JOIN stopped ON iteration <= k""",
    ),
)
def convergence_curve(spark, folder):
    """Change by step, to a fine threshold or the end of the budget."""
    result = rank.run(lenses.basket(spark, folder), epsilon=FINE, max_iter=CURVE, weighted=True)
    return result.history.select("iteration", rounded("delta"))


@register(
    "top_ten",
    oracles.query(
        oracles.finished_ctes("basket", LIMIT, FINE),
        f"""SELECT node, round(rank, {DIGITS}) AS rank, k AS iterations FROM done, stopped
  ORDER BY 2 DESC, node LIMIT 10""",
    ),
)
def top_ten(spark, folder):
    """The best ten of a run to a fine threshold; all nodes if there are fewer."""
    result = rank.run(lenses.basket(spark, folder), epsilon=FINE, max_iter=LIMIT, weighted=True)
    best = order.top_n(rounded_ranks(result), 10)
    return best.withColumn("iterations", F.lit(result.iterations))


# --- finished ranks ----------------------------------------------------------------


def _supply_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks of a finished run, rounded so that ties order alike everywhere."""
    return rounded_ranks(finished(lenses.supply(spark, folder)))


_SUPPLY_SQL = oracles.finished_ctes("supply", BUDGET, STOP) + f""",
ranks AS (SELECT node, round(rank, {DIGITS}) AS rank FROM done)"""

_DROP_SQL = oracles.finished_ctes("basket", BUDGET, STOP, redistribute=False)


def _drop_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Ranks of a run that loses mass until it settles."""
    return finished(lenses.basket(spark, folder), weighted=True, dangling="drop").ranks


@register(
    "top_n", oracles.query(_SUPPLY_SQL, "SELECT node, rank FROM ranks ORDER BY rank DESC, node LIMIT 20")
)
def top_n(spark, folder):
    return order.top_n(_supply_ranks(spark, folder), 20)


@register("rank_sorted", oracles.query(_SUPPLY_SQL, "SELECT node, rank FROM ranks ORDER BY rank DESC, node"))
def rank_sorted(spark, folder):
    return order.sorted_ranks(_supply_ranks(spark, folder))


@register(
    "rank_position",
    oracles.query(
        _SUPPLY_SQL, "SELECT node, rank, row_number() OVER (ORDER BY rank DESC, node) AS position FROM ranks"
    ),
)
def rank_position(spark, folder):
    return order.positions(_supply_ranks(spark, folder))


@register(
    "rank_export_rows",
    oracles.query(_SUPPLY_SQL, "SELECT node, printf('%.8f', rank) AS rank FROM done"),
)
def rank_export_rows(spark, folder):
    return rank_source.export_rows(finished(lenses.supply(spark, folder)).ranks)


@register("rank_total", oracles.query(_SUPPLY_SQL, "SELECT round(sum(rank), 6) AS total FROM done"))
def rank_total(spark, folder):
    ranks = finished(lenses.supply(spark, folder)).ranks
    return compare.total(ranks).select(rounded("total", 6))


@register(
    "rank_stddev", oracles.query(_SUPPLY_SQL, f"SELECT round(stddev_pop(rank), {DIGITS}) AS stddev FROM done")
)
def rank_stddev(spark, folder):
    ranks = finished(lenses.supply(spark, folder)).ranks
    return compare.spread(ranks).select(rounded("stddev"))


@register(
    "mass_leak",
    oracles.query(
        _DROP_SQL,
        f"SELECT round(1 - sum(rank), {DIGITS}) AS leak FROM done",
    ),
)
def mass_leak(spark, folder):
    return compare.mass_leak(_drop_ranks(spark, folder)).select(rounded("leak"))


@register(
    "rank_invariants",
    oracles.query(
        _CONVERGED_SQL,
        f"""SELECT abs(sum(rank) - 1) < 1e-6 AS total_is_one,
  count(*) FILTER (WHERE rank IS NULL) AS missing_nodes,
  count(*) FILTER (WHERE out_weight IS NULL) AS extra_nodes,
  count(*) FILTER (WHERE out_weight = 0 AND coalesce(rank, 0) <= 0) AS sinks_without_rank
  FROM nodes FULL JOIN done USING (node)""",
    ),
)
def rank_invariants(spark, folder):
    with held(lenses.trade(spark, folder)) as edges:
        ranks = finished(edges, weighted=True).ranks
        nodes = graph.stored_node_table(edges, weighted=True)
    return compare.invariants(ranks, nodes)


_COMPARED_SQL = f"""SELECT node, round(a.rank, {DIGITS}) AS left_rank, round(b.rank, {DIGITS}) AS right_rank,
  round(abs(a.rank - b.rank), {DIGITS}) AS abs_diff FROM done_a a FULL JOIN done_b b USING (node)"""


def _compared(left: rank.RankResult, right: rank.RankResult) -> DataFrame:
    table = compare.compare(left.ranks, right.ranks)
    return table.select("node", rounded("left_rank"), rounded("right_rank"), rounded("abs_diff"))


@register(
    "rank_comparison",
    oracles.query(
        oracles.finished_ctes("trade", BUDGET, STOP, "_a")
        + ",\n"
        + oracles.finished_ctes("trade_unweighted", BUDGET, STOP, "_b"),
        _COMPARED_SQL,
    ),
)
def rank_comparison(spark, folder):
    """Weighted and plain ranks of the trade graph, each run to its threshold, in one pass."""
    specs = [rank.RankSpec(epsilon=STOP, max_iter=BUDGET, weighted=weighted) for weighted in (True, False)]
    return _compared(*rank.run_many(lenses.trade(spark, folder), specs))


@register(
    "rank_comparison_supply",
    oracles.query(
        oracles.finished_ctes("supply", BUDGET, STOP, "_a")
        + ",\n"
        + oracles.finished_ctes("supply", BUDGET, STOP, "_b", damping=0.7),
        _COMPARED_SQL,
    ),
)
def rank_comparison_supply(spark, folder):
    """Two dampings on the supply graph; they stop at different steps of one pass."""
    specs = [rank.RankSpec(epsilon=STOP, max_iter=BUDGET, damping=damping) for damping in (rank.DAMPING, 0.7)]
    return _compared(*rank.run_many(lenses.supply(spark, folder), specs))


def _worst_sql(graph: str) -> str:
    exact = oracles.finished_ctes(graph, BUDGET, STOP, "_a")
    text = oracles.finished_ctes(graph, BUDGET, STOP, "_b", precision=8, rounding="even")
    return oracles.query(
        f"{exact},\n{text}",
        f"SELECT round(max(abs(a.rank - b.rank)), {DIGITS}) AS max_abs_diff FROM done_a a JOIN done_b b USING (node)",
    )


def _worst(edges: DataFrame, **options) -> DataFrame:
    """The largest error of state with 8 decimals against full precision, at the same stop rule."""
    specs = [
        rank.RankSpec(epsilon=STOP, max_iter=BUDGET, **options),
        rank.RankSpec(epsilon=STOP, max_iter=BUDGET, precision=8, rounding="even", **options),
    ]
    exact, text = rank.run_many(edges, specs)
    return compare.max_abs_diff(exact.ranks, text.ranks).select(rounded("max_abs_diff"))


@register("rank_max_abs_diff", _worst_sql("trade"))
def rank_max_abs_diff(spark, folder):
    return _worst(lenses.trade(spark, folder), weighted=True)


@register("rank_max_abs_diff_supply", _worst_sql("supply"))
def rank_max_abs_diff_supply(spark, folder):
    return _worst(lenses.supply(spark, folder))


@register(
    "rank_keyset_mismatch",
    oracles.query(
        oracles.graph_ctes("supply", name="_a") + ",\n" + oracles.graph_ctes("trade", name="_b"),
        """SELECT count(*) FILTER (WHERE b.node IS NULL) AS only_left,
  count(*) FILTER (WHERE a.node IS NULL) AS only_right
  FROM nodes_a a FULL JOIN nodes_b b ON a.node = b.node""",
    ),
)
def rank_keyset_mismatch(spark, folder):
    left = fixed_run(lenses.supply(spark, folder), 1).ranks
    right = trade_run(spark, folder, 1).ranks
    return compare.keyset_mismatch(left, right)


# --- run measurements ----------------------------------------------------------------


def _measured(select: str) -> str:
    return oracles.query(lenses.MEASURED_RESULTS_SQL, select)


@register("bench_summary", _measured("SELECT * FROM measured_results"))
def bench_summary(spark, folder):
    return lenses.measured_results(spark, folder)


@register(
    "bench_runtime_series",
    _measured("SELECT label, n_nodes, time_s, time_s_std FROM measured_results WHERE status = 'ok'"),
)
def bench_runtime_series(spark, folder):
    return measure.runtime_series(lenses.measured_results(spark, folder))


@register(
    "bench_memory_series",
    _measured(
        """SELECT label, n_nodes, peak_mem_mb, peak_mem_mb_std FROM measured_results
  WHERE status = 'ok' AND peak_mem_mb IS NOT NULL AND peak_mem_mb <> 0"""
    ),
)
def bench_memory_series(spark, folder):
    return measure.memory_series(lenses.measured_results(spark, folder))


@register(
    "bench_speedup",
    _measured(
        f"""SELECT r.label, n_nodes, round(b.time_s / r.time_s, {DIGITS}) AS speedup
  FROM measured_results r JOIN measured_results b USING (n_nodes)
  WHERE r.status = 'ok' AND b.status = 'ok' AND b.label = 'VIEW' AND r.time_s > 0"""
    ),
)
def bench_speedup(spark, folder):
    factors = measure.speedup(lenses.measured_results(spark, folder), "VIEW")
    return factors.select("label", "n_nodes", rounded("speedup"))


@register(
    "bench_worst_error",
    _measured(
        """SELECT label, greatest(max(max_diff_vs_core), 1e-16) AS worst_error
  FROM measured_results WHERE status = 'ok' GROUP BY label"""
    ),
)
def bench_worst_error(spark, folder):
    return measure.worst_error(lenses.measured_results(spark, folder))


# --- files written and read back ------------------------------------------------------


@register(
    "edge_file_roundtrip",
    oracles.query(lenses.TRADE_SQL, "SELECT src, dst, round(w, 2) AS w FROM trade"),
)
def edge_file_roundtrip(spark, folder):
    path = shared_path(spark, "edges")
    edge_source.write_edges(lenses.trade(spark, folder), path)
    edges = edge_source.read_edges(spark, path, weighted=True)
    return edges.select("src", "dst", rounded("w", 2))


@register(
    "edge_table_roundtrip", oracles.query(lenses.SUPPLY_SQL, "SELECT src, dst FROM supply")
)
def edge_table_roundtrip(spark, folder):
    path = shared_path(spark, "edges")
    edge_source.write_edges(lenses.supply(spark, folder), path)
    return edge_source.read_edge_table(spark, path)


@register("state_file_roundtrip", _state_sql(8))
def state_file_roundtrip(spark, folder):
    path = shared_path(spark, "state")
    state_source.write_state(_state(spark, folder), path, "pipe")
    return _shown_state(state_source.read_state(spark, path, "pipe"), 8)


_DROP_8_SQL = oracles.query(_DROP_SQL, "SELECT node, round(rank, 8) AS rank FROM done")


@register("ranking_file_roundtrip", _DROP_8_SQL)
def ranking_file_roundtrip(spark, folder):
    path = shared_path(spark, "ranking")
    rank_source.write_ranking(_drop_ranks(spark, folder), path)
    return rank_source.read_ranks(spark, path)


@register("ranking_file_merged", _DROP_8_SQL)
def ranking_file_merged(spark, folder):
    """One ordered file with one header, joined from parts by the file system."""
    path = shared_path(spark, "ranking")
    rank_source.write_ranking_file(_drop_ranks(spark, folder), path)
    return rank_source.read_ranks(spark, path)


@register("state_file_merged", _state_sql(8))
def state_file_merged(spark, folder):
    path = shared_path(spark, "state")
    state_source.write_state_file(_state(spark, folder), path, "pipe")
    return _shown_state(state_source.read_state(spark, path, "pipe"), 8)


@register("rank_text_roundtrip", _DROP_8_SQL)
def rank_text_roundtrip(spark, folder):
    path = shared_path(spark, "ranks")
    rank_source.write_rank_text(_drop_ranks(spark, folder), path)
    return rank_source.read_ranks(spark, path)


@register(
    "rank_table_roundtrip",
    oracles.query(_DROP_SQL, f"SELECT node, round(rank, {DIGITS}) AS rank FROM done"),
)
def rank_table_roundtrip(spark, folder):
    path = shared_path(spark, "ranks")
    rank_source.write_rank_table(_drop_ranks(spark, folder), path)
    return rank_source.read_ranks(spark, path).select("node", rounded("rank"))


@register(
    "relation_file_roundtrip", oracles.query(lenses.QUOTED_SQL, "SELECT src, dst FROM quoted")
)
def relation_file_roundtrip(spark, folder):
    """Ids that hold quotes, through text and a loader that doesn't quote."""
    path = shared_path(spark, "relation")
    lenses.quoted_lines(spark, folder).write.text(path)
    return edge_source.read_relation(spark, path)


@register("rank_quoted_ids", _ranks_sql(2, graph="quoted"))
def rank_quoted_ids(spark, folder):
    path = shared_path(spark, "relation")
    lenses.quoted_lines(spark, folder).write.text(path)
    return rounded_ranks(fixed_run(edge_source.read_relation(spark, path), 2))


_IDS_SQL = (
    _FIELDS.format(comment="AND NOT starts_with(line, '#')")
    + f""",
ids AS (SELECT trim(f[1], {_SPACE}) AS src, trim(f[2], {_SPACE}) AS dst FROM fields WHERE len(f) >= 2),
"""
    + oracles.rank_ctes("ids", 1)
)


@register("rank_ids_roundtrip", oracles.query(_IDS_SQL, "SELECT node, round(rank, 8) AS rank FROM r1"))
def rank_ids_roundtrip(spark, folder):
    """One step on a graph whose ids include the empty one, through ranking text and back."""
    path = shared_path(spark, "ranks")
    edges = edge_source.parse_edges(lenses.edge_lines(spark, folder), "core")
    rank_source.write_rank_text(fixed_run(edges, 1).ranks, path)
    return rank_source.read_ranks(spark, path)


@register("rank_resume", _ranks_sql(7, graph="trade"))
def rank_resume(spark, folder):
    """Three steps, the state as text, and four more steps from that text."""
    path = shared_path(spark, "state")
    with held(lenses.trade(spark, folder)) as edges:
        ranks = fixed_run(edges, 3, weighted=True).ranks
        state_source.write_state(graph.adjacency(edges, ranks=ranks), path, "tsv")
        state = state_source.read_state(spark, path, "tsv")
        return rounded_ranks(fixed_run(edges, 4, weighted=True, init=state))


@register("rank_chain", _ranks_sql(5, graph="trade_unweighted", redistribute=False))
def rank_chain(spark, folder):
    """Two steps from files to files, and three more from what the folder holds."""
    path = shared_path(spark, "chain")
    chain.run_chain(lenses.trade(spark, folder), path, epsilon=0.0, max_iter=2)
    return rounded_ranks(chain.run_chain(None, path, epsilon=0.0, max_iter=5, spark=spark))


@register(
    "edges_from_state", oracles.query(lenses.TRADE_SQL, "SELECT src, dst FROM trade")
)
def edges_from_state(spark, folder):
    lines = state_source.format_json(_state(spark, folder))
    return state_source.edges_from_state(state_source.parse_json(lines))


@register(
    "bench_file_roundtrip",
    _measured(
        """SELECT framework, label, n_nodes, n_edges, time_s, time_s_std, peak_mem_mb,
  coalesce(peak_mem_mb_std, 0) AS peak_mem_mb_std, CAST(n_runs AS INTEGER) AS n_runs, iterations,
  max_diff_vs_core, status FROM measured_results WHERE status = 'ok'"""
    ),
)
def bench_file_roundtrip(spark, folder):
    path = shared_path(spark, "runs")
    run_source.append_runs(lenses.measured_results(spark, folder), path)
    return run_source.read_runs(spark, path)


# --- synthetic graphs ------------------------------------------------------------------


def _draw_sql(seed: int, *key: str) -> str:
    text = " || ':' || ".join([f"'{seed}'", *[f"CAST({part} AS VARCHAR)" for part in key]])
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


_M, _SEED = synth.ATTACHMENT, synth.SEED
#: Draws that are more than enough for any node of the test tables.
_DRAWS = 40


def _scale_free_sql(below: str = "") -> str:
    """``synthetic``: the generated edges over the customers, or over those below a count."""
    own = f"2 * ((c_custkey - {_M}) * {_M} + link) + 1"
    again = f"{_draw_sql(_SEED, repr('again'), 'c_custkey', 'link')} % greatest(2 * {_M} * (c_custkey - {_M}), 1)"
    return f"""
trace AS (
  SELECT c_custkey AS node, link, CASE WHEN link < {_M} THEN {own} ELSE {again} END AS slot
  FROM customer, range({_DRAWS}) x(link) WHERE c_custkey >= {_M} {below} AND (c_custkey > {_M} OR link < {_M})
  UNION ALL
  SELECT node, link, {_draw_sql(_SEED, "slot")} % ((slot // 2) // {_M} * {2 * _M})
  FROM trace WHERE slot % 2 = 1 AND slot // 2 >= {_M}),
drawn AS (
  SELECT node, CASE WHEN slot % 2 = 0 THEN {_M} + (slot // 2) // {_M} ELSE slot // 2 END AS older, min(link) AS link
  FROM trace WHERE slot % 2 = 0 OR slot // 2 < {_M} GROUP BY 1, 2),
synthetic AS (
  SELECT CAST(older AS VARCHAR) AS src, CAST(node AS VARCHAR) AS dst FROM drawn
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY link) <= {_M})"""


_SCALE_FREE_SQL = _scale_free_sql()


def _customer_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The customers, whose keys run 0, 1, 2, … without gaps."""
    return lenses.table(spark, folder, "customer").select(F.col("c_custkey").alias("id"))


@register(
    "synth_scale_free",
    f"WITH RECURSIVE {_SCALE_FREE_SQL} SELECT src, dst, "
    f"CAST({_draw_sql(_SEED, repr('w'), 'src', 'dst')} % {synth.MAX_WEIGHT} + 1 AS DOUBLE) AS w FROM synthetic",
)
def synth_scale_free(spark, folder):
    ids = _customer_ids(spark, folder)
    return synth.scale_free_edges(ids, ids.count(), weighted=True)


@register(
    "synth_edge_count",
    "SELECT n AS nodes, " + f"{synth.ATTACHMENT} * (n - {synth.ATTACHMENT}) AS edges"
    """, 0::BIGINT AS repeated, 0::BIGINT AS backward
  FROM (SELECT unnest([count(*) // 4, count(*) // 2, count(*)]) AS n FROM customer)""",
)
def synth_edge_count(spark, folder):
    """Graphs of three sizes: m (N - m) edges, none twice, all from the lower to the higher node."""
    ids = _customer_ids(spark, folder)
    customers = ids.count()
    sizes = None
    for count in (customers // 4, customers // 2, customers):
        edges = synth.scale_free_edges(ids.where(F.col("id") < count), count)
        pairs = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("copies"))
        backward = F.col("src").cast("long") >= F.col("dst").cast("long")
        row = pairs.agg(
            F.lit(count).cast("long").alias("nodes"),
            F.sum("copies").alias("edges"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0).cast("long")).alias("repeated"),
            F.count_if(backward).alias("backward"),
        )
        sizes = row if sizes is None else sizes.unionByName(row)
    return sizes


def _repair_sql(edges: str) -> str:
    return f"""
listed AS (SELECT node, row_number() OVER (ORDER BY node) - 1 AS i, count(*) OVER () AS n
  FROM (SELECT src AS node FROM {edges} UNION SELECT dst FROM {edges})),
jumps AS (SELECT node AS src, (i + 1 + {_draw_sql(_SEED, "node")} % (n - 1)) % n AS i
  FROM listed WHERE node NOT IN (SELECT src FROM {edges})),
repaired AS (SELECT src, dst FROM {edges}
  UNION ALL SELECT src, node AS dst FROM jumps JOIN listed USING (i))"""


@register(
    "repair_dangling",
    oracles.query(
        lenses.TRADE_SQL + "," + _repair_sql("trade"), "SELECT src, dst FROM repaired"
    ),
)
def repair_dangling(spark, folder):
    edges = lenses.trade(spark, folder).select("src", "dst")
    return synth.repair_dangling(edges)


LONG = 30


@register(
    "rank_scale_free",
    "WITH RECURSIVE "
    + _SCALE_FREE_SQL
    + ","
    + _repair_sql("synthetic")
    + ","
    + oracles.rank_ctes("repaired", LONG)
    + f" SELECT node, round(rank, {DIGITS}) AS rank FROM r{LONG}",
)
def rank_scale_free(spark, folder):
    """The long benchmark run: 30 steps on a repaired scale-free graph."""
    ids = _customer_ids(spark, folder)
    edges = synth.repair_dangling(synth.scale_free_edges(ids, ids.count()))
    return rounded_ranks(fixed_run(edges, LONG))
