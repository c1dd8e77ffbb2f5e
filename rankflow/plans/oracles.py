"""SQL text that recomputes the ranking queries in another engine.

A run of K steps becomes K chained common table expressions. Doubles are written
with an exponent because plain decimals are exact numbers in SQL.
"""

from __future__ import annotations

from rankflow.plans import lenses

# Lens name -> its SQL, and the SQL of its weight.
_GRAPHS = {
    "supply": (lenses.SUPPLY_SQL, "1e0"),
    "trade": (lenses.TRADE_SQL, "w"),
    "trade_unweighted": (lenses.TRADE_SQL, "1e0"),
    "nation_trade": (lenses.NATION_TRADE_SQL, "w"),
    "copurchase": (lenses.COPURCHASE_SQL, "w"),
    "basket": (lenses.BASKET_SQL, "w"),
    "quoted": (lenses.QUOTED_SQL, "1e0"),
    "cyclic": (None, "w"),  # defined by the query that uses it
    "repaired": (None, "1e0"),  # likewise
    "ids": (None, "1e0"),  # likewise
}


def graph_ctes(graph: str, universe: bool = False, name: str = "") -> str:
    """``e`` (edges), ``nodes``, ``cnt`` and ``tr`` (transitions) of a lens."""
    definition, weight = _GRAPHS[graph]
    table = graph.removesuffix("_unweighted")
    extra = "UNION ALL SELECT node, 0e0, 0 FROM universe" if universe else ""
    universe_cte = lenses.UNIVERSE_SQL + "," if universe else ""
    if definition is None:
        defined = ""
    else:
        defined = definition.replace(f"{table} AS", f"{table}{name} AS", 1) + ","
    return f"""{universe_cte}{defined}
e{name} AS MATERIALIZED (SELECT src, dst, {weight} AS w FROM {table}{name}),
nodes{name} AS MATERIALIZED (
  SELECT node, sum(w) AS out_weight, sum(k)::BIGINT AS out_degree FROM (
    SELECT src AS node, w, 1 AS k FROM e{name} UNION ALL SELECT dst, 0e0, 0 FROM e{name} {extra})
  GROUP BY node),
cnt{name} AS MATERIALIZED (SELECT count(*)::DOUBLE AS n FROM nodes{name}),
tr{name} AS MATERIALIZED (
  SELECT src, dst, sum(w) / any_value(out_weight) AS prob
  FROM e{name} JOIN nodes{name} ON src = node WHERE out_weight > 0 GROUP BY src, dst)"""


def rank_ctes(
    graph: str,
    steps: int,
    damping: float = 0.85,
    restart: str | None = None,
    universe: bool = False,
    redistribute: bool = True,
    init: str = "1e0 / n",
    precision: int | None = None,
    share_precision: int | None = None,
    rounding: str = "up",
    name: str = "",
) -> str:
    """``r0 … rK`` (node, rank) and ``dm0 … dmK`` (dangling mass) of a run.

    ``restart`` is a subquery ``node, score``.
    """
    parts = [graph_ctes(graph, universe, name)]
    if restart is None:
        parts.append(
            f"tp{name} AS MATERIALIZED (SELECT node, out_weight, 1e0 / n AS p FROM nodes{name}, cnt{name})"
        )
    else:
        parts.append(f"""tp{name} AS MATERIALIZED (
  SELECT node, out_weight, s / sum(s) OVER () AS p FROM (
    SELECT node, out_weight, coalesce(greatest(score, 0e0), 0e0) AS s
    FROM nodes{name} LEFT JOIN ({restart}) USING (node)))""")
    rank = init if precision is None else rounded_sql(init, precision, rounding)
    parts.append(f"r{name}0 AS MATERIALIZED (SELECT node, {rank} AS rank FROM nodes{name}, cnt{name})")
    parts.append(_dangling(name, 0))
    for k in range(1, steps + 1):
        mass = f"p * dm{name}{k - 1}.mass" if redistribute else "0e0"
        rank = (
            f"{1 - damping!r}::DOUBLE * p + {damping!r}::DOUBLE * (coalesce(s, 0e0) + {mass})"
        )
        if precision is not None:
            rank = rounded_sql(f"({rank})", precision, rounding)
        flow = f"sum(prob * rank) AS s FROM tr{name} JOIN r{name}{k - 1} ON src = node"
        if share_precision is not None:
            share = rounded_sql("(rank / out_weight)", share_precision, rounding)
            flow = f"""sum(w * {share}) AS s FROM e{name}
    JOIN r{name}{k - 1} ON src = node JOIN nodes{name} USING (node) WHERE out_weight > 0"""
        parts.append(f"""r{name}{k} AS MATERIALIZED (
  SELECT tp{name}.node, {rank} AS rank FROM tp{name} LEFT JOIN (
    SELECT dst, {flow} GROUP BY dst) x
  ON tp{name}.node = x.dst, dm{name}{k - 1})""")
        parts.append(_dangling(name, k))
    return ",\n".join(parts)


def rounded_sql(value: str, digits: int, rule: str) -> str:
    """A non-negative double rounded to decimals, by the rules of ``fixed_point``.

    ``up`` goes through the shortest decimal text; ``even`` through both exact halves of the product.
    """
    if rule == "up":
        return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 28)), {digits}) AS DOUBLE)"
    scale = f"{10.0**digits!r}::DOUBLE"
    high = f"({value} * 134217729e0 - ({value} * 134217729e0 - {value}))"
    low = f"(({value} - {high}) * {scale})"
    whole = f"(floor({high} * {scale}) + floor({low} + 0.5e0))"
    over = f"(({high} * {scale} - floor({high} * {scale}) - 0.5e0) + ({low} - floor({low} + 0.5e0)))"
    step = f"CASE WHEN {over} > 0 OR ({over} = 0 AND {whole} % 2 <> 0) THEN 1e0 WHEN {over} = -1 AND {whole} % 2 <> 0 THEN -1e0 ELSE 0e0 END"
    return f"(({whole} + {step}) / {scale})"


def _dangling(name: str, k: int) -> str:
    return f"""dm{name}{k} AS MATERIALIZED (
  SELECT coalesce(sum(rank), 0e0) AS mass FROM r{name}{k} JOIN nodes{name} USING (node) WHERE out_weight = 0)"""


def history_cte(steps: int, name: str = "", change: str = "sum(abs(a.rank - b.rank))") -> str:
    """``history``: one row per step of a run."""
    rows = [
        f"""SELECT {k} AS iteration, (SELECT {change} FROM r{name}{k} a JOIN r{name}{k - 1} b
    USING (node)) AS delta, (SELECT mass FROM dm{name}{k}) AS dangling_mass,
    (SELECT sum(rank) FROM r{name}{k}) AS total"""
        for k in range(1, steps + 1)
    ]
    return f"history{name} AS MATERIALIZED (" + " UNION ALL ".join(rows) + ")"


def finished_ctes(graph: str, steps: int, stop: float, name: str = "", **options) -> str:
    """A run that stops: ``history``, ``stopped`` (k, converged) and ``done`` (node, rank).

    The twin of a run with ``epsilon=stop`` and at most ``steps`` steps.
    """
    under = f"FILTER (WHERE delta < {stop!r})"
    states = " UNION ALL ".join(
        f"SELECT node, rank FROM r{name}{k} WHERE {k} = (SELECT k FROM stopped{name})"
        for k in range(1, steps + 1)
    )
    return ",\n".join([
        rank_ctes(graph, steps, name=name, **options),
        history_cte(steps, name),
        f"""stopped{name} AS MATERIALIZED (
  SELECT coalesce(min(iteration) {under}, max(iteration)) AS k, count(*) {under} > 0 AS converged
  FROM history{name})""",
        f"done{name} AS MATERIALIZED ({states})",
    ])


def query(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"
