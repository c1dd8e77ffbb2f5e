"""Rank steps as jobs from files to files, and chains of them that survive being killed.

A step reads node state (rank and neighbours as text), and writes the next state. What
holds is in the folder's manifest: a state counts once its entry is there, and an entry
appears as a whole or not at all. A chain that was broken off goes on from the last committed
state; folders of states without an entry are dropped, as are states that were followed by another.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.operators import fixed_point, graph
from rankflow.operators.fixed_point import double, joined, limbs, rounded
from rankflow.operators.rank import DAMPING, EPSILON, HISTORY_SCHEMA, RankResult
from rankflow.session import ensure_checkpoint_dir
from rankflow.sources.files import Files
from rankflow.sources.state import read_state, write_state


@dataclass(frozen=True)
class ChainRule:
    """What all steps of a chain have in common; a folder belongs to one rule."""

    damping: float = DAMPING
    dangling: str = "drop"
    init: str = "uniform"
    precision: int | None = None
    share_precision: int | None = None
    rounding: str = "up"
    style: str = "tsv"


class Manifest:
    """The committed states of a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.files = spark, folder.rstrip("/"), Files(spark, folder)

    def state(self, iteration: int) -> str:
        return f"{self.folder}/state-{iteration:06d}"

    def entries(self) -> list[dict]:
        """What was committed, by iteration; one small file a step."""
        names = [name for name in self.files.names(f"{self.folder}/manifest") if name.endswith(".json")]
        if not names:
            return []
        lines = self.spark.read.text([f"{self.folder}/manifest/{name}" for name in names]).collect()
        return sorted((json.loads(line["value"]) for line in lines), key=lambda entry: entry["iteration"])

    def commit(self, entry: dict) -> None:
        self.files.write_text(f"{self.folder}/manifest/{entry['iteration']:06d}.json", json.dumps(entry))

    def tidy(self, last: int) -> None:
        """Drop every state but the last committed one."""
        kept = self.state(last).rpartition("/")[2]
        for name in self.files.names(self.folder):
            if name.startswith("state-") and name != kept:
                self.files.remove(f"{self.folder}/{name}")


def _measured(table: DataFrame, most: float) -> dict[str, float]:
    """Change, rank of nodes without links, and total of a table node, degree, rank, previous."""
    bits = fixed_point.first_bits(most)
    texts = {"delta": "abs(rank - previous)", "dangling_mass": "IF(degree = 0, rank, 0D)", "total": "rank"}
    columns = [
        f"sum({text}) AS {name}_{part}" for name, value in texts.items() for part, text in zip("hl", limbs(value, bits), strict=True)
    ]
    seen = table.selectExpr(*columns).first()
    return {name: fixed_point.value(seen[f"{name}_h"], seen[f"{name}_l"], bits) for name in texts}


def state_step(state: DataFrame, rule: ChainRule, nodes: int, dangling_mass: float) -> DataFrame:
    """Next ranks, ``node, degree, rank, previous``, from state ``node, rank, neighbors``.

    A hub may have several rows, each with its full rank and a slice of its links.
    """
    most = max(1.0, nodes if rule.init == "one" else 1.0)
    bits = fixed_point.first_bits(most)
    table = state.groupBy("node").agg(F.max("rank").alias("previous"), F.sum(F.size("neighbors")).alias("degree"))
    share = rounded("previous / degree", rule.share_precision, rule.rounding)
    shares = table.where("degree > 0").selectExpr("node", f"{share} AS share")
    high, low = limbs("share", bits)
    flows = state.select("node", F.explode("neighbors").alias("to")).join(shares, "node")
    sums = flows.selectExpr("to AS node", f"{high} AS h", f"{low} AS l").groupBy("node").agg(F.sum("h").alias("h"), F.sum("l").alias("l"))
    inflow = sums.selectExpr("node", f"{joined('h', 'l', bits)} AS inflow")
    held = dangling_mass if rule.dangling == "teleport" else 0.0
    restarted = f"{double(1.0 - rule.damping + rule.damping * held)} * {double(1.0 / nodes)}"
    rank = rounded(f"{restarted} + {double(rule.damping)} * coalesce(inflow, 0D)", rule.precision, rule.rounding)
    return table.join(inflow, "node", "left").selectExpr("node", "degree", f"{rank} AS rank", "previous")


def _begin(manifest: Manifest, edges: DataFrame, rule: ChainRule) -> dict:
    lists = graph.adjacency(edges).checkpoint()
    table = lists.groupBy("node").agg(F.sum(F.size("neighbors")).alias("degree"))
    nodes = table.count()
    if not nodes:
        raise ValueError("there are no nodes to rank")
    start = 1.0 if rule.init == "one" else 1.0 / nodes
    start = start if rule.precision is None else round(start, rule.precision)
    write_state(lists.withColumn("rank", F.lit(start)), manifest.state(0), rule.style, mode="overwrite")
    held = start * table.where("degree = 0").count()
    return {"iteration": 0, "nodes": nodes, "rule": rule.__dict__, "dangling_mass": held}


def _advance(manifest: Manifest, before: dict, rule: ChainRule) -> dict:
    """Read the last state, write the next one; returns its entry, not yet committed."""
    iteration, nodes = before["iteration"] + 1, before["nodes"]
    state = read_state(manifest.spark, manifest.state(before["iteration"]), rule.style)
    table = state_step(state, rule, nodes, before["dangling_mass"]).checkpoint()
    seen = _measured(table, max(1.0, nodes if rule.init == "one" else 1.0))
    lists = state.drop("rank").join(table.select("node", "rank"), "node")
    write_state(lists, manifest.state(iteration), rule.style, mode="overwrite")
    return {"iteration": iteration, "nodes": nodes, **seen}


def run_chain(
    edges: DataFrame | None,
    folder: str,
    rule: ChainRule | None = None,
    epsilon: float = EPSILON,
    max_iter: int = 20,
    spark: SparkSession | None = None,
) -> RankResult:
    """Step from state to state in ``folder`` until the change is below ``epsilon``, ``max_iter`` steps at most.

    A folder that holds committed states goes on from the last one; ``edges`` are read only at
    the start. Asking for another rule than the folder's fails. At most two states are on
    disk; the last one stays.
    """
    rule = rule or ChainRule()
    spark = spark or edges.sparkSession
    ensure_checkpoint_dir(spark)
    manifest = Manifest(spark, folder)
    entries = manifest.entries()
    if not entries:
        if edges is None:
            raise ValueError(f"{folder} holds no committed state, and there are no edges to begin with")
        entries = [_begin(manifest, edges, rule)]
        manifest.commit(entries[0])
    elif entries[0]["rule"] != rule.__dict__:
        raise ValueError(f"{folder} was begun with {entries[0]['rule']}")
    manifest.tidy(entries[-1]["iteration"])
    converged = entries[-1].get("delta", float("inf")) < epsilon
    while not converged and entries[-1]["iteration"] < max_iter:
        entries.append(_advance(manifest, entries[-1], rule))
        manifest.commit(entries[-1])
        manifest.tidy(entries[-1]["iteration"])
        converged = entries[-1]["delta"] < epsilon
    steps = [(e["iteration"], e["delta"], e["dangling_mass"], e["total"]) for e in entries[1:]]
    last = read_state(spark, manifest.state(entries[-1]["iteration"]), rule.style)
    return RankResult(
        ranks=last.groupBy("node").agg(F.max("rank").alias("rank")),
        history=spark.createDataFrame(steps, HISTORY_SCHEMA),
        num_nodes=entries[0]["nodes"],
        iterations=len(steps),
        converged=converged,
        deltas=[step[1] for step in steps],
        damping=rule.damping,
    )
