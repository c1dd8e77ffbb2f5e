"""Rank steps on whole parts of a graph, held as arrays.

A node with number ``id`` lies in part ``id % parts`` at place ``id // parts``. A part's state is one row with the
ranks of all its nodes, its edges are one row or a few, sorted by target, and it sends at most one message per step and
row to each part: the inflow sums of that part's nodes, in order. So a step moves sums and the gaps between their
targets in place of rows, and looks nothing up. Sums are the limbs of ``fixed_point``; ranks and metrics come from the
same operations in the same order as those of ``Batch.step`` and have the same bits.

Edges of hot sources are dealt to all parts by pair; the ranks of these sources go along with the step.
"""

from __future__ import annotations

import functools
import math
import pickle
import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rankflow.operators.fixed_point import EXACT_DIGITS, LOW, double
from rankflow.session import passing_shuffles

if TYPE_CHECKING:
    from rankflow.operators.rank import Batch, RankSpec

# Workers get the functions themselves: they may not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Edges of a part on average, and of one packed row, at most.
_PART_EDGES = 4_000_000
_ROW_EDGES = 2_000_000
#: Slices of a graph of more than one part's edges, at most.
_SLICES = 4


def can_pack(spec: RankSpec) -> bool:
    """Whether arrays have all that a parameter set needs; decimal texts of ranks are left to rows."""
    plain = spec.precision is None or (spec.rounding == "even" and spec.precision <= EXACT_DIGITS)
    return plain and spec.share_precision is None


def _hashed(values: np.ndarray) -> np.ndarray:
    """What Spark's ``hash`` makes of integers, by which it deals out rows."""
    k = values.astype(np.uint32) * np.uint32(0xCC9E2D51)
    k = ((k << np.uint32(15)) | (k >> np.uint32(17))) * np.uint32(0x1B873593)
    h = np.uint32(42) ^ k
    h = ((h << np.uint32(13)) | (h >> np.uint32(19))) * np.uint32(5) + np.uint32(0xE6546B64)
    h ^= np.uint32(4)
    h = (h ^ (h >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    h = (h ^ (h >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (h ^ (h >> np.uint32(16))).view(np.int32)


def part_keys(parts: int) -> list[int]:
    """A key for each part, such that rows dealt out by key lie one part in a partition."""
    keys, first, size = np.full(parts, -1, np.int64), 0, 16 * parts + 1024
    while (keys < 0).any():
        values = np.arange(first, first + size)[::-1]
        keys_here = np.full(parts, -1, np.int64)
        keys_here[_hashed(values).astype(np.int64) % parts] = values
        keys = np.where(keys < 0, keys_here, keys)
        first += size
    return keys.tolist()


def _small(values: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 on in as few bytes as they need."""
    return values.astype(np.min_scalar_type(values.max(initial=0)))


def _limbs(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two limbs of ``fixed_point.limbs``."""
    scaled = values * 2.0**bits
    high = np.floor(scaled)
    return high.astype(np.int64), np.floor((scaled - high) * 2.0**LOW).astype(np.int64)


def _nearest_even(x: np.ndarray, digits: int) -> np.ndarray:
    """``fixed_point._nearest_even``, operation by operation."""
    scale, split = 10.0**digits, 134217729.0
    high = x * split - (x * split - x)
    a, b = high * scale, (x - high) * scale
    near_b = np.floor(b + 0.5)
    whole = np.floor(a) + near_b
    over = ((a - np.floor(a)) - 0.5) + (b - near_b)
    odd = whole % 2 != 0
    step = np.where((over > 0) | ((over == 0) & odd), 1, np.where((over == -1) & odd, -1, 0))
    return (whole + step) / scale


def _pieces(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of groups with about _ROW_EDGES edges each."""
    ends, first = np.cumsum(sizes), 0
    while first < len(sizes):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + _ROW_EDGES, "right")))
        yield first, last
        first = last


class Parts:
    """How nodes are dealt to parts. Goes to the workers."""

    def __init__(self, nodes: int, parts: int, hot: int) -> None:
        self.nodes, self.count, self.hot = nodes, parts, hot
        self.keys = part_keys(parts)
        self.of_key = {key: part for part, key in enumerate(self.keys)}
        self.span = -(-nodes // parts)  # places of a part at most

    def size(self, part: int) -> int:
        return (self.nodes - part + self.count - 1) // self.count

    def first_place(self, number: int, part: int) -> int:
        """Place of the first node of a part whose number is at least the given one."""
        return max(0, -(-(number - part) // self.count))

    def key(self, part: str) -> str:
        """SQL text of the key of a part."""
        return f"element_at(array({', '.join(map(str, self.keys))}), CAST({part} AS INT) + 1)"

    def key_of_node(self, number: str) -> str:
        return self.key(f"{number} % {self.count}")


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


_PACKED = "key int, edges binary"
_STEPPED = "key int, ranks binary, fixed binary, seen array<bigint>"


def _pack(at: Parts, weighted: bool, plain: bool, hot_degree: np.ndarray, hot_weight: np.ndarray) -> Callable:
    """Edges of a part with the degrees of its nodes, as packed rows."""

    def totals(own: int, facts: pa.Table, name: str, of_hot: np.ndarray) -> np.ndarray:
        found = np.zeros(own + at.hot)
        found[_numbers(facts, "id") // at.count] = _numbers(facts, name)
        found[own:] = of_hot
        return found

    def run(key: tuple, edges: pa.Table, facts: pa.Table) -> pa.Table:
        number = key[0].as_py()
        own, rows = at.size(at.of_key[number]), []
        if edges.num_rows:
            src, dst, width = _numbers(edges, "src"), _numbers(edges, "dst"), own + at.hot
            source = np.where(src < at.hot, own + src, src // at.count)
            place = ((dst % at.count) * at.span + dst // at.count) * width + source
            del src, dst
            extra = [name for name in ("w", "copies") if name in edges.column_names]
            if extra:
                order = np.argsort(place, kind="stable")
                place = place[order]
            else:
                place.sort()
            starts = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
            summed = {name: np.add.reduceat(_numbers(edges, name)[order], starts) for name in extra}
            copies = summed["copies"] if "copies" in extra else np.diff(starts, append=len(place))
            target, source = np.divmod(place[starts], width)
            del place
            if weighted:
                total = totals(own, facts, "out_weight", hot_weight)[source]
                share = np.divide(summed["w"], total, out=np.zeros(len(total)), where=total > 0)
            if plain:
                degree = _small(totals(own, facts, "out_degree", hot_degree).astype(np.int64))
            groups = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1])))
            goals, sizes = target[groups], np.diff(groups, append=len(target))
            for first, last in _pieces(sizes):
                a, b = groups[first], groups[last - 1] + sizes[last - 1]
                part, slot = np.divmod(goals[first:last], at.span)
                cuts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
                gaps = np.diff(slot, prepend=0)
                gaps[cuts] = 0
                packed = {"source": _small(source[a:b]), "sizes": _small(sizes[first:last]), "gaps": _small(gaps)}
                packed |= {"parts": part[cuts], "cuts": cuts, "bases": slot[cuts]}
                if weighted:
                    packed["share"] = share[a:b]
                if plain:
                    some = copies[a:b]
                    packed |= {"degree": degree, "copies": None if (some == 1).all() else _small(some)}
                rows.append(pickle.dumps(packed, 5))
        return pa.table({"key": pa.array([number] * len(rows), pa.int32()), "edges": pa.array(rows, pa.binary())})

    return run


def _pack_state(at: Parts, sets: int, personal: Sequence[int]) -> Callable:
    """Rows id, rank0, …, p0, … of a part as one row: ranks by set, restart shares by personalized set."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        number = key[0].as_py()
        own, place = at.size(at.of_key[number]), _numbers(rows, "id") // at.count

        def placed(names: Iterable[str]) -> bytes:
            found = []
            for name in names:
                found.append(np.zeros(own))
                found[-1][place] = _numbers(rows, name)
            return b"".join(x.tobytes() for x in found)

        ranks, fixed = placed(f"rank{k}" for k in range(sets)), placed(f"p{k}" for k in personal)
        return pa.table(
            {"key": pa.array([number], pa.int32()), "ranks": pa.array([ranks], pa.binary()), "fixed": pa.array([fixed], pa.binary())}
        )

    return run


def _unpack_state(at: Parts, sets: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, ranks in zip(batch["key"].to_pylist(), batch["ranks"], strict=True):
                part = at.of_key[key]
                columns = np.frombuffer(ranks.as_buffer()).reshape(sets, -1)
                ids = np.arange(columns.shape[1], dtype=np.int64) * at.count + part
                names = ["id", *[f"rank{k}" for k in range(sets)]]
                yield pa.RecordBatch.from_arrays([pa.array(ids), *[pa.array(x) for x in columns]], names=names)

    return run


def _message(base: int, gaps: np.ndarray, sums: Sequence[tuple[np.ndarray, np.ndarray]]) -> bytes:
    """Sums for nodes of a part; the first limb in two pieces, of which the upper one is short."""
    halves = []
    for high, low in sums:
        if high.min() < 0 or low.min() < 0:
            halves.append((None, high, low))
        else:
            halves.append(((high & 0xFFFFFFFF).astype(np.uint32), _small(high >> 32), _small(low)))
    return pickle.dumps((base, gaps, halves), 5)


def _send(at: Parts, sets: int, active: Sequence[tuple[int, bool]], bits: int, hot: np.ndarray) -> Callable:
    """Messages of a part's edges; ``active``: numbers of the sets and whether they are weighted."""

    def flow(edges: dict, rank: np.ndarray, weighted: bool) -> tuple[np.ndarray, np.ndarray]:
        source = edges["source"]
        if weighted:
            return _limbs(edges["share"] * rank[source], bits)
        degree = edges["degree"].astype(np.float64)
        if edges["copies"] is None:  # the same over every edge of a source
            share = np.divide(1.0, degree, out=np.zeros(len(degree)), where=degree > 0)
            return tuple(x[source] for x in _limbs(share * rank, bits))
        return _limbs(edges["copies"] / degree[source] * rank[source], bits)

    def run(state: pa.Table, packed: pa.Table) -> pa.Table:
        keys, sent = [], []
        for row in packed["edges"]:
            edges = pickle.loads(row.as_buffer())
            columns = np.frombuffer(state["ranks"][0].as_buffer()).reshape(sets, -1)
            starts = np.cumsum(edges["sizes"], dtype=np.int64) - edges["sizes"]
            sums = []
            for k, weighted in active:
                rank = np.concatenate((columns[k], hot[k])) if at.hot else columns[k]
                sums.append([np.add.reduceat(x, starts) for x in flow(edges, rank, weighted)])
            cuts = [*edges["cuts"].tolist(), len(starts)]
            for part, base, a, b in zip(edges["parts"].tolist(), edges["bases"].tolist(), cuts, cuts[1:], strict=False):
                keys.append(at.keys[part])
                sent.append(_message(base, edges["gaps"][a:b], [(h[a:b], low[a:b]) for h, low in sums]))
        return pa.table({"key": pa.array(keys, pa.int32()), "sums": pa.array(sent, pa.binary())})

    return run


def _inflow(own: int, messages: Iterable, active: int, bits: int) -> list[np.ndarray]:
    """Inflow of the nodes of a part for each active set."""
    sums = np.zeros((active, 2, own), np.int64)
    for message in messages:
        base, gaps, halves = pickle.loads(message.as_buffer())
        place = np.cumsum(gaps, dtype=np.int64) + base
        for total, (start, high, low) in zip(sums, halves, strict=True):
            total[0][place] += high if start is None else (high.astype(np.int64) << 32) + start
            total[1][place] += low.astype(np.int64)
    return [high / 2.0**bits + low / 2.0 ** (bits + LOW) for high, low in sums]


def _receive(
    at: Parts, specs: Sequence[dict], active: Sequence[int], held: Sequence[float], personal: Sequence[int], bits: int
) -> Callable:
    """Next ranks of a part, and what is measured about them, in the order of ``PackedSteps.names``."""

    def run(state: pa.Table, inbox: pa.Table) -> pa.Table:
        part = at.of_key[state["key"][0].as_py()]
        columns = np.frombuffer(state["ranks"][0].as_buffer()).reshape(len(specs), -1)
        own = columns.shape[1]
        restart = np.frombuffer(state["fixed"][0].as_buffer()).reshape(len(personal), own) if personal else []
        after, found = list(columns), []
        for k, inflow in zip(active, _inflow(own, inbox["sums"], len(active), bits), strict=True):
            spec = specs[k]
            mass = held[k] if spec["dangling"] == "teleport" else 0.0
            share = restart[personal.index(k)] if k in personal else 1.0 / at.nodes
            rank = (1.0 - spec["damping"] + spec["damping"] * mass) * share + spec["damping"] * inflow
            if spec["precision"] is not None:
                rank = _nearest_even(rank, spec["precision"])
            change, after[k] = np.abs(rank - columns[k]), rank
            measured = [change, rank[at.first_place(spec["givers"], part) :], rank]
            if spec["unit_digits"] is not None:
                found.append(int(np.floor(change * 10.0 ** spec["unit_digits"] + 0.5).astype(np.int64).sum()))
                measured = measured[1:]
            found += [int(x.sum()) for values in measured for x in _limbs(values, bits)]
        ranks = pa.array([b"".join(x.tobytes() for x in after)], pa.binary())
        return pa.table({"key": state["key"], "ranks": ranks, "fixed": state["fixed"], "seen": pa.array([found], pa.list_(pa.int64()))})

    return run


def _plain(stored: DataFrame) -> DataFrame:
    """A checkpointed table without the size that Spark guesses for it, the product of all sizes it came from.

    That number has twice as many digits after each step.
    """
    spark = stored.sparkSession
    rows = stored._jdf.queryExecution().logical().rdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(rows, stored._jdf.schema(), False), spark)


class PackedSteps:
    """The steps of a batch on packed edges; state is ``key, ranks, fixed``, one row per part."""

    def __init__(self, batch: Batch) -> None:
        self.batch, facts = batch, batch.layout.facts
        parts = max(batch.layout.partitions, math.ceil(facts.edges / _PART_EDGES))
        self.at = Parts(facts.nodes, parts, batch.layout.hot_ids)
        self.personal = [k for k, spec in enumerate(batch.specs) if spec.personalization is not None]
        self.edges: DataFrame | None = None

    def _dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.at.count, "key")

    def pack(self) -> None:
        """Pack the edges, one slice of targets after the other, and free what they came from.

        What is shuffled to number and place a slice is gone when the next one begins.
        """
        layout, at = self.batch.layout, self.at
        few = np.zeros((2, at.hot))
        if at.hot:
            for r in layout.facts_of_nodes.where(F.col("id") < at.hot).collect():
                few[:, r["id"]] = r["out_degree"], r["out_weight"]
        slices = max(1, min(_SLICES, math.ceil(layout.facts.edges / _PART_EDGES)))
        held = [self._held(self._packed(layout.translate(index, slices), few)) for index in range(slices)]
        layout.release_source()
        self.edges = held[0]
        if slices > 1:  # to one partition for all slices of a part
            self.edges = self._held(functools.reduce(DataFrame.unionAll, held))
            for one in held:
                one.unpersist()

    def _held(self, packed: DataFrame) -> DataFrame:
        held = self._dealt(packed).sortWithinPartitions("key").persist(StorageLevel.MEMORY_AND_DISK)
        with passing_shuffles(self.batch.spark):
            held.count()
        return held

    def _packed(self, translated: DataFrame, few: np.ndarray) -> DataFrame:
        at, kinds = self.at, {spec.weighted for spec in self.batch.specs}
        columns = ["src", "dst", *["w"] * (True in kinds)]
        rows = translated.selectExpr(*columns, f"{at.key_of_node('src')} AS key")
        if at.hot:
            hot = translated.where(F.col("src") < at.hot).groupBy("src", "dst")
            hot = hot.agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("copies"))
            hot = hot.selectExpr(*columns, f"{at.key(f'pmod(xxhash64(src, dst), {at.count})')} AS key", "copies")
            rows = rows.where(F.col("src") >= at.hot).withColumn("copies", F.lit(1).cast("long")).unionByName(hot)
        facts = self.batch.layout.facts_of_nodes.selectExpr("id", "out_degree", "out_weight", f"{at.key_of_node('id')} AS key")
        both = self._dealt(rows).groupBy("key").cogroup(self._dealt(facts).groupBy("key"))
        return both.applyInArrow(_pack(at, True in kinds, False in kinds, few[0], few[1]), _PACKED)

    def start(self, state: DataFrame) -> DataFrame:
        """The state that rows ``id, rank0, …`` mean."""
        restart = self.batch.restart
        if restart is not None:
            shares = [f"coalesce(p{k}, 0D) AS p{k}" for k in self.personal]
            state = state.join(restart, "id", "left").selectExpr(*state.columns, *shares)
        rows = self._dealt(state.withColumn("key", F.expr(self.at.key_of_node("id"))))
        run = _pack_state(self.at, len(self.batch.specs), self.personal)
        packed = rows.groupBy("key").applyInArrow(run, "key int, ranks binary, fixed binary")
        with passing_shuffles(self.batch.spark):
            return packed.checkpoint()

    def names(self, k: int) -> list[str]:
        """What is measured about a step of a set, as in ``Batch.metrics``."""
        return list(self.batch.metrics(k))

    def _hot_ranks(self, state: DataFrame) -> np.ndarray:
        """Ranks of the hot sources, by set."""
        at, sets = self.at, len(self.batch.specs)
        found = np.zeros((sets, at.hot))
        if at.hot:
            places = -(-at.hot // at.count)  # of hot sources in a part, at most
            size = f"(length(ranks) DIV {8 * sets})"
            pieces = [f"substring(ranks, {8 * k} * {size} + 1, {8 * places}) AS rank{k}" for k in range(sets)]
            for row in state.selectExpr("key", *pieces).collect():
                part = at.of_key[row["key"]]
                own = found[:, part :: at.count]
                for k in range(sets):
                    own[k] = np.frombuffer(row[f"rank{k}"])[: own.shape[1]]
        return found

    def advance(self, state: DataFrame, held: Sequence[float], active: Sequence[int]) -> tuple[DataFrame, dict]:
        """One step of the active sets, checkpointed, and its metrics: ``Batch.step`` and ``Batch.settle``."""
        batch, at = self.batch, self.at
        specs = [
            {name: getattr(spec, name) for name in ("damping", "dangling", "precision", "unit_digits")}
            | {"givers": batch.layout.givers[spec.weighted]}
            for spec in batch.specs
        ]
        kinds = [(k, batch.specs[k].weighted) for k in active]
        send = _send(at, len(specs), kinds, batch.bits, self._hot_ranks(state))
        receive = _receive(at, specs, list(active), list(held), self.personal, batch.bits)
        state = self._dealt(state)  # once for both uses
        sent = self._dealt(state.groupBy("key").cogroup(self.edges.groupBy("key")).applyInArrow(send, "key int, sums binary"))
        stepped = state.groupBy("key").cogroup(sent.groupBy("key")).applyInArrow(receive, _STEPPED)
        seen, metrics = Observation(), []
        for k in active:
            for name in self.names(k):
                unit = f" / {double(10.0 ** batch.specs[k].unit_digits)}" if name == f"delta{k}" else ""
                metrics.append(F.expr(f"sum(seen[{len(metrics)}]){unit} AS {name}"))
        kept = stepped.observe(seen, *metrics).select("key", "ranks", "fixed")
        with passing_shuffles(batch.spark):
            return _plain(kept.checkpoint()), seen.get

    def rows(self, state: DataFrame) -> DataFrame:
        """The state as rows ``id, rank0, …``."""
        sets = len(self.batch.specs)
        schema = ", ".join(["id LONG", *[f"rank{k} DOUBLE" for k in range(sets)]])
        return state.select("key", "ranks").mapInArrow(_unpack_state(self.at, sets), schema)

    def release(self) -> None:
        if self.edges is not None:
            self.edges.unpersist()
