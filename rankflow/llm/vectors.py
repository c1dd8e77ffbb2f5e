"""Embeddings as exact integer vectors, packed into pages that meet in a grid.

A stated set of query rows is compared with all rows block by block: queries are dealt
to chunks, all rows to groups, and one task sees one chunk and one group. Rows travel as
pages (a few hundred vectors in one Arrow message), so the grid repeats pages, not rows.
Sizes of chunks and groups are bounded; their numbers grow with the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import cut, sums_by_row

SCALE = 256
#: Rows in a page, and at most in a chunk of queries and in a group of rows.
PAGE_ROWS, CHUNK_ROWS, GROUP_ROWS = 512, 8_192, 65_536
#: The largest whole numbers that doubles and longs add without error.
EXACT_DOUBLE, EXACT_LONG = 1 << 53, 1 << 63
NO_ID = (1 << 63) - 1


@dataclass(frozen=True)
class Facts:
    """What must be known of a table of integer vectors before it is packed."""

    rows: int
    width: int  # components of the longest vector; shorter ones count as filled with 0
    longest: int  # largest squared length


def _floors(batches: Iterator[pa.RecordBatch], keep: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch["embedding"]
        sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0), dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        parts = np.asarray(lists.flatten().cast(pa.float64()).fill_null(np.nan), dtype=np.float64)
        whole = np.isfinite(parts)
        ok = np.asarray(lists.is_valid()) & (sums_by_row((~whole).astype(np.int64), offsets) == 0)
        with np.errstate(over="ignore", invalid="ignore"):
            floors = np.floor(np.where(whole, parts, 0.0) * SCALE)
            lengths = np.array([float(np.dot(floors[a:b], floors[a:b])) for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
        if (lengths[ok] >= EXACT_LONG).any():
            raise ValueError("a vector is so long that its scores pass 64 bits")
        ints = np.where(np.abs(floors) < EXACT_LONG, floors, 0).astype(np.int64)
        at = np.flatnonzero(ok)
        blobs = [ints[offsets[i] : offsets[i + 1]].tobytes() for i in at]
        squares = [int(np.dot(ints[offsets[i] : offsets[i + 1]], ints[offsets[i] : offsets[i + 1]])) for i in at]
        columns = {c: batch[c].take(pa.array(at, pa.int64())) for c in ("vec_id", *keep)}
        yield pa.RecordBatch.from_pydict(
            {**columns, "length2": pa.array(squares, pa.int64()), "v": pa.array(blobs, pa.binary())}
        )


def integers(embeddings: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, Facts]:
    """Stored rows (row, vec_id, *keep, length2, v) with components floor(256 * x), and their facts.

    Vectors that are null or hold null or non-finite components are left out. ``row`` tells
    rows with the same id apart; ``v`` holds 64-bit integers. ``keep``: long columns.
    """
    names = ", ".join(["vec_id long", *[f"{c} long" for c in keep], "length2 long", "v binary"])
    columns = [F.col("vec_id").cast("long").alias("vec_id"), "embedding", *[F.col(c).cast("long").alias(c) for c in keep]]
    floors = embeddings.select(*columns).mapInArrow(lambda batches: _floors(batches, list(keep)), names)
    rows = cut(floors.withColumn("row", F.monotonically_increasing_id()))
    seen = rows.agg(F.count("*").alias("n"), F.max(F.length("v")).alias("w"), F.max("length2").alias("l")).first()
    return rows, Facts(seen["n"], (seen["w"] or 0) // 8, seen["l"] or 0)


def matrix(blobs: list[bytes], width: int) -> np.ndarray:
    """Integer vectors as rows of a matrix, filled with 0."""
    return np.frombuffer(b"".join(x.ljust(width * 8, b"\0") for x in blobs), "<i8").reshape(len(blobs), width)


def _pack(batches: Iterator[pa.RecordBatch], size: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Pages of ``size`` rows in the order of arrival, dealt in turn to ``parts``."""
    turn = TaskContext.get().partitionId()

    def page(rows: list[pa.RecordBatch], part: int) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        return pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "page": pa.array([sink.getvalue().to_pybytes()], pa.binary())}
        )

    held, count = [], 0
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            piece = batch.slice(start, size - count)
            # a slice written as such would carry the whole batch along
            held += pa.Table.from_batches([piece]).take(pa.array(np.arange(piece.num_rows))).to_batches()
            start, count = start + piece.num_rows, count + piece.num_rows
            if count == size:
                yield page(held, turn % parts)
                held, count, turn = [], 0, turn + 1
    if held:
        yield page(held, turn % parts)


def pages(rows: DataFrame, parts: int, size: int = PAGE_ROWS) -> DataFrame:
    """Stored pages (part, page) of the rows of each partition, dealt to ``parts`` in turn."""
    return cut(rows.mapInArrow(lambda batches: _pack(batches, size, parts), "part int, page binary"))


def part_count(rows: int, most: int, least: int, tasks: int) -> int:
    """Parts of at most ``most`` rows; up to ``tasks`` smaller ones as long as they have ``least`` rows."""
    return max(1, -(-rows // most), min(tasks, rows // least))


def read(payloads: list) -> pa.Table:
    """The rows of several pages."""
    return pa.concat_tables([pa.ipc.open_stream(p.as_buffer()).read_all() for p in payloads]).combine_chunks()


def grid(
    left: DataFrame, right: DataFrame, chunks: int, groups: int, work: Callable[[pa.Table, list], pa.Table], schema: str
) -> DataFrame:
    """Rows of ``work`` for every chunk of the left pages and every group of the right pages.

    ``work`` gets the rows of the chunk and the pages of the group.
    """

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not a.num_rows or not b.num_rows:
            return empty
        return work(read(list(a["page"])), list(b["page"])).cast(empty.schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    empty = to_arrow_schema(StructType.fromDDL(schema)).empty_table()
    a = left.select(F.col("part").alias("chunk"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), "page")
    b = right.select(F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.col("part").alias("grp"), "page")
    return a.groupBy("chunk", "grp").cogroup(b.groupBy("chunk", "grp")).applyInArrow(run, schema)


def products(a: np.ndarray, b: np.ndarray, longest: int) -> np.ndarray:
    """Exact inner products of all rows: as doubles while these add whole numbers without error."""
    if longest < EXACT_DOUBLE:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The ids of a page and whether they are null; null counts as larger than any other."""
    column = table["vec_id"].combine_chunks()
    return np.asarray(column.fill_null(NO_ID), dtype=np.int64), np.asarray(column.is_null())


def leading(owner: np.ndarray, score: np.ndarray, key: np.ndarray, lost: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` of each owner: highest score, then smallest key, null keys last."""
    order = np.lexsort((lost, key, -score, owner))
    held = owner[order]
    first = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]])) if len(held) else np.zeros(0, np.int64)
    rank = np.arange(len(held)) - np.repeat(first, np.diff(np.concatenate([first, [len(held)]])))
    return order[rank < most]


def ordered(key: str = "vec_id") -> list[Column]:
    """Highest score first, ties by smaller id, null ids last."""
    return [F.desc("score"), F.asc_nulls_last(key)]
