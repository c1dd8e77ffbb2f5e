"""Exact top-k by inner product: descending lengths, rotated partial sums, residual bounds.

All vectors are packed into pages by descending length. A query meets the pages of a group
from the longest on; by Cauchy-Schwarz no score exceeds the product of two lengths, so a
query leaves as soon as that product of its length and a page's greatest falls below its
k-th best score. Within a page the vectors are rotated by the right singular vectors of a
sample, which moves most of the inner product into the first components: a partial sum over
these plus the product of the lengths of what remains bounds the score from above, and only
pairs whose bound reaches the k-th best score are multiplied out, in whole numbers. A rotation
changes no inner product, so the sample (ROTATION_ROWS rows) decides speed alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm import vectors

#: Rows from which the rotation is read, and longest rows that give each query its first threshold.
ROTATION_ROWS, HEAD_ROWS = 4_096, 1_024
#: Shares of the components after which partial sums are compared with the threshold.
STAGES = (0.25, 0.5)
#: Beyond this share of surviving pairs a page is multiplied as a whole.
DENSE = 0.05
#: Rounding of the bounds, relative to the product of the lengths.
SLACK = 1e-9

_FOUND = "query_row long, query_id long, vec_id long, score long"


def rotation(sample: np.ndarray, width: int) -> np.ndarray:
    """Orthonormal columns, the directions with most of the sample's length first."""
    if not len(sample) or not width:
        return np.eye(width)
    return np.linalg.svd(sample.astype(np.float64), full_matrices=True)[2].T if len(sample) >= width else np.eye(width)


class Pool:
    """The best pairs so far of the queries of a chunk."""

    def __init__(self, queries: int, k: int):
        self.k, self.size = k, queries
        self.owner = self.score = self.key = np.zeros(0, np.int64)
        self.lost = np.zeros(0, bool)

    def add(self, owner, score, key, lost) -> None:
        parts = zip((self.owner, self.score, self.key, self.lost), (owner, score, key, lost), strict=True)
        owner, score, key, lost = (np.concatenate(p) for p in parts)
        at = vectors.leading(owner, score, key, lost, self.k)
        self.owner, self.score, self.key, self.lost = owner[at], score[at], key[at], lost[at]

    def thresholds(self) -> np.ndarray:
        """The k-th best score of each query; the least long where there are fewer."""
        found = np.bincount(self.owner, minlength=self.size)
        least = np.full(self.size, np.iinfo(np.int64).min)
        last = np.cumsum(found) - 1
        full = found >= self.k
        least[full] = self.score[last[full]]
        return least


def _survivors(q: dict, c: dict, live: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Which pairs of live queries and page rows can still reach the threshold."""
    width = q["turned"].shape[1]
    slack = SLACK * q["length"][live] * c["length"].max(initial=0.0) + 1e-6
    floor = (least[live].astype(np.float64) - slack)[:, None]
    alive = q["length"][live][:, None] * c["length"][None, :] >= floor
    sums, done = np.zeros(alive.shape), 0
    for share in STAGES:
        stop = int(width * share)
        if stop <= done or not alive.any():
            continue
        sums += q["turned"][live, done:stop] @ c["turned"][:, done:stop].T
        rest = np.sqrt((q["turned"][live, stop:] ** 2).sum(1))[:, None] * np.sqrt((c["turned"][:, stop:] ** 2).sum(1))
        alive &= sums + rest >= floor
        done = stop
    return alive


def search(rows: pa.Table, payloads: list, k: int, turn: np.ndarray, head: pa.Table, longest: int) -> pa.Table:
    """The k best of a group's pages for each query of a chunk."""
    width = len(turn)

    def laid(table: pa.Table) -> dict:
        ints = vectors.matrix(table["v"].to_pylist(), width)
        turned = ints.astype(np.float64) @ turn
        key, lost = vectors.ids(table)
        lengths = np.sqrt(np.asarray(table["length2"], dtype=np.float64))
        return {"ints": ints, "turned": turned, "length": lengths, "row": np.asarray(table["row"]), "key": key, "lost": lost}

    q = laid(rows)
    first = vectors.products(q["ints"], vectors.matrix(head["v"].to_pylist(), width), longest)
    own = q["row"][:, None] == np.asarray(head["row"])[None, :]
    first = np.where(own, np.iinfo(np.int64).min, first)
    start = np.full(len(q["row"]), np.iinfo(np.int64).min)
    if first.shape[1] > k:  # at least k rows besides the query's own
        start = np.sort(first, axis=1)[:, -k]
    pool = Pool(len(start), k)
    for c in sorted((laid(vectors.read([p])) for p in payloads), key=lambda c: -c["length"].max(initial=0.0)):
        least = np.maximum(start, pool.thresholds())
        reach = q["length"] * c["length"].max(initial=0.0) * (1 + SLACK) + 1e-6
        live = np.flatnonzero(reach >= least)
        if not len(live):
            break
        alive = _survivors(q, c, live, least) & (q["row"][live][:, None] != c["row"][None, :])
        i, j = np.nonzero(alive)
        if alive.mean() > DENSE:
            score = vectors.products(q["ints"][live], c["ints"], longest)[i, j]
        else:
            score = np.einsum("nd,nd->n", q["ints"][live[i]], c["ints"][j])
        good = score >= least[live[i]]
        i, j, score = i[good], j[good], score[good]
        pool.add(live[i], score, c["key"][j], c["lost"][j])
    names = ("query_row", "query_id", "vec_id", "score")
    query_ids = pa.array(q["key"][pool.owner], pa.int64(), mask=q["lost"][pool.owner])
    found = pa.array(pool.key, pa.int64(), mask=pool.lost)
    return pa.table([pa.array(q["row"][pool.owner]), query_ids, found, pa.array(pool.score)], names=names)


def top_k(
    embeddings: DataFrame,
    is_query: str,
    k: int = 5,
    chunk_rows: int = vectors.CHUNK_ROWS,
    group_rows: int = vectors.GROUP_ROWS,
    page_rows: int = vectors.PAGE_ROWS,
) -> DataFrame:
    """The k highest scores of every query row over all other rows, ties to smaller vec_id.

    ``embeddings``: vec_id, embedding (an array of numbers), any others; ``is_query``: SQL
    text of the condition that makes a row a query. Components become floor(256 * x);
    the score is the inner product of these whole numbers. Returns query_id, rank (from 1),
    vec_id, score; a query with fewer than k other rows has fewer.

    Vectors that are null or hold null or non-finite components take no part. Of vectors of
    different widths the shorter counts as filled with 0; empty vectors score 0. Rows with
    equal ids are rows of their own: each is compared with the others, none with itself.
    Null ids are candidates, after all others in ties. Equal scores and ids are
    interchangeable. An empty table gives no rows. A vector with a squared length of 2**63 or
    more raises ValueError, because scores are longs.
    """
    spark = embeddings.sparkSession
    rows, facts = vectors.integers(embeddings)
    tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    queries = rows.where(is_query)
    chunks = vectors.part_count(queries.count(), chunk_rows, chunk_rows // 8, tasks)
    groups = vectors.part_count(facts.rows, group_rows, group_rows // 16, tasks)
    # equal lengths are spread by their row, so that no range holds all copies of one vector
    by_length = [F.desc("length2"), F.asc(F.xxhash64("row"))]
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(ROTATION_ROWS).select("v").toArrow()
    turn = rotation(vectors.matrix(sample["v"].to_pylist(), facts.width), facts.width)
    head = rows.orderBy(*by_length, "row").limit(HEAD_ROWS).select("row", "v").toArrow()
    parts = max(1, min(tasks, -(-facts.rows // page_rows)))
    ranged = rows.repartitionByRange(parts, *by_length).sortWithinPartitions(*by_length)
    found = vectors.grid(
        vectors.pages(queries, chunks, min(page_rows, chunk_rows)),
        vectors.pages(ranged, groups, min(page_rows, group_rows)),
        chunks,
        groups,
        lambda a, b: search(a, b, k, turn, head, facts.longest),
        _FOUND,
    )
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(*vectors.ordered()))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
