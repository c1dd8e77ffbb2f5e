"""Hard negatives by a secondary sort: packed pair keys, sorted partitions, a streaming reader.

Scores are computed block by block. What can matter for an anchor is packed into keys
(anchor, descending score, kind, id), moved to the anchor's partition and sorted there. A
reader passes over each partition once: a positive opens a window of scores below its own, a
negative goes to every open window, a window closes when it is full or the scores fall below
it. Nothing of an anchor is held but its open windows, POSITIVES at most.

Not all pairs are moved. A first pass leaves the best same-label rows of each block, which
hold the best of all; a second one, knowing the anchor's windows, leaves the first negatives
of each window in each block, which hold the first of all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm import vectors
from rankflow.llm.common import cut

POSITIVES, NEGATIVES = 5, 5
#: A negative's score is at least this part of the positive's, in hundredths, and at most all of it.
LEAST, WHOLE = 80, 100

_PAIR = "anchor_row long, anchor_id long, vec_id long, score long"
_TRIPLE = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def lower_end(score: int, least: int) -> int:
    """The smallest whole score of a positive's window."""
    return -((-score * least) // WHOLE)


def _laid(table: pa.Table, width: int) -> dict:
    key, lost = vectors.ids(table)
    numbers = {c: np.asarray(table[c], dtype=np.int64) for c in ("row", "label")}
    return {"ints": vectors.matrix(table["v"].to_pylist(), width), "key": key, "lost": lost, **numbers}


def _pairs(a: dict, found: list[tuple]) -> pa.Table:
    owner, score, key, lost = (np.concatenate(p) for p in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 4
    anchor_ids = pa.array(a["key"][owner], pa.int64(), mask=a["lost"][owner])
    columns = [pa.array(a["row"][owner]), anchor_ids, pa.array(key, pa.int64(), mask=lost.astype(bool)), pa.array(score)]
    return pa.table(columns, names=["anchor_row", "anchor_id", "vec_id", "score"])


def _kept(held: tuple | None, new: tuple, most: int) -> tuple:
    owner, score, key, lost = (np.concatenate(p) for p in zip(held, new, strict=True)) if held else new
    at = vectors.leading(owner, score, key, lost, most)
    return owner[at], score[at], key[at], lost[at]


def same_label(rows: pa.Table, payloads: list, width: int, longest: int, most: int) -> pa.Table:
    """The best rows of an anchor's own label in a group."""
    a, held = _laid(rows, width), None
    for payload in payloads:
        c = _laid(vectors.read([payload]), width)
        i, j = np.nonzero((a["label"][:, None] == c["label"]) & (a["row"][:, None] != c["row"]))
        score = vectors.products(a["ints"], c["ints"], longest)[i, j]
        held = _kept(held, (i, score, c["key"][j], c["lost"][j]), most)
    return _pairs(a, [held] if held else [])


def other_labels(rows: pa.Table, payloads: list, width: int, longest: int, least: int, most: int) -> pa.Table:
    """The first negatives in a group of each of an anchor's windows, each row once."""
    a = _laid(rows, width)
    scores = [sorted(set(s), reverse=True) for s in rows["windows"].to_pylist()]
    # the k-th window of every anchor that has one: who, from, to
    windows = []
    for k in range(max(map(len, scores), default=0)):
        who = [i for i, s in enumerate(scores) if len(s) > k]
        top = [scores[i][k] for i in who]
        windows.append((np.array(who), np.array([lower_end(s, least) for s in top])[:, None], np.array(top)[:, None]))
    held: list[tuple | None] = [None] * len(windows)
    for payload in payloads:
        c = _laid(vectors.read([payload]), width)
        all_scores = vectors.products(a["ints"], c["ints"], longest)
        other = a["label"][:, None] != c["label"]
        for k, (who, low, high) in enumerate(windows):
            here = all_scores[who]
            i, j = np.nonzero(other[who] & (here >= low) & (here <= high))
            # a row number goes along as a last key, so that one row found by two windows is known
            new = (who[i], here[i, j], c["key"][j], c["lost"][j], c["row"][j])
            if held[k]:
                new = tuple(np.concatenate(p) for p in zip(held[k], new, strict=True))
            at = vectors.leading(*new[:4], most)
            held[k] = tuple(x[at] for x in new)
    found = [h for h in held if h]
    if not found:
        return _pairs(a, [])
    owner, score, key, lost, row = (np.concatenate(p) for p in zip(*found, strict=True))
    once = np.unique(np.stack([owner, row]), axis=1, return_index=True)[1]
    return _pairs(a, [(owner[once], score[once], key[once], lost[once])])


def _stream(batches: Iterator[pa.RecordBatch], least: int, most: int) -> Iterator[pa.RecordBatch]:
    """Triples from keys sorted by anchor, descending score, kind and id."""
    anchor, windows = None, []
    for batch in batches:
        out = []
        for row, own, score, negative, vec in zip(*(batch[c].to_pylist() for c in _KEYS), strict=True):
            if row != anchor:
                anchor, windows = row, []
            if not negative:
                windows.append([vec, score, lower_end(score, least), 0])
                continue
            for window in windows:
                if score >= window[2] and window[3] < most:
                    window[3] += 1
                    out.append((own, window[0], window[3], vec, window[1], score))
            windows = [w for w in windows if score >= w[2] and w[3] < most]
        columns = list(zip(*out, strict=True)) or [()] * len(_NAMES)
        arrays = [pa.array(c, pa.int32() if n == "rank" else pa.int64()) for n, c in zip(_NAMES, columns, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, _NAMES)


_KEYS = ["anchor_row", "anchor_id", "score", "negative", "vec_id"]
_NAMES = [x.split()[0] for x in _TRIPLE.split(", ")]


def mine(
    embeddings: DataFrame,
    is_anchor: str,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    chunk_rows: int = vectors.CHUNK_ROWS,
    group_rows: int = vectors.GROUP_ROWS,
    page_rows: int = vectors.PAGE_ROWS,
) -> DataFrame:
    """For each anchor and each of its first positives the first negatives in the positive's window.

    ``embeddings``: vec_id, embedding, label, any others; ``is_anchor``: SQL text of the
    condition that makes a row an anchor. Components become floor(256 * x), scores are inner
    products with the anchor; higher scores come first, ties by smaller vec_id. Positives are
    the first other rows of the anchor's label; a negative has another label and a score of
    ``least`` hundredths of the positive's score up to all of it. Returns anchor_id,
    positive_id, rank (from 1 for each positive), negative_id, positive_score, negative_score.

    Rows with a null label, a null vector or a null or non-finite component take no part.
    Rows with equal ids are rows of their own; null ids come last in ties. Positives with a
    score below 0 have no negatives, as their window is empty. An empty table gives no
    rows. A vector with a squared length of 2**63 or more raises ValueError.
    """
    spark = embeddings.sparkSession
    rows, facts = vectors.integers(embeddings.where("label IS NOT NULL"), ("label",))
    tasks = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    anchors = rows.where(is_anchor)
    chunks = vectors.part_count(anchors.count(), chunk_rows, chunk_rows // 8, tasks)
    groups = vectors.part_count(facts.rows, group_rows, group_rows // 16, tasks)
    width, longest = facts.width, facts.longest
    everything = vectors.pages(rows, groups, min(page_rows, group_rows))

    near = vectors.grid(
        vectors.pages(anchors, chunks, min(page_rows, chunk_rows)),
        everything,
        chunks,
        groups,
        lambda a, b: same_label(a, b, width, longest, positives),
        _PAIR,
    )
    place = F.row_number().over(Window.partitionBy("anchor_row").orderBy(*vectors.ordered()))
    near = cut(near.withColumn("place", place).where(F.col("place") <= positives).drop("place"))
    windows = near.groupBy(F.col("anchor_row").alias("row")).agg(F.collect_list("score").alias("windows"))
    far = vectors.grid(
        vectors.pages(anchors.join(windows, "row"), chunks, min(page_rows, chunk_rows)),
        everything,
        chunks,
        groups,
        lambda a, b: other_labels(a, b, width, longest, least, negatives),
        _PAIR,
    )
    packed = near.withColumn("negative", F.lit(False)).unionByName(far.withColumn("negative", F.lit(True)))
    packed = packed.repartition("anchor_row").sortWithinPartitions(
        "anchor_row", F.desc("score"), "negative", F.asc_nulls_last("vec_id")
    )
    return packed.select(*_KEYS).mapInArrow(lambda batches: _stream(batches, least, negatives), _TRIPLE)
