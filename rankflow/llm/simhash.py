"""Near-duplicates by SimHash, found by a self-join of a binary trie of fingerprints.

Components are asked for, not links, so the budget of differing bits rises step by step, and what is
known to be one component is not looked at again.

First come links of 2 bits or fewer. Two fingerprints differ in at most 2 bits if and only
if some number is at most one bit away from both. So each fingerprint goes to 65 numbers, and of those
that meet at a number the smallest and the largest are linked: 65 rows a fingerprint, however dense a
group is. Hanging each on the smallest that it is linked to, a few times over, gives labels that never join
different components and leave little to do in a dense group.

Then the trie is walked for all links of 3 bits or fewer between different labels. A pair of trie nodes at one depth carries the number of
bits in which their paths differ. The join goes down node pairs together and drops a pair as
soon as the number exceeds what may still become a link, or if all that lies below both nodes has
one label. Components of the labels that are linked, either way, are components of fingerprints. With a whole budget from the root on,
nearly all node pairs of the upper levels would survive. So the trie is built in
four rotations, each beginning with another quarter of the bits. If two fingerprints
differ in at most 3 bits, then in at least one rotation the first quarter differs
in none, the first two in at most 1 and the first three in at most 2 (else every
rotation would have a prefix with more than its share, and the shares of all quarters
would sum to more than 3). These are the budgets of the traversal.

A node pair is expanded from those children of either node that are not all of the pair's greatest
component; of two children that are still needed at least one is such. It meets the other node's children
if these are few, else it looks up, by an equi-join, the paths within the remaining budget: at most
697 rows for a child and node pair, and the pairs of all members of a group are never made. In a dense group, whose
members are one component but for some, only the some ask.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import join_hot, raw_texts, slices, store
from rankflow.llm.components import components

SHINGLE = 3
BITS, QUARTERS = 64, 4
STEP = BITS // QUARTERS
#: Times that labels are replaced by the labels of their labels.
JUMPS = 3
#: Differing bits allowed in the first 1, 2, 3 and 4 quarters of a rotation.
BUDGET = (0, 1, 2, 3)


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text: a bit is set if it is in over half the hashes."""
    found = text.lower().split()
    if not found:
        return 0
    line = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    if len(found) <= size:
        hashes = [xxhash.xxh64_intdigest(line, 42)]
    else:
        begins = [0, *(ends[:-size] + 1).tolist()]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], 42) for a, b in zip(begins, ends[size - 1 :].tolist(), strict=True)]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8), bitorder="little")
    counts = bits.reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            found = np.array([fingerprint(t) for t in raw_texts(part["text"])], dtype=np.uint64)
            ids = part["doc_id"].cast(pa.int64())
            own = {c: part[c] for c in part.schema.names if c not in ("doc_id", "text")}
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "fp": pa.array(found.view(np.int64)), **own})
    pa.default_memory_pool().release_unused()  # a worker that waits for its next task keeps little


def _rotated(fp: Column, quarter: int) -> Column:
    left = STEP * (quarter % QUARTERS)
    return F.shiftleft(fp, left).bitwiseOR(F.shiftrightunsigned(fp, BITS - left)) if left else fp


def _masks(budget: int) -> list[int]:
    """All masks of one quarter with at most ``budget`` bits."""
    return [sum(1 << b for b in bits) for k in range(budget + 1) for bits in combinations(range(STEP), k)]


def _by_rest(budget: int, value: Callable[[int], Column]) -> Column:
    """``value`` of what the budget leaves, by the number of bits that differ already."""
    chosen = F.when(F.col("diff") == budget, value(0))
    for diff in range(budget - 1, -1, -1):
        chosen = chosen.when(F.col("diff") == diff, value(budget - diff))
    return chosen


def _spot_links(prints: DataFrame) -> DataFrame:
    """Stored pairs a < b of the distinct fingerprints in column fp that differ in 2 bits or fewer; not all."""
    spots = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.expr(f"shiftleft(1L, {i})")) for i in range(BITS)])
    met = prints.select("fp", F.explode(spots).alias("spot")).groupBy("spot")
    pairs = met.agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a < b")
    return store(pairs.select("a", "b").distinct())


def _labels(links: DataFrame) -> DataFrame:
    """Stored fp, comp for the larger ends of links a < b: a smaller fingerprint of the same component."""
    hung = links.groupBy(F.col("b").alias("fp")).agg(F.min("a").alias("comp"))
    for _ in range(JUMPS):
        above = hung.select(F.col("fp").alias("comp"), F.col("comp").alias("next"))
        hung = hung.join(above, "comp", "left").select("fp", F.coalesce("next", "comp").alias("comp"))
    return store(hung)


def _named(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of fingerprints (a, b) as pairs a < b of their labels."""
    for end in ("a", "b"):
        own = labels.select(F.col("fp").alias(end), "comp")
        pairs = pairs.join(own, end, "left").withColumn(end, F.coalesce("comp", end)).drop("comp")
    return pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _nodes(trie: DataFrame, depth: int) -> DataFrame:
    """The nodes of a depth: parent, path, the one component below (else null), and the greatest one."""
    parent, path = F.col(f"p{depth - 1}").alias("parent"), F.col(f"p{depth}").alias("path")
    facts = trie.groupBy("quarter", parent, path).agg(
        F.min("comp").alias("least"), F.max("comp").alias("most"), F.max(F.struct("size", "comp")).alias("great")
    )
    return facts.select("quarter", "parent", "path", F.when(F.col("least") == F.col("most"), F.col("least")).alias("only"), "great")


def _asking(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """quarter, q, c, …: each child c that needs to be compared with the children of q, and how many these are."""
    # either node's children ask the other's
    turned = pairs.where("p != q").select("quarter", F.col("q").alias("p"), F.col("p").alias("q"), "diff", "great")
    child = nodes.select("quarter", F.col("parent").alias("p"), F.col("path").alias("c"), "only", F.col("great").alias("c_great"))
    asking = pairs.unionByName(turned).join(child, ["quarter", "p"])
    asking = asking.where(F.col("only").isNull() | (F.col("only") != F.col("great.comp")))
    kids = nodes.groupBy("quarter", F.col("parent").alias("q")).agg(F.count("*").alias("kids"))
    return asking.join(kids, ["quarter", "q"]).select("quarter", "q", "c", "only", "c_great", "diff", "kids")


def _compared(pairs: DataFrame, nodes: DataFrame, budget: int) -> DataFrame:
    """Children c and d of node pairs (quarter, p <= q, diff, great), with the bits that differ so far."""
    low = F.lit((1 << STEP) - 1).cast("long")
    found = nodes.select(
        "quarter", "parent", F.col("path").alias("d"), F.col("only").alias("d_only"), F.col("great").alias("d_great")
    )
    asking = store(_asking(pairs, nodes))
    few = F.col("kids") <= _by_rest(budget, lambda rest: F.lit(len(_masks(rest))))
    own = ("quarter", "c", "only", "c_great")
    all_kids = asking.where(few).join(found.withColumnRenamed("parent", "q"), ["quarter", "q"])
    bits = F.col("diff") + F.bit_count(F.col("c").bitwiseXOR(F.col("d")).bitwiseAND(low))
    all_kids = all_kids.select(*own, "d", "d_only", "d_great", bits.alias("diff")).where(F.col("diff") <= budget)
    steps = _by_rest(budget, lambda rest: F.expr(f"array({', '.join(f'{m}L' for m in _masks(rest))})"))
    tried = asking.where(~few).select(*own, "q", "diff", F.explode(steps).alias("mask"))
    path = F.shiftleft("q", STEP).bitwiseOR(F.col("c").bitwiseAND(low).bitwiseXOR(F.col("mask")))
    tried = tried.select(*own, path.alias("d"), (F.col("diff") + F.bit_count("mask")).alias("diff"))
    looked_up = tried.join(found.drop("parent"), ["quarter", "d"])
    return all_kids.unionByName(looked_up)


def _descend(pairs: DataFrame, nodes: DataFrame, budget: int) -> DataFrame:
    """From node pairs (quarter, p <= q, diff, great) to the pairs of their children within the budget."""
    met = _compared(pairs, nodes, budget)
    met = met.where(F.col("only").isNull() | F.col("d_only").isNull() | (F.col("only") != F.col("d_only")))
    ends = (F.least("c", "d").alias("p"), F.greatest("c", "d").alias("q"))
    return store(met.select("quarter", *ends, "diff", F.greatest("c_great", "d_great").alias("great")).distinct())


def _walked(contracted: DataFrame) -> DataFrame:
    """All pairs a, b of fingerprints with different labels (of fp, comp) that differ in 3 bits or fewer."""
    sizes = contracted.groupBy("comp").agg(F.count("*").alias("size"))
    turns = []
    for quarter in range(QUARTERS):
        key = _rotated(F.col("fp"), quarter)
        paths = [F.shiftrightunsigned(key, BITS - STEP * d).alias(f"p{d}") for d in range(1, QUARTERS)]
        turns.append(F.struct(F.lit(quarter).alias("quarter"), *paths, key.alias(f"p{QUARTERS}")))
    trie = contracted.join(sizes, "comp").select("comp", "size", F.explode(F.array(*turns)).alias("t"))
    trie = store(trie.select("comp", "size", "t.*"))
    # the first quarter has no budget: there a node is paired with itself alone
    top = trie.groupBy("quarter", F.col("p1").alias("p")).agg(
        F.min("comp").alias("least"), F.max("comp").alias("most"), F.max(F.struct("size", "comp")).alias("great")
    )
    pairs = top.where("least < most").select("quarter", "p", F.col("p").alias("q"), F.lit(0).alias("diff"), "great")
    for depth in range(2, QUARTERS + 1):
        pairs = _descend(pairs, _nodes(trie, depth), BUDGET[depth - 1])
    ends = []
    for end in ("p", "q"):
        back = F.lit(None).cast("long")
        for quarter in range(QUARTERS):
            back = F.when(F.col("quarter") == quarter, _rotated(F.col(end), QUARTERS - quarter)).otherwise(back)
        ends.append(back.alias(end))
    return pairs.select(*ends).toDF("a", "b")


def linked(prints: DataFrame) -> DataFrame:
    """fp, comp: components of the distinct fingerprints in column fp over links of 3 bits or fewer."""
    close = _spot_links(prints)
    labels = _labels(close)
    labelled = store(prints.join(labels, "fp", "left").select("fp", F.coalesce("comp", "fp").alias("comp")))
    edges = store(_named(close.unionByName(_walked(labelled)), labels).distinct())
    names = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    joined = components(edges, names.select("node", F.col("node").alias("lead")))
    known = labelled.join(joined.withColumnRenamed("node", "comp"), "comp", "left")
    return known.select("fp", F.coalesce("component_id", "comp").alias("comp"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Fingerprint and component of every row of ``docs`` (doc_id, text, any others).

    Returns doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id
    among all documents reachable over links of 3 differing bits or fewer. A text
    without words, empty and null alike, has fingerprint 0 and is linked like any other.
    Repeated rows are kept; null ids count as larger than any other; an empty table
    gives no rows.
    """
    prints = store(docs.select("doc_id", "text").mapInArrow(_fingerprints, "doc_id long, fp long"))
    distinct = store(prints.groupBy("fp").agg(F.min("doc_id").alias("lead"), F.count("*").alias("copies")))
    members = distinct.join(linked(distinct.select("fp")), "fp")
    leads = members.groupBy("comp").agg(F.min("lead").alias("component_id"))
    found = members.join(leads, "comp").select("fp", "copies", "component_id")
    return join_hot(prints, found, "fp", "copies", prints.count()).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, key: str) -> DataFrame:
    """One row of each component of ``docs`` (doc_id, text and a string column ``key``), whatever the ids.

    Returns the key of the row with the smallest doc_id, null ids last, then the smallest
    key, and n_rows, how many rows have this key.
    """
    prints = store(docs.select("doc_id", "text", key).mapInArrow(_fingerprints, f"doc_id long, fp long, {key} string"))
    own = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.col(key).alias("key"))
    # a fingerprint's first row stands for it, so that only one row of each goes on
    lead = store(prints.groupBy("fp").agg(F.min(own).alias("lead")))
    joined = lead.join(linked(lead.select("fp")), "fp").groupBy("comp").agg(F.min("lead").alias("lead"))
    chosen = store(joined.select(F.col("lead.key").alias(key)))
    return prints.groupBy(key).agg(F.count("*").alias("n_rows")).join(chosen, key, "left_semi")
