"""Sharding by minimax contiguous partition.

Groups of equal texts are atomic. They are ordered by their bytes, largest first,
then by the digest of the text, and cut into contiguous shards. The smallest
capacity that a given number of shards can hold is found by binary search, each
candidate checked greedily; the first shard is cut there, and the same is done for
what is left with one shard less, so one giant group does not leave others uneven.

The driver sees only how many groups there are of each size. A corpus of T bytes
holds at most sqrt(2 T) different sizes, so that histogram stays small, and it is
all that search and greedy check need: groups of one size are interchangeable.
"""

from __future__ import annotations

import bisect
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import cut, join_hot

#: Rows that one task numbers at a time.
RUN_ROWS = 20_000


class Sizes:
    """Sizes in falling order with their multiplicities, addressed by group position."""

    def __init__(self, histogram: list[tuple[int, int]]):
        runs = sorted(histogram, reverse=True)
        self.size = [s for s, _ in runs]
        self.first = [0, *accumulate(n for _, n in runs)]
        self.before = [0, *accumulate(s * n for s, n in runs)]
        self.groups, self.total = self.first[-1], self.before[-1]

    def weight_before(self, at: int) -> int:
        if at >= self.groups:
            return self.total
        run = bisect.bisect_right(self.first, at) - 1
        return self.before[run] + (at - self.first[run]) * self.size[run]

    def fill(self, at: int, capacity: int) -> int:
        """The position after the last group that still fits, from ``at`` on."""
        goal = self.weight_before(at) + capacity
        if goal >= self.total:
            return self.groups
        run = bisect.bisect_right(self.before, goal) - 1
        return max(at, self.first[run] + (goal - self.before[run]) // self.size[run])

    def fits(self, at: int, shards: int, capacity: int) -> bool:
        for _ in range(shards):
            at = self.fill(at, capacity)
            if at >= self.groups:
                return True
        return False

    def capacity(self, at: int, shards: int) -> int:
        """The smallest capacity with which ``shards`` shards hold all groups from ``at`` on."""
        rest = self.total - self.weight_before(at)
        largest = self.size[bisect.bisect_right(self.first, at) - 1]
        low = max(largest, -(-rest // shards))
        high = low + largest
        while low < high:
            middle = (low + high) // 2
            if self.fits(at, shards, middle):
                high = middle
            else:
                low = middle + 1
        return low

    def cuts(self, shards: int) -> list[tuple[int, int]]:
        """Where shards 1, 2, … begin: the size there and the rank among groups of that size."""
        at, found = 0, []
        for left in range(shards, 1, -1):
            if at >= self.groups:
                break
            at = self.fill(at, self.capacity(at, left))
            if at < self.groups:
                run = bisect.bisect_right(self.first, at) - 1
                found.append((self.size[run], at - self.first[run]))
        return found


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Assign every row of ``docs`` (doc_id, text, any others) to a shard and a slot in it.

    Returns doc_id, size, text_crc32, law ('bytes'), shard, slot, grown_shard (null).
    Size is the UTF-8 bytes of the text plus 1; a null text has no bytes. Null texts
    form one group, apart from empty ones. Repeated rows share a shard and get slots
    of their own; with fewer groups than shards the last shards stay empty; an empty
    table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = cut(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("null")).alias("digest"),
        )
    )
    groups = cut(
        rows.groupBy("digest", "size")
        .agg(F.count("*").alias("copies"))
        .withColumn("bytes", F.col("size") * F.col("copies"))
        .drop("size")
    )
    histogram = groups.groupBy("bytes").agg(F.count("*").alias("n"), F.sum("copies").alias("rows"))
    seen = histogram.collect()
    total = sum(r["rows"] for r in seen)
    begins = Sizes([(r["bytes"], r["n"]) for r in seen]).cuts(shards) if seen else []
    placed = _ranked(groups, sorted({size for size, _ in begins}))
    shard = F.lit(0)
    for size, rank in begins:
        after = (F.col("bytes") < size) | ((F.col("bytes") == size) & (F.col("rank") >= rank))
        shard = shard + after.cast("int")
    placed = placed.select("digest", "copies", shard.cast("int").alias("shard"))
    return _slots(join_hot(rows, placed, "digest", "copies", total), total, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _ranked(groups: DataFrame, sizes: list[int]) -> DataFrame:
    """Ranks by digest among groups of one size, only for the few sizes that a cut divides.

    A rank is the number of groups in earlier buckets of digests plus the rank in the
    own bucket, so that many groups of one size are counted by many tasks.
    """
    inside = F.col("bytes").isin(sizes) if sizes else F.lit(False)
    rest = groups.where(~inside).withColumn("rank", F.lit(0).cast("long"))
    divided = groups.where(inside).withColumn("bucket", F.substring("digest", 1, 4))
    ahead = (
        divided.groupBy("bytes", "bucket")
        .agg(F.count("*").alias("n"))
        .withColumn("ahead", F.sum("n").over(Window.partitionBy("bytes").orderBy("bucket")) - F.col("n"))
        .drop("n")
    )
    near = F.row_number().over(Window.partitionBy("bytes", "bucket").orderBy("digest")) - 1
    ranked = divided.withColumn("near", near).join(ahead, ["bytes", "bucket"])
    ranked = ranked.withColumn("rank", (F.col("ahead") + F.col("near")).cast("long"))
    return rest.unionByName(ranked.select(*rest.columns))


def _slots(rows: DataFrame, total: int, shards: int) -> DataFrame:
    """Gapless numbers within each shard, counted in runs that single tasks can sort."""
    runs = max(1, -(-total // (shards * RUN_ROWS)))
    spread = F.pmod(F.xxhash64("doc_id", "digest"), F.lit(runs))
    rows = rows.withColumn("run", spread)
    ahead = (
        rows.groupBy("shard", "run")
        .agg(F.count("*").alias("n"))
        .withColumn("ahead", F.sum("n").over(Window.partitionBy("shard").orderBy("run")) - F.col("n"))
        .drop("n")
    )
    near = F.row_number().over(Window.partitionBy("shard", "run").orderBy("doc_id", "digest")) - 1
    return rows.withColumn("near", near).join(ahead, ["shard", "run"]).withColumn(
        "slot", (F.col("ahead") + F.col("near")).cast("long")
    )
