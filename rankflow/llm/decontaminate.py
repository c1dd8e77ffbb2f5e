"""Benchmark decontamination by size-partitioned MinHash containment search.

A short item inside a long document has a tiny Jaccard similarity to it, so what is
searched for is containment. Items are partitioned by their number of shingles, by
powers of two, and each partition has sketches of its own length: the shingles of
least hash, one more than an item of the largest size there may miss. A document
that contains THRESHOLD percent of an item holds at least one shingle of its sketch,
so the candidates are complete. A document too short for the items of a probe is no
candidate. Candidates are verified by exact containment of shingles. Only built-in
expressions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import cut, lower_ascii, words

SIZE = 5
#: Containment in percent.
THRESHOLD = 80
#: A table of at most so many bytes is broadcast; a larger one is shuffled.
BROADCAST_BYTES = 16 << 20


def _shingles(found: Column, form: Callable[[list[Column]], Column]) -> Column:
    """All runs of SIZE words in a given form; null for texts with fewer words."""
    last = F.size(found) - SIZE
    every = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: form([F.get(found, i + k) for k in range(SIZE)])
    )
    return F.when(last >= 0, every)


def _hash(own: list[Column]) -> Column:
    return F.xxhash64(*own)


def _text(own: list[Column]) -> Column:
    return F.concat_ws(" ", *own)


def _exploded(rows: DataFrame, form: Callable[[list[Column]], Column], *keep: str) -> DataFrame:
    """One row per shingle, with n_words of the text; ``rows`` has a column text.

    Words and shingles are arrays of their own first, so that they are built once per
    text and not carried along by its shingles. explode would have Spark filter by
    the length of the array beforehand and build it twice; explode_outer does not.
    """
    split = rows.select(*keep, words(lower_ascii(F.col("text"))).alias("w"))
    ready = split.select(*keep, F.size("w").alias("n_words"), _shingles(F.col("w"), form).alias("all"))
    return ready.select(*keep, "n_words", F.explode_outer("all").alias("s")).where(F.col("s").isNotNull())


def _checked(table: DataFrame) -> DataFrame:
    """Broadcast a table whose size allows it, else leave the join to a shuffle."""
    sizes = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(1)) + 16 for c in table.columns), F.lit(0))
    size = table.agg(F.sum(sizes)).first()[0] or 0
    return F.broadcast(table) if size <= BROADCAST_BYTES else table


def sketches(items: DataFrame) -> DataFrame:
    """item_id, hash, shingle, n_shingles and in_sketch for the distinct shingles of all items."""
    every = _exploded(items, lambda own: F.struct(_hash(own).alias("hash"), _text(own).alias("shingle")), "item_id")
    every = every.select("item_id", "s.hash", "s.shingle").distinct()
    size = F.count("*").over(Window.partitionBy("item_id"))
    largest = F.expr("shiftleft(1L, length(bin(n_shingles))) - 1")  # of the partition by powers of two
    order = Window.partitionBy("item_id").orderBy(F.xxhash64("hash"), "shingle")
    ranked = every.withColumn("n_shingles", size).withColumn("rank", F.row_number().over(order))
    missed = F.floor(largest * (100 - THRESHOLD) / 100)
    return ranked.withColumn("in_sketch", F.col("rank") <= missed + 1).drop("rank")


def contained(docs: DataFrame, items: DataFrame) -> DataFrame:
    """All pairs of a document and an item of which it contains THRESHOLD percent of the shingles.

    ``docs``: doc_id, text; ``items``: item_id, text; any other columns. Words are
    lower-cased (A-Z), shingles have five words. Returns doc_id, item_id, n_shared,
    n_shingles. Texts of fewer than five words, null and empty ones have no shingle and no
    pair. Rows with one doc_id are judged one by one and a pair is given once, with the
    larger n_shared; rows with one item_id are one item. Null ids pair like others;
    empty tables give no rows.
    """
    known = cut(sketches(items))
    probes = known.where("in_sketch").groupBy("hash").agg(F.min("n_shingles").alias("least"))
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("version"))
    met = _exploded(texts, _hash, "doc_id", "version").withColumnRenamed("s", "hash").join(_checked(probes), "hash")
    met = met.where((F.col("n_words") - SIZE + 1) * 100 >= F.col("least") * THRESHOLD)
    some = cut(met.select(F.col("doc_id").alias("own_id"), F.col("version").alias("own_version")).distinct())
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("version") == F.col("own_version"))
    held = texts.join(_checked(some), same, "left_semi")
    every = _exploded(held, _text, "doc_id", "version").withColumnRenamed("s", "shingle").drop("n_words")
    shared = every.join(_checked(known.select("item_id", "shingle", "n_shingles")), "shingle").distinct()
    counted = shared.groupBy("doc_id", "version", "item_id", "n_shingles").agg(F.count("*").alias("n_shared"))
    enough = counted.where(F.col("n_shared") * 100 >= F.col("n_shingles") * THRESHOLD)
    return enough.groupBy("doc_id", "item_id").agg(F.max("n_shared").alias("n_shared"), F.max("n_shingles").alias("n_shingles"))
