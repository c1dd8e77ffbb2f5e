"""Ordering of ranks: top-n, full sort, positions, dense indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.operators.sizing import choose_partitions
from rankflow.session import ensure_checkpoint_dir


def _by_rank() -> list[Column]:
    return [F.desc("rank"), F.asc("node")]


def top_n(ranks: DataFrame, n: int = 5) -> DataFrame:
    """The n best ``node, rank`` rows; all rows if there are fewer."""
    return ranks.select("node", "rank").orderBy(*_by_rank()).limit(n)


def sorted_ranks(ranks: DataFrame) -> DataFrame:
    """All rows, best first; ranges are sorted in parallel."""
    return ranks.orderBy(*_by_rank())


def dense_index(
    table: DataFrame, *ordering: Column, name: str = "index", rows: int | None = None
) -> DataFrame:
    """Number all rows 0, 1, 2, … in the given order, without a global window.

    Rows are range-partitioned and numbered inside their partition; the row
    counts of the earlier partitions (one number per partition, hence small) are
    added on top. The ordering must be total for a repeatable result. The
    numbered rows are checkpointed because both uses must see the same ranges.
    ``rows`` is the size of the table if known; it sets the number of ranges.
    """
    spark = table.sparkSession
    ensure_checkpoint_dir(spark)
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = choose_partitions(table.count() if rows is None else rows, configured)
    numbered = (
        table.repartitionByRange(parts, *ordering)
        .sortWithinPartitions(*ordering)
        .withColumn("_id", F.monotonically_increasing_id())
        .checkpoint()
        .select("*", F.shiftright("_id", 33).alias("_part"))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0).cast("long")).alias("_offset")
    )
    within = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + within)
        .drop("_id", "_part", "_offset")
    )


def positions(ranks: DataFrame) -> DataFrame:
    """``node, rank, position`` for all nodes, the best at position 1."""
    table = dense_index(ranks.select("node", "rank"), *_by_rank())
    return table.select("node", "rank", (F.col("index") + 1).alias("position"))
