"""Comparison of rank tables, invariants and convergence checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: factor and rounding of the integer change counter.
COUNTER_SCALE = 1e8


def compare(left: DataFrame, right: DataFrame) -> DataFrame:
    """``node, left_rank, right_rank, abs_diff``; a missing side is null."""
    a = left.select("node", F.col("rank").alias("left_rank"))
    b = right.select("node", F.col("rank").alias("right_rank"))
    both = a.join(b, "node", "full_outer")
    return both.withColumn("abs_diff", F.abs(F.col("left_rank") - F.col("right_rank")))


def keyset_mismatch(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: how many nodes occur on one side only."""
    return compare(left, right).agg(
        F.count_if(F.col("right_rank").isNull()).alias("only_left"),
        F.count_if(F.col("left_rank").isNull()).alias("only_right"),
    )


def max_abs_diff(left: DataFrame, right: DataFrame, on_mismatch: str = "raise") -> DataFrame:
    """One row ``max_abs_diff``: the largest difference over all nodes.

    If the node sets differ the query fails, or yields null with
    ``on_mismatch="null"``.
    """
    if on_mismatch not in ("raise", "null"):
        raise ValueError(f"on_mismatch must be 'raise' or 'null', got {on_mismatch!r}")
    if on_mismatch == "raise":
        other = F.raise_error(F.lit("a node is ranked on one side only")).cast("double")
    else:
        other = F.lit(None).cast("double")
    facts = compare(left, right).agg(
        F.count_if(F.col("abs_diff").isNull()).alias("unpaired"), F.max("abs_diff").alias("worst")
    )
    return facts.select(
        F.when(F.col("unpaired") == 0, F.col("worst")).otherwise(other).alias("max_abs_diff")
    )


def l1_delta(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row ``delta``: summed absolute change between two rank tables."""
    return compare(old, new).agg(F.sum("abs_diff").alias("delta"))


def counter(difference: Column) -> Column:
    """Absolute change as a whole number of 1e-8 units."""
    return F.floor(F.abs(difference) * F.lit(COUNTER_SCALE) + F.lit(0.5)).cast("long")


def delta_counter(old: DataFrame, new: DataFrame) -> DataFrame:
    """Change per node rounded to 1e-8 and summed: ``delta_units, delta``."""
    change = counter(F.col("left_rank") - F.col("right_rank"))
    units = compare(old, new).agg(F.sum(change).alias("delta_units"))
    return units.withColumn("delta", F.col("delta_units") / F.lit(COUNTER_SCALE))


def total(ranks: DataFrame) -> DataFrame:
    """One row ``total``."""
    return ranks.agg(F.sum("rank").alias("total"))


def spread(ranks: DataFrame) -> DataFrame:
    """One row ``stddev``: population standard deviation of the ranks."""
    return ranks.agg(F.stddev_pop("rank").alias("stddev"))


def mass_leak(ranks: DataFrame) -> DataFrame:
    """One row ``leak``: rank missing from a total of 1."""
    return ranks.agg((F.lit(1.0) - F.sum("rank")).alias("leak"))


def invariants(ranks: DataFrame, nodes: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """One row of checks on finished ranks against the node table.

    ``total_is_one``, ``missing_nodes``, ``extra_nodes``, ``sinks_without_rank``.
    """
    table = nodes.select("node", "out_weight").withColumn("known", F.lit(True))
    both = table.join(ranks.select("node", "rank"), "node", "full_outer")
    poor_sink = (F.col("out_weight") == 0) & (F.coalesce(F.col("rank"), F.lit(0.0)) <= 0)
    return both.agg(
        (F.abs(F.sum("rank") - 1) < tolerance).alias("total_is_one"),
        F.count_if(F.col("rank").isNull()).alias("missing_nodes"),
        F.count_if(F.col("known").isNull()).alias("extra_nodes"),
        F.count_if(poor_sink).alias("sinks_without_rank"),
    )


def history_steps(history: DataFrame, tolerance: float = 1e-12) -> DataFrame:
    """Each iteration's change next to the previous one, and if it fell.

    The history has one row per iteration, so the window is small by nature.
    """
    before = F.lag("delta").over(Window.orderBy("iteration"))
    fell = before.isNull() | (F.col("delta") <= before + tolerance)
    return history.select("iteration", "delta", before.alias("previous_delta"), fell.alias("falling"))


def iterations_to_converge(history: DataFrame, epsilon: float) -> DataFrame:
    """One row: first iteration below epsilon, else the number executed."""
    first = F.min(F.when(F.col("delta") < epsilon, F.col("iteration")))
    return history.agg(
        F.coalesce(first, F.max("iteration"), F.lit(0)).alias("iterations"),
        first.isNotNull().alias("converged"),
    )
