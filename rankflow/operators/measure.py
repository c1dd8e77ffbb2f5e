"""Analytics over run measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Decimals of the published figures, and the smallest error shown.
TIME_DIGITS = 4
MEMORY_DIGITS = 1
ERROR_FLOOR = 1e-16


def _published(value: Column, digits: int) -> Column:
    """Round half up in decimal arithmetic, free of binary noise."""
    return F.round(value.cast("decimal(38,12)"), digits).cast("double")


def summarize(runs: DataFrame) -> DataFrame:
    """Mean and sample spread of repeated runs per framework and size.

    Input: one row per run with ``framework, label, n_nodes, n_edges, time_s,
    peak_mem_mb`` (null when not sampled), ``iterations, max_diff_vs_core``. One
    run has spread 0; without memory samples both memory columns are null.
    """

    def spread(name: str, digits: int) -> Column:
        return _published(F.coalesce(F.stddev_samp(name), F.lit(0.0)), digits)

    memory = F.when(F.count("peak_mem_mb") > 0, spread("peak_mem_mb", MEMORY_DIGITS))
    return runs.groupBy("framework", "label", "n_nodes").agg(
        F.max("n_edges").alias("n_edges"),
        _published(F.avg("time_s"), TIME_DIGITS).alias("time_s"),
        spread("time_s", TIME_DIGITS).alias("time_s_std"),
        _published(F.avg("peak_mem_mb"), MEMORY_DIGITS).alias("peak_mem_mb"),
        memory.alias("peak_mem_mb_std"),
        F.count(F.lit(1)).alias("n_runs"),
        F.max("iterations").alias("iterations"),
        F.max("max_diff_vs_core").alias("max_diff_vs_core"),
        F.lit("ok").alias("status"),
    )


def finished(results: DataFrame) -> DataFrame:
    """Rows of runs that ended well."""
    return results.where("status = 'ok'")


def runtime_series(results: DataFrame) -> DataFrame:
    """Runtime by size within each label."""
    return finished(results).select("label", "n_nodes", "time_s", "time_s_std").orderBy(
        "label", "n_nodes"
    )


def memory_series(results: DataFrame) -> DataFrame:
    """Peak memory by size within each label; missing and zero samples skipped."""
    sampled = finished(results).where("peak_mem_mb IS NOT NULL AND peak_mem_mb != 0")
    return sampled.select(
        "label",
        "n_nodes",
        "peak_mem_mb",
        F.coalesce("peak_mem_mb_std", F.lit(0.0)).alias("peak_mem_mb_std"),
    ).orderBy("label", "n_nodes")


def speedup(results: DataFrame, baseline: str) -> DataFrame:
    """Baseline time over own time, at sizes the baseline has."""
    rows = finished(results).select("label", "n_nodes", "time_s")
    base = rows.where(F.col("label") == baseline).select(
        "n_nodes", F.col("time_s").alias("base_time_s")
    )
    joined = rows.where("time_s > 0").join(base, "n_nodes")
    return joined.select(
        "label", "n_nodes", (F.col("base_time_s") / F.col("time_s")).alias("speedup")
    ).orderBy("label", "n_nodes")


def worst_error(results: DataFrame) -> DataFrame:
    """Largest error per label, never below the floor."""
    worst = F.coalesce(F.max("max_diff_vs_core"), F.lit(0.0))
    return (
        finished(results)
        .groupBy("label")
        .agg(F.greatest(worst, F.lit(ERROR_FLOOR)).alias("worst_error"))
        .orderBy("label")
    )
