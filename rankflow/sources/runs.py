"""Run-measurement tables: one row per framework and graph size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.sources.paths import to_uri

# The columns of a results file, in file order.
COLUMNS = (
    "framework",
    "label",
    "n_nodes",
    "n_edges",
    "time_s",
    "time_s_std",
    "peak_mem_mb",
    "peak_mem_mb_std",
    "n_runs",
    "iterations",
    "max_diff_vs_core",
    "status",
)


def usable_runs(raw: DataFrame) -> DataFrame:
    """Typed rows of finished runs from text columns.

    Keeps ``status = 'ok'``. Blank memory is null, blank spreads and errors are
    0. A row with an unreadable required number, or unreadable non-blank text in
    an optional one, is dropped.
    """

    def typed(name: str, kind: str):
        return F.trim(F.col(name)).try_cast(kind)

    def optional(name: str):
        return F.coalesce(typed(name, "double"), F.lit(0.0)).alias(name)

    def readable(name: str):
        text = F.trim(F.coalesce(F.col(name), F.lit("")))
        return (text == "") | text.try_cast("double").isNotNull()

    kept = raw.where(
        (F.col("status") == "ok")
        & typed("n_nodes", "bigint").isNotNull()
        & typed("time_s", "double").isNotNull()
        & readable("time_s_std")
        & readable("peak_mem_mb")
        & readable("peak_mem_mb_std")
        & readable("max_diff_vs_core")
    )
    return kept.select(
        "framework",
        "label",
        typed("n_nodes", "bigint").alias("n_nodes"),
        typed("n_edges", "bigint").alias("n_edges"),
        typed("time_s", "double").alias("time_s"),
        optional("time_s_std"),
        typed("peak_mem_mb", "double").alias("peak_mem_mb"),
        optional("peak_mem_mb_std"),
        typed("n_runs", "bigint").alias("n_runs"),
        typed("iterations", "bigint").alias("iterations"),
        optional("max_diff_vs_core"),
        "status",
    )


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Read a results file (CSV with header)."""
    schema = ", ".join(f"{name} STRING" for name in COLUMNS)
    return usable_runs(spark.read.schema(schema).csv(to_uri(path), header=True))


def append_runs(rows: DataFrame, path: str) -> None:
    """Append result rows as CSV parts."""
    rows.select(*COLUMNS).write.mode("append").csv(to_uri(path), header=True)
