"""Link analysis on large directed graphs, as plain Spark DataFrame jobs."""

from rankflow.operators.rank import RankResult, RankSpec, run, run_many
from rankflow.sources.edges import read_edges

__all__ = ["RankResult", "RankSpec", "read_edges", "run", "run_many"]
