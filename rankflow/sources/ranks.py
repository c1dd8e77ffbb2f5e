"""Rank tables as text: sinks and a reader."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions.text import fixed, number, strip
from rankflow.operators.order import sorted_ranks
from rankflow.sources.files import merge_parts
from rankflow.sources.paths import to_uri

# Column titles of an exported ranking.
HEADER = ("node", "rank")

# TAB-separated, ids verbatim (an empty quote turns quoting off; by default the writer
# shows the empty text as "" and trims white space).
_TSV = {
    "sep": "\t",
    "quote": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def export_rows(ranks: DataFrame, digits: int = 8) -> DataFrame:
    """``node, rank`` with fixed decimals, best first, ties by node."""
    node, rank = HEADER
    return sorted_ranks(ranks).select(F.col("node").alias(node), fixed(F.col("rank"), digits).alias(rank))


def write_ranking(
    ranks: DataFrame,
    path: str,
    mode: str = "errorifexists",
) -> None:
    """Write a sorted ranking with a header.

    Every part file holds one range of the ranking, in file-name order.
    """
    export_rows(ranks).write.mode(mode).options(**_TSV).csv(to_uri(path), header=True)


def write_ranking_file(ranks: DataFrame, path: str) -> str:
    """Write a sorted ranking as one file with one header; never overwrites.

    Ranges are sorted and written in parallel; the file system joins the parts.
    """
    spark = ranks.sparkSession
    parts = f"{path}.{uuid.uuid4().hex}"
    export_rows(ranks).write.options(**_TSV).csv(to_uri(parts), header=False)
    return merge_parts(spark, parts, path, "\t".join(HEADER))


def write_rank_text(ranks: DataFrame, path: str) -> None:
    """Write ``node TAB rank`` with 8 decimals, no header; never overwrites."""
    line = F.concat_ws("\t", "node", fixed(F.col("rank")))
    sorted_ranks(ranks).select(line.alias("value")).write.mode("errorifexists").text(to_uri(path))


def write_rank_table(ranks: DataFrame, path: str) -> None:
    """Write ``node TAB rank`` at full precision, best first, overwriting."""
    rows = sorted_ranks(ranks.select("node", "rank"))
    rows.write.mode("overwrite").options(**_TSV).csv(to_uri(path), header=False)


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """Read any of the rank layouts back: a file or a folder of parts.

    Ids are kept verbatim, the empty id too. Lines that are exactly a header and lines
    of white space without a TAB are skipped; any other line without a TAB fails. Marker and
    checksum files are ignored by the text source itself.
    """
    line = F.col("value")
    rows = spark.read.text(to_uri(path)).where(line != "\t".join(HEADER))
    rows = rows.where(line.contains("\t") | (strip(line) != ""))
    part = F.split(line, "\t", -1)
    return rows.select(part[0].alias("node"), number(part[1]).alias("rank"))
