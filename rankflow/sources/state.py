"""Node state as text: rank plus out-neighbours in three line formats.

In memory, state is ``node STRING, rank DOUBLE, neighbors ARRAY<STRING>``. A node
with very many out-links may own several rows, each with the full rank and a
bounded slice of its links (see ``graph.adjacency``). The formats keep that
property: one row is one line, and readers accept several lines for one node.
A list of only the empty id reads back as no links from ``pipe`` and ``tsv``;
``json`` keeps it.
"""

from __future__ import annotations

import uuid
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions.text import CONTROL_SPACE, UNICODE_SPACE, fixed, number, split_list, strip
from rankflow.sources.files import merge_parts
from rankflow.sources.paths import to_uri


def _two_columns(
    lines: DataFrame, exact: bool, skip_comments: bool, trim: bool = True
) -> DataFrame:
    """Split lines, trimmed or as they are, into ``node`` and ``rest`` at the first TAB."""
    trimmed = CONTROL_SPACE if skip_comments else UNICODE_SPACE
    line = strip(F.col("value"), trimmed) if trim else F.col("value")
    parts = lines.select(F.split(line, "\t", -1 if exact else 2).alias("part"))
    parts = parts.where(F.size("part") == 2)
    if skip_comments:
        parts = parts.where(~F.col("part")[0].startswith("#"))
    node, rest = F.col("part")[0], F.col("part")[1]
    if skip_comments:
        node, rest = strip(node, trimmed), strip(rest, trimmed)
    return parts.select(node.alias("node"), rest.alias("rest"))


def format_pipe(state: DataFrame, digits: int = 8) -> DataFrame:
    """``node TAB rank|n1,n2,…`` lines with a fixed number of decimals."""
    links = F.array_join("neighbors", ",")
    return state.select(
        F.concat("node", F.lit("\t"), fixed(F.col("rank"), digits), F.lit("|"), links).alias("value")
    )


def parse_pipe(
    lines: DataFrame, exact: bool = True, skip_comments: bool = False, trim: bool = True
) -> DataFrame:
    """Read ``node TAB rank|n1,n2,…`` lines; lines without ``|`` are skipped.

    ``exact`` asks for exactly two TAB columns; otherwise only the first TAB
    separates. ``skip_comments`` also trims the two columns. Lines are trimmed,
    as files of other programs need; without ``trim`` an empty id and ids with
    outer spaces stay as they were written.
    """
    pairs = _two_columns(lines, exact, skip_comments, trim).where(F.col("rest").contains("|"))
    rank_text = F.substring_index("rest", "|", 1)
    links = F.substring(F.col("rest"), F.length(rank_text) + 2, F.length("rest"))
    return pairs.select(
        "node", number(rank_text).alias("rank"), split_list(links).alias("neighbors")
    )


def parse_pipe_ranks(lines: DataFrame) -> DataFrame:
    """Only ``node, rank`` from pipe lines; a bare rank without links is fine."""
    pairs = _two_columns(lines, exact=False, skip_comments=True)
    return pairs.select("node", number(F.substring_index("rest", "|", 1)).alias("rank")).distinct()


def format_tsv(state: DataFrame) -> DataFrame:
    """``node TAB rank TAB n1,n2,…`` lines at full precision."""
    links = F.array_join("neighbors", ",")
    return state.select(
        F.concat_ws("\t", "node", F.col("rank").cast("string"), links).alias("value")
    )


def parse_tsv(lines: DataFrame) -> DataFrame:
    """Read ``node TAB rank TAB n1,n2,…`` lines."""
    part = F.split("value", "\t", -1)
    return lines.where(F.size(part) >= 2).select(
        part[0].alias("node"),
        number(part[1]).alias("rank"),
        split_list(F.get(part, F.lit(2))).alias("neighbors"),
    )


def format_json(state: DataFrame) -> DataFrame:
    """``"node" TAB [rank, ["n1", "n2"]]`` lines."""
    wrapped = F.to_json(F.array("node"))
    node = F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)
    body = F.concat(
        F.lit("["), F.col("rank").cast("string"), F.lit(", "), F.to_json("neighbors"), F.lit("]")
    )
    return state.select(F.concat(node, F.lit("\t"), body).alias("value"))


def parse_json(lines: DataFrame) -> DataFrame:
    """Read ``"node" TAB [rank, ["n1", "n2"]]`` lines."""
    part = F.split("value", "\t", 2)
    body = F.from_json(part[1], "array<string>")
    node = F.from_json(F.concat(F.lit("["), part[0], F.lit("]")), "array<string>")
    rows = lines.where(F.size(part) == 2).select(node[0].alias("node"), body.alias("body"))
    return rows.select(
        "node",
        number(F.col("body")[0]).alias("rank"),
        F.from_json(F.col("body")[1], "array<string>").alias("neighbors"),
    )


_FORMATS = {"pipe": format_pipe, "tsv": format_tsv, "json": format_json}
_PARSERS = {"pipe": partial(parse_pipe, trim=False), "tsv": parse_tsv, "json": parse_json}


def write_state(state: DataFrame, path: str, style: str = "pipe", mode: str = "errorifexists") -> None:
    """Write node state as text parts, ordered by node and block, so that a hub spreads over parts."""
    keys = [name for name in ("node", "block") if name in state.columns]
    _FORMATS[style](state.orderBy(*keys)).write.mode(mode).text(to_uri(path))


def write_state_file(state: DataFrame, path: str, style: str = "pipe") -> str:
    """Write node state as one text file, ordered as ``write_state`` does; never overwrites."""
    parts = f"{path}.{uuid.uuid4().hex}"
    write_state(state, parts, style)
    return merge_parts(state.sparkSession, parts, path)


def read_state(spark: SparkSession, path: str, style: str = "pipe") -> DataFrame:
    """Read node state written in one of the styles."""
    return _PARSERS[style](spark.read.text(to_uri(path)))


def edges_from_state(state: DataFrame) -> DataFrame:
    """One edge per listed neighbour; an empty list gives no edge."""
    return state.select(F.col("node").alias("src"), F.explode("neighbors").alias("dst"))
