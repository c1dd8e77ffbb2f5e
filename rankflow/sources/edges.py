"""Edge lists: line parsing policies, readers and a writer.

Every reader yields ``src STRING, dst STRING`` (and ``w DOUBLE`` when weighted).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.functions.text import CONTROL_SPACE, UNICODE_SPACE, number, strip
from rankflow.sources.paths import to_uri


@dataclass(frozen=True)
class LinePolicy:
    """What counts as an edge line, and what is trimmed."""

    trimmed: str = UNICODE_SPACE
    skip_comments: bool = False
    exact_columns: bool = False
    trim_fields: bool = False


POLICIES = {
    "core": LinePolicy(skip_comments=True, trim_fields=True),
    "first2": LinePolicy(),
    "exact2": LinePolicy(exact_columns=True),
    "exact2_nocomment": LinePolicy(
        trimmed=CONTROL_SPACE, skip_comments=True, exact_columns=True, trim_fields=True
    ),
}


def parse_edges(
    lines: DataFrame,
    policy: str = "core",
    weighted: bool = False,
    on_bad_weight: str = "raise",
) -> DataFrame:
    """Turn a table of text lines (column ``value``) into edges.

    Lines that do not fit the policy are skipped. A weighted line whose third
    field is no number raises, or is skipped with ``on_bad_weight="skip"``.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {sorted(POLICIES)}, got {policy!r}")
    if on_bad_weight not in ("raise", "skip"):
        raise ValueError(f"on_bad_weight must be 'raise' or 'skip', got {on_bad_weight!r}")
    rule = POLICIES[policy]
    wanted = 3 if weighted else 2

    # a blank line has one field, so the width test drops it as well
    line = strip(F.col("value"), rule.trimmed)
    fields = lines.select(F.split(line, "\t", -1).alias("field"))
    width = F.size("field")
    fields = fields.where(width == wanted if rule.exact_columns else width >= wanted)
    if rule.skip_comments:
        fields = fields.where(~F.col("field")[0].startswith("#"))

    def field(index: int):
        text = F.col("field")[index]
        return strip(text, rule.trimmed) if rule.trim_fields else text

    edges = fields.select(
        field(0).alias("src"),
        field(1).alias("dst"),
        *([F.col("field")[2].alias("weight_text")] if weighted else []),
    )
    if not weighted:
        return edges
    if on_bad_weight == "raise":
        return edges.select("src", "dst", number(F.col("weight_text")).alias("w"))
    parsed = edges.select("src", "dst", number(F.col("weight_text"), "null").alias("w"))
    return parsed.where(F.col("w").isNotNull())


def read_edges(
    spark: SparkSession,
    path: str,
    policy: str = "core",
    weighted: bool = False,
    on_bad_weight: str = "raise",
) -> DataFrame:
    """Read TAB-separated edge text under one of the line policies."""
    return parse_edges(spark.read.text(to_uri(path)), policy, weighted, on_bad_weight)


def drop_null_endpoints(edges: DataFrame) -> DataFrame:
    """Keep edges whose two endpoints are known."""
    return edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())


def read_edge_table(spark: SparkSession, path: str, weighted: bool = False) -> DataFrame:
    """Read edges through the CSV source with a declared schema, nulls dropped."""
    schema = "src STRING, dst STRING" + (", w DOUBLE" if weighted else "")
    table = spark.read.schema(schema).option("sep", "\t").csv(to_uri(path), header=False)
    return drop_null_endpoints(table)


def parse_relation(lines: DataFrame, fields: tuple[str, ...] = ("src", "dst"), separator: str = "\t") -> DataFrame:
    """Delimited text as a relation of strings, the way loaders without quoting read it.

    Quotes, comment signs and outer spaces are part of a field. An empty or missing field is
    null, further fields are ignored, and an empty line is a row of nulls.
    """
    part = F.split("value", f"\\Q{separator}\\E", -1)
    return lines.select(*[F.nullif(F.get(part, F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(fields)])


def read_relation(spark: SparkSession, path: str) -> DataFrame:
    """Read TAB-separated edges without quoting; rows that lack an endpoint are dropped."""
    return drop_null_endpoints(parse_relation(spark.read.text(to_uri(path))))


def write_edges(edges: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write edges as TAB-separated text parts, ids verbatim; edges without an endpoint are left out."""
    edges = drop_null_endpoints(edges)
    fields = [F.col(name).cast("string") for name in ("src", "dst", "w") if name in edges.columns]
    edges.select(F.concat_ws("\t", *fields).alias("value")).write.mode(mode).text(to_uri(path))
