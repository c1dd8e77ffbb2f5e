"""Column helpers for line-oriented text."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters removed by the two trimming rules in use.
# UNICODE_SPACE is what a Unicode-aware strip removes; CONTROL_SPACE is every
# code point up to and including the plain space.
UNICODE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
CONTROL_SPACE = "".join(chr(code) for code in range(0x21))

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def strip(column: Column, characters: str = UNICODE_SPACE) -> Column:
    """Remove the given characters from both ends."""
    return F.btrim(column, F.lit(characters))


def number(column: Column, on_bad: str = "raise") -> Column:
    """Parse a finite decimal number; bad text raises or becomes null."""
    text = strip(column)
    good = text.rlike(_NUMBER)
    if on_bad == "null":
        return F.when(good, text.try_cast("double"))
    if on_bad == "raise":
        problem = F.raise_error(F.concat(F.lit("not a number: "), F.coalesce(text, F.lit("null"))))
        return F.when(good, text.try_cast("double")).otherwise(problem.cast("double"))
    raise ValueError(f"on_bad must be 'raise' or 'null', got {on_bad!r}")


def fixed(column: Column, digits: int = 8) -> Column:
    """Fixed-decimal text such as ``0.17582556``."""
    return F.format_string(f"%.{digits}f", column)


def split_list(column: Column, separator: str = ",") -> Column:
    """Split on a separator; empty or missing text is an empty list."""
    empty = F.array().cast("array<string>")
    text = F.coalesce(column, F.lit(""))
    return F.when(text == "", empty).otherwise(F.split(text, F.lit(f"\\Q{separator}\\E"), -1))


_SCORE = re.compile(r"([^=]*)=(.*)", re.DOTALL)


def restart_scores(items: Iterable[str]) -> dict[str, float]:
    """Scores by node from texts such as ``home=1.5``; of several for one node the last holds.

    The first sign of equality ends the node. A text without one, or without a number after
    it, fails.
    """
    found = {item: _SCORE.fullmatch(item) for item in items}
    unusable = [item for item, match in found.items() if match is None]
    if unusable:
        raise ValueError(f"no score in {unusable}")
    return {match[1].strip(): float(match[2]) for match in found.values()}


def score_rows(lines: DataFrame) -> DataFrame:
    """``node, score`` from lines (column ``value``) such as ``home=1.5``, by the same rules.

    Of several lines for one node the last in the file's order holds; empty lines are skipped.
    """
    value = F.col("value")
    place = F.instr(value, "=")
    complaint = F.raise_error(F.concat(F.lit("no score in "), value)).cast("string")
    node = F.when(place > 0, strip(F.substring(value, F.lit(1), place - 1))).otherwise(complaint)
    score = number(F.substring(value, place + 1, F.length(value)))
    rows = lines.where(strip(value) != "").select(
        node.alias("node"), score.alias("score"), F.monotonically_increasing_id().alias("place")
    )
    return rows.groupBy("node").agg(F.max_by("score", "place").alias("score"))
