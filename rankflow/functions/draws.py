"""Seeded pseudo-random draws as column expressions.

A draw depends only on the seed and the key, so any task computes it alone, a
retried task computes it again unchanged, and another SQL engine with MD5 can
reproduce it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 15 hexadecimal digits = 60 bits, the widest prefix that fits a signed long.
_HEX_DIGITS = 15


def draw(seed: int, *key: Column) -> Column:
    """A uniform 60-bit non-negative long for the key."""
    text = F.concat_ws(":", F.lit(str(seed)), *[part.cast("string") for part in key])
    return F.conv(F.substring(F.md5(text), 1, _HEX_DIGITS), 16, 10).cast("long")


def draw_below(seed: int, bound: Column, *key: Column) -> Column:
    """A uniform long in ``[0, bound)`` for the key."""
    return draw(seed, *key) % bound
