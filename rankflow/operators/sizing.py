"""How many partitions a table of a known size gets."""

from __future__ import annotations

import math

_MIN_ROWS = 20_000
_MAX_ROWS = 32_000_000


def choose_partitions(rows: int, configured: int) -> int:
    """Few partitions for a small table, never too many rows in one.

    Between the two limits the session's shuffle partition count decides.
    """
    wanted = min(configured, math.ceil(rows / _MIN_ROWS))
    needed = math.ceil(rows / _MAX_ROWS)
    return max(1, wanted, needed)
