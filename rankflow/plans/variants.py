"""Named parameter sets for the run variants users may come from.

    run(edges, **VARIANTS["single_pass"])
"""

from __future__ import annotations

from typing import Any

# Defaults of the variants; all use damping 0.85 and epsilon 1e-3
# unless stated.
VARIANTS: dict[str, dict[str, Any]] = {
    # Dangling rank restarts, the total stays 1.
    "exact": {"max_iter": 100},
    "exact_short": {"max_iter": 20},
    # Dangling rank is dropped, the total shrinks on graphs with sinks.
    "single_pass": {"max_iter": 20, "dangling": "drop"},
    # The same for a fixed number of steps.
    "single_pass_fixed": {"max_iter": 20, "dangling": "drop", "epsilon": 0.0},
    # State goes through text with 8 decimals between steps.
    "single_pass_text": {"max_iter": 20, "dangling": "drop", "epsilon": 0.0, "precision": 8},
    # Starts at 1.0 per node; shares have 10 decimals, state has 8.
    "unit_start_text": {
        "max_iter": 20,
        "dangling": "drop",
        "init": "one",
        "precision": 8,
        "share_precision": 10,
    },
}
