"""Sums and roundings of doubles that don't depend on the order of rows.

A sum of doubles depends on its order in the last bits. Here every addend is cut to a
fixed-point number in two whole limbs, which add exactly in any order: the sum is the same
whatever the partitions are. With ``bits`` for the first limb and LOW for the second, an addend
is cut at 2 ** -(bits + LOW), far below the last bit of a double of the size of the sum.

Rounding to decimals has two rules. ``up`` takes the shortest decimal text that means the double and rounds
its half up. ``even`` takes the double's exact value, of which only true halves go to the even side.
"""

from __future__ import annotations

import math

#: Bits of the second limb; 2 ** (63 - LOW) addends can't overflow it.
LOW = 28
#: Digits up to which a double's product with a power of ten is computed without error.
EXACT_DIGITS = 11
_SPLIT = "134217729D"  # 2 ** 27 + 1 halves the digits of a double


def double(value: float) -> str:
    """SQL text of a double, exact to the last bit."""
    return f"{float(value)!r}D"


def first_bits(bound: float) -> int:
    """Bits of the first limb for sums up to ``bound``, with one bit to spare."""
    return 61 - max(0, math.ceil(math.log2(bound)) if bound > 0 else 0)


def limbs(value: str, bits: int) -> tuple[str, str]:
    """SQL texts of the two limbs of a non-negative double."""
    scaled = f"({value}) * {double(2.0**bits)}"
    return f"floor({scaled})", f"floor(({scaled} - floor({scaled})) * {double(2.0**LOW)})"


def joined(high: str, low: str, bits: int) -> str:
    """SQL text of the double that two summed limbs mean."""
    return f"({high} / {double(2.0**bits)} + {low} / {double(2.0 ** (bits + LOW))})"


def value(high: int | None, low: int | None, bits: int) -> float:
    """The double nearest to two summed limbs; no rows sum to 0."""
    return (((high or 0) << LOW) + (low or 0)) / (1 << (bits + LOW))


def rounded(value: str, digits: int | None, rule: str = "up") -> str:
    """SQL text of a non-negative double rounded to decimals."""
    if digits is None:
        return value
    if rule == "up":
        return f"round({value}, {digits})"
    if digits > EXACT_DIGITS:
        raise ValueError(f"the rule 'even' is exact up to {EXACT_DIGITS} digits, not {digits}")
    return _nearest_even(f"({value})", double(10.0**digits), _SPLIT, "0.5D")


def _nearest_even(x: str, scale: str, split: str, half: str) -> str:
    """SQL text of x rounded to units of 1 / scale, true halves to even.

    Both halves a and b of the digits of x times the scale are exact, so are their distances from the
    whole numbers next to them, and the sign of a sum of two doubles is exact, too.
    """
    high = f"({x} * {split} - ({x} * {split} - {x}))"
    a, b = f"({high} * {scale})", f"(({x} - {high}) * {scale})"
    near_b = f"floor({b} + {half})"
    whole = f"(floor({a}) + {near_b})"
    over = f"(({a} - floor({a}) - {half}) + ({b} - {near_b}))"  # distance from the half above
    odd = f"({whole} % 2 <> 0)"
    step = f"CASE WHEN {over} > 0 OR ({over} = 0 AND {odd}) THEN 1 WHEN {over} = -1 AND {odd} THEN -1 ELSE 0 END"
    return f"(({whole} + {step}) / {scale})"
