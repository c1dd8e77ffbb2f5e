"""Counting quotient filters: exact, compact counters of numbers of a known width.

A number is first permuted by an invertible mixing of its bits, so that sorted numbers
spread evenly whatever they mean. Its upper bits, the quotient, are not stored: entries lie
in sorted order, and a bit string has a one for each entry and a zero after each
quotient, so an entry's place tells its quotient. The lower bits, the whole remainder, are
stored in whole bytes, as many as make entries small. Only entries that occur more than once have a counter. Nothing is lost: quotient and remainder give the permuted
number, the inverse gives the number back. Filters over one width are sorted alike, so
they merge by a merge of their entries that adds the counters.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

#: Odd multipliers of the mixing rounds.
ODD = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
#: A counter of this many or more stands in the list of large ones.
LARGE = 255


def _fold(x: np.ndarray, bits: int) -> np.ndarray:
    """Mix the upper half into the lower one; its own inverse, as the shift is half the width or more."""
    return x ^ (x >> np.uint64((bits + 1) // 2))


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def permute(x: np.ndarray, bits: int) -> np.ndarray:
    """A one-to-one mixing of the numbers under 2 ** bits."""
    x = x.astype(np.uint64)
    for odd in ODD:
        x = (_fold(x, bits) * np.uint64(odd)) & _mask(bits)
    return _fold(x, bits)


def restore(x: np.ndarray, bits: int) -> np.ndarray:
    """The numbers that ``permute`` mixed."""
    x = _fold(x.astype(np.uint64), bits)
    for odd in reversed(ODD):
        x = _fold((x * np.uint64(pow(odd, -1, 1 << 64))) & _mask(bits), bits)
    return x


def shard_of(permuted: np.ndarray, bits: int, shards: int) -> np.ndarray:
    """Shards are equal ranges of permuted numbers, so shard numbers rise with them."""
    top = min(bits, 32)
    return ((permuted >> np.uint64(bits - top)) * np.uint64(shards) >> np.uint64(top)).astype(np.int64)


def _low_bits(permuted: np.ndarray) -> int:
    """Whole bytes of remainder for which an entry takes the fewest bits, quotients included."""
    spread = (int(permuted[-1] - permuted[0]) // len(permuted)).bit_length()
    return min((8 * (spread // 8), 8 * (spread // 8) + 8), key=lambda low: low + 2.0 ** max(0, spread - low))


def encode(permuted: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A filter of sorted distinct permuted numbers and their counts."""
    n = len(permuted)
    low = _low_bits(permuted) if n else 0
    quotient = permuted >> np.uint64(low) if low < 64 else np.zeros(n, np.uint64)
    base = int(quotient[0]) if n else 0
    run = (quotient - np.uint64(base)).astype(np.int64)
    line = np.zeros(n + int(run[-1]) + 1 if n else 0, np.uint8)
    line[np.arange(n) + run] = 1
    remainder = permuted.astype("<u8").view(np.uint8).reshape(n, 8)[:, : low // 8]
    several = counts > 1  # most entries occur once and need no counter
    more = counts[several]
    large = more >= LARGE
    head = np.array([n, low, base, len(line), len(more), int(large.sum())], dtype="<u8")
    small = np.where(large, LARGE, more).astype(np.uint8)
    parts = (head, np.packbits(line), np.packbits(several), np.ascontiguousarray(remainder.T), small, more[large].astype("<i8"))
    return b"".join(p.tobytes() for p in parts)


def decode(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The sorted permuted numbers and counts of a filter."""
    n, low, base, length, several, large = (int(x) for x in np.frombuffer(data, "<u8", 6))
    at = 48

    def take(count: int, kind: str = "u1") -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, kind, count, at)
        at += found.nbytes
        return found

    line = np.unpackbits(take(-(-length // 8)), count=length)
    held = np.unpackbits(take(-(-n // 8)), count=n).astype(bool)
    planes = np.zeros((n, 8), np.uint8)
    planes[:, : low // 8] = take(n * (low // 8)).reshape(low // 8, n).T
    more = take(several).astype(np.int64)
    more[more == LARGE] = take(large, "<i8")
    counts = np.ones(n, np.int64)
    counts[held] = more
    quotient = (np.flatnonzero(line) - np.arange(n)).astype(np.uint64) + np.uint64(base)
    upper = quotient << np.uint64(low) if low < 64 else np.zeros(n, np.uint64)
    return upper | planes.reshape(-1).view("<u8"), counts


def merge(filters: Iterable[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All numbers of several decoded filters: distinct and sorted, their counts added, and where each entry went."""
    numbers, counts = (np.concatenate(x) for x in zip(*filters, strict=True))
    order = np.argsort(numbers, kind="stable")  # a merge of sorted runs
    ranked = numbers[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(ranked) else np.zeros(0, bool)
    went = np.empty(len(ranked), np.int64)
    went[order] = np.cumsum(new) - 1
    sums = np.add.reduceat(counts[order], np.flatnonzero(new)) if len(ranked) else counts
    return ranked[new], sums, went
