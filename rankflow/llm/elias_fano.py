"""Elias-Fano sequences and an n-gram trie of them, in memory-mapped scratch files.

A rising sequence keeps the low bits of its values packed side by side and the high
bits in unary, about two bits each; small directories of ones and zeros give any
value and any successor without unpacking. All lookups take arrays of queries.
"""

from __future__ import annotations

import tempfile

import numpy as np

_PLACES = np.zeros((256, 8), dtype=np.int64)
for _b in range(256):
    _set = [i for i in range(8) if _b >> i & 1]
    _PLACES[_b, : len(_set)] = _set


class Levels:
    """A scratch file without a name, mapped into memory; it goes when its task ends."""

    def __init__(self):
        self.file = tempfile.TemporaryFile()

    def keep(self, array: np.ndarray) -> np.ndarray:
        if not array.size:
            return array
        at = self.file.seek(0, 2)
        self.file.write(np.ascontiguousarray(array).tobytes())
        self.file.write(b"\0" * (-self.file.tell() % 8))
        self.file.flush()
        return np.memmap(self.file, array.dtype, "r", at, array.shape)


class EliasFano:
    """A sequence of numbers that never falls."""

    def __init__(self, values: np.ndarray, levels: Levels):
        values = values.astype(np.uint64)
        self.size = n = len(values)
        top = int(values[-1]) if n else 0
        self.width = max(0, min(56, (max(1, top) // max(1, n)).bit_length() - 1))
        low = values & np.uint64((1 << self.width) - 1)
        high = (values >> np.uint64(self.width)).astype(np.int64)
        packed = np.zeros((n * self.width + 7) // 8 + 8, dtype=np.uint8)
        for start in range(0, n, 1 << 16 << 3):  # a multiple of 8 values fills whole bytes
            part = low[start : start + (1 << 16 << 3)]
            bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little", count=self.width)
            own = np.packbits(bits.reshape(-1), bitorder="little")
            at = start * self.width // 8
            packed[at : at + len(own)] = own
        unary = np.zeros(((high[-1] if n else 0) + n) // 64 * 64 + 128, dtype=np.uint8)
        unary[high + np.arange(n)] = 1
        words = np.packbits(unary, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])
        self.low = levels.keep(packed)
        self.words = levels.keep(words)
        self.ones = levels.keep(ones)
        self.zeros = levels.keep(np.arange(len(ones)) * 64 - ones)

    def _select(self, k: np.ndarray, bit: int) -> np.ndarray:
        """Position of the k-th one or zero, from 0 on."""
        before = self.ones if bit else self.zeros
        word = np.searchsorted(before, k, "right") - 1
        left = k - before[word]
        bits = self.words[word]
        if not bit:
            bits = ~bits
        place = word * 64
        for half in (32, 16, 8):
            low = bits & np.uint64((1 << half) - 1)
            count = np.bitwise_count(low).astype(np.int64)
            above = left >= count
            left = np.where(above, left - count, left)
            bits = np.where(above, bits >> np.uint64(half), low)
            place += above * half
        return place + _PLACES[bits, left]

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), dtype=np.uint64)
        bit = i * self.width
        window = np.ndarray((len(self.low) - 7,), "<u8", self.low, strides=(1,))  # 8 bytes from any byte on
        return window[bit // 8] >> (bit % 8).astype(np.uint64) & np.uint64((1 << self.width) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        high = (self._select(i, 1) - i).astype(np.uint64)
        return high << np.uint64(self.width) | self._low(i)

    def successor(self, x: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """In each range from begin to end: the index of the first value >= x, and whether it is x."""
        x = x.astype(np.uint64)
        high = np.minimum((x >> np.uint64(self.width)).astype(np.int64), int(self.zeros[-1]) - 1)
        low = x & np.uint64((1 << self.width) - 1)
        first = np.where(high > 0, self._select(np.maximum(high - 1, 0), 0) - (high - 1), 0)
        last = self._select(high, 0) - high
        a, b = np.clip(first, begin, end), np.clip(last, begin, end)
        stop = b.copy()
        while (open_ := np.nonzero(a < b)[0]).size:  # values with these high bits, by halves
            middle = (a[open_] + b[open_]) // 2
            less = self._low(middle) < low[open_]
            a[open_[less]] = middle[less] + 1
            b[open_[~less]] = middle[~less]
        hit = np.zeros(len(x), dtype=bool)
        inside = a < stop
        hit[inside] = self._low(a[inside]) == low[inside]
        return a, hit


class Codebook:
    """Logarithms of probabilities as whole steps of STEP below 0.

    The steps are the same everywhere, so a value doesn't depend on what else a shard holds.
    """

    STEP = 1 / 2048

    def __init__(self, values: np.ndarray, levels: Levels):
        self.codes = levels.keep(self.steps(values))

    @classmethod
    def steps(cls, values: np.ndarray) -> np.ndarray:
        codes = np.rint(-values / cls.STEP)
        if len(codes) and not (0 <= codes.min() and codes.max() < 1 << 16):
            raise OverflowError("a probability is over 1 or under 10 ** -32")
        return codes.astype(np.uint16)

    def get(self, i: np.ndarray) -> np.ndarray:
        return self.codes[i] * -self.STEP


class Counts:
    """Counts, each by its place among the distinct ones, of which there are few."""

    def __init__(self, values: np.ndarray, levels: Levels):
        self.distinct, at = np.unique(values, return_inverse=True)
        self.places = levels.keep(at.astype(np.min_scalar_type(len(self.distinct))))

    def get(self, i: np.ndarray) -> np.ndarray:
        return self.distinct[self.places[i]]


class Trie:
    """Words under their contexts with a value each, as ``book`` keeps it, and a quantised one for each context if there is a weight.

    ``context`` and ``word``: pairs in rising order, words from 1 on. The words of a
    context are stored on top of the last value of the context before, so the whole
    level rises; pointers tell where each context begins.
    """

    def __init__(self, context: np.ndarray, word: np.ndarray, value: np.ndarray, weight: np.ndarray | None, book: type = Codebook):
        levels = Levels()
        begins = np.nonzero(np.diff(context, prepend=-1))[0] if len(context) else np.zeros(0, dtype=np.int64)
        ends = np.append(begins[1:], len(context)) if len(begins) else begins
        last = word[ends - 1].astype(np.int64) if len(begins) else begins
        self.contexts = EliasFano(context[begins], levels)
        self.pointers = EliasFano(np.append(begins, len(context)), levels)
        base = np.cumsum(last) - last
        self.words = EliasFano(word.astype(np.int64) + np.repeat(base, ends - begins), levels)
        self.value, self.weight = book(value, levels), None if weight is None else Codebook(weight[begins], levels)

    def find(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For each query: is the context known, its weight, is the pair known, its value."""
        n = len(context)
        value, pair = np.zeros(n), np.zeros(n, dtype=bool)
        new = np.append(True, np.diff(context) != 0)[:n]  # neighbours with one context look it up once
        run, context = np.cumsum(new) - 1, context[new]
        zero = np.zeros(len(context), dtype=np.int64)
        at, known = self.contexts.successor(context, zero, zero + self.contexts.size)
        weight = np.zeros(len(context))
        if known.any():
            k = at[known]
            if self.weight:
                weight[known] = self.weight.get(k)
            begin, end, base = zero.copy(), zero.copy(), zero.copy()
            begin[known], end[known] = (self.pointers.get(x).astype(np.int64) for x in (k, k + 1))
            base[known] = np.where(begin[known] > 0, self.words.get(np.maximum(begin[known] - 1, 0)).astype(np.int64), 0)
            own = np.nonzero(known[run])[0]
            of = run[own]
            j, hit = self.words.successor(base[of] + word[own].astype(np.int64), begin[of], end[of])
            pair[own] = hit
            value[own[hit]] = self.value.get(j[hit])
        return known[run], weight[run], pair, value
