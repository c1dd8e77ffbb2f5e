"""Exact search, hard negatives and phrase mining against brute force, and on odd rows."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rankflow.llm import hard_negatives, phrases, quotient, topk, vectors

VECTORS = "vec_id long, embedding array<double>, label int, score long, row string, rank int, part int"
SMALL = {"chunk_rows": 16, "group_rows": 64, "page_rows": 8}


def odd_vectors(seed: int = 5, n: int = 300) -> list[tuple]:
    """Nulls everywhere, other widths, ties, repeated rows and ids, a hot vector and label."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = (rng.normal(size=6) * rng.choice([0.05, 0.3, 2.0])).tolist()
        rows.append((i, [0.5, 0.25, 0.0, 0.0, 0.0, 0.1] if i % 3 == 0 else v, int(rng.integers(0, 4)) if i % 4 else 1))
    rows += [(None, [1.0] * 6, 1), (None, [0.3] * 6, 2), (50, [0.5] * 6, 1), (50, [0.5] * 6, 1), (100, [0.4] * 6, None)]
    rows += [(1000, None, 1), (1050, [], 2), (1100, [1.0], 1), (1200, [0.2] * 9, 3), (1250, [None, 1.0], 1)]
    rows += [(1300, [math.nan] * 6, 1), (1350, [math.inf] + [0.0] * 5, 1), (1400, [-0.4] * 6, 7)]
    return [(*r, 9, "clash", 1, 2) for r in rows]


def ints(v):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return [math.floor(256 * x) for x in v]


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def nulls_last(key):
    return (key is None, key or 0)


def brute_top(rows, every=50, k=5):
    live = [(i, r[0], ints(r[1])) for i, r in enumerate(rows) if ints(r[1]) is not None]
    want = Counter()
    for i, key, v in live:
        if key is not None and key % every == 0:
            found = sorted((-dot(v, w), nulls_last(o), o) for j, o, w in live if j != i)
            want.update((key, n, o, -s) for n, (s, _, o) in enumerate(found[:k], 1))
    return want


def brute_negatives(rows, every=50):
    live = [(i, r[0], ints(r[1]), r[2]) for i, r in enumerate(rows) if ints(r[1]) is not None and r[2] is not None]
    want = Counter()
    for i, key, v, label in live:
        if key is None or key % every:
            continue
        found = sorted((-dot(v, w), nulls_last(o), o, x) for j, o, w, x in live if j != i)
        for s, _, positive, _ in [f for f in found if f[3] == label][:5]:
            fit = [(n, o) for n, _, o, x in found if x != label and 80 * -s <= 100 * -n <= 100 * -s]
            want.update((key, positive, rank, o, -s, -n) for rank, (n, o) in enumerate(fit[:5], 1))
    return want


def rows_of(frame):
    return Counter(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("layout", [{}, SMALL], ids=["one block", "many blocks"])
def test_top_k_by_brute_force(spark, layout):
    rows = odd_vectors()
    table = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = topk.top_k(table, "vec_id % 50 = 0", **layout)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert rows_of(got) == brute_top(rows)


def test_top_k_prunes_what_cannot_win(spark):
    """Most pairs of a long and a short vector are never multiplied out."""
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=8) * (5.0 if i < 60 else 0.01)).tolist(), 0, 0, "", 0, 0) for i in range(2_000)]
    assert rows_of(topk.top_k(spark.createDataFrame(rows, VECTORS), "vec_id % 50 = 0", **SMALL)) == brute_top(rows)
    laid = np.array([ints(r[1]) for r in rows], dtype=np.int64)
    lengths = np.sqrt((laid**2).sum(1).astype(float))
    q = {"turned": laid[:1].astype(float), "length": lengths[:1]}
    c = {"turned": laid[60:].astype(float), "length": lengths[60:]}
    least = np.array([int(np.sort(laid[1:] @ laid[0])[-5])])
    assert not topk._survivors(q, c, np.array([0]), least).any()


def test_search_of_few_or_no_rows(spark):
    for rows in ([], odd_vectors()[:1], odd_vectors()[:4], [(0, [], 1, 0, "", 0, 0)] * 3):
        table = spark.createDataFrame(rows, VECTORS)
        assert rows_of(topk.top_k(table, "vec_id % 50 = 0")) == brute_top(rows)
        assert rows_of(hard_negatives.mine(table, "vec_id % 50 = 0")) == brute_negatives(rows)


def test_scores_beyond_doubles_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(1, 1 << 20, size=3) * 0.5 + i).tolist(), i % 2, 0, "", 0, 0) for i in range(120)]
    assert max(dot(ints(r[1]), ints(r[1])) for r in rows) > vectors.EXACT_DOUBLE
    table = spark.createDataFrame(rows, VECTORS)
    assert rows_of(topk.top_k(table, "vec_id % 50 = 0")) == brute_top(rows)
    assert rows_of(hard_negatives.mine(table, "vec_id % 50 = 0")) == brute_negatives(rows)


@pytest.mark.parametrize("layout", [{}, SMALL], ids=["one block", "many blocks"])
def test_hard_negatives_by_brute_force(spark, layout):
    rows = odd_vectors(8)
    table = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = hard_negatives.mine(table, "vec_id % 50 = 0", **layout)
    assert rows_of(got) == brute_negatives(rows)
    assert sum(brute_negatives(rows).values()) > 50


def test_hot_label_moves_few_rows(spark):
    """A third of all rows are one vector of one label: what an anchor's partition gets stays small."""
    rows = [(i, [1.0, 0.0] if i % 3 else [1.0 - i / 1e4, 0.1], 1 if i % 3 else 2, 0, "", 0, 0) for i in range(900)]
    assert rows_of(hard_negatives.mine(spark.createDataFrame(rows, VECTORS), "vec_id % 50 = 0", **SMALL)) == brute_negatives(rows)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 64), st.lists(st.tuples(st.integers(0, 2**64 - 1), st.integers(1, 10**12)), max_size=60))
def test_quotient_filter_is_lossless(bits, pairs):
    numbers = np.array(sorted({n % (1 << bits) for n, _ in pairs}), dtype=np.uint64)
    counts = np.array([c for _, c in pairs][: len(numbers)], dtype=np.int64)
    mixed = quotient.permute(numbers, bits)
    assert len(np.unique(mixed)) == len(numbers) and (mixed <= quotient._mask(bits)).all()
    assert (quotient.restore(mixed, bits) == numbers).all()
    order = np.argsort(mixed)
    back, found = quotient.decode(quotient.encode(mixed[order], counts[order], bits))
    assert (back == mixed[order]).all() and (found == counts[order]).all()


def test_quotient_filters_merge():
    rng = np.random.default_rng(4)
    want, filters = Counter(), []
    for _ in range(7):
        mixed, counts = np.unique(quotient.permute(rng.integers(0, 500, 300).astype(np.uint64), 40), return_counts=True)
        want.update(dict(zip(mixed.tolist(), counts.tolist(), strict=True)))
        filters.append(quotient.decode(quotient.encode(mixed, counts, 40)))
    numbers, sums, went = quotient.merge(filters)
    assert dict(zip(numbers.tolist(), sums.tolist(), strict=True)) == want
    assert (numbers[went] == np.concatenate([f[0] for f in filters])).all()
    size = len(quotient.encode(numbers, sums, 40))
    assert size < 8 * len(numbers)  # smaller than the numbers alone


def brute_phrases(rows, least, longest=5, first=2000, cover=100):
    count, n = defaultdict(Counter), Counter()
    for row in rows:
        text, lang = row[1] or "", "und" if row[2] is None else row[2]
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, longest + 1):
                count[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    want = Counter()
    for lang, f in count.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in found.items():
            cuts = [(1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            longer = [b for o, b in found.items() if len(o) > len(p) and p in [o[i : i + len(p)] for i in range(len(o))]]
            if not any(100 * b >= cover * a for b in longer):
                ranked.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(ranked)[:first], 1):
            want[lang, rank, p.decode(), -a, left, right, n[lang], -s] += 1
    return want


TEXTS = "doc_id long, text string, lang string, source string, phrase string, n long, block int"


def odd_texts(seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = ["Der", "the", "maison", "né", "x|", "a\x00b", "▁", "New", "York", "city"]
    plain = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(n))
    texts = [None, "", " \t ", "..!?", "one", plain(30), plain(2_000), "new york city " * 40, "é" * 300, "A B. a b"]
    texts += [texts[5]] * 6 + [plain(rng.randint(1, 60)) for _ in range(60)]
    rows = [(i % 40, t, ["en", None, "de", "und", ""][i % 5 if i % 2 else 0], "s") for i, t in enumerate(texts)]
    return [(*r, "clash", 3, 4) for r in rows]


@pytest.mark.parametrize("least", [2, 12])
@pytest.mark.parametrize("layout", [{}, {"block_bytes": 500, "shards": 7}], ids=["one block", "many blocks"])
def test_phrases_by_brute_force(spark, least, layout):
    rows = odd_texts()
    got = phrases.collocations(spark.createDataFrame(rows, TEXTS).repartition(3), least=least, **layout)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute_phrases(rows, least)
    assert rows_of(got) == want and len(want) > 20


def test_phrases_options(spark):
    rows = odd_texts(9)
    table = spark.createDataFrame(rows, TEXTS)
    for options in ({"longest": 3, "first": 4, "cover": 70}, {"longest": 2}, {"longest": 5, "cover": 30}):
        assert rows_of(phrases.collocations(table, least=4, **options)) == brute_phrases(rows, 4, **options)


def test_phrases_of_no_text(spark):
    for rows in ([], odd_texts()[:4], odd_texts()[4:5]):
        assert phrases.collocations(spark.createDataFrame(rows, TEXTS)).count() == 0


def test_scores_pass_64_bits(spark):
    """The score's division is exact for counts of seventeen digits."""
    a, n, left, right = 99_999_999_999_999_999, 98_765_432_109_876_543, 99_999_999_999_999_999, 99_999_999_999_999_998
    row = spark.range(1).selectExpr(
        f"(CAST(1000 AS DECIMAL(4, 0)) * CAST({a}L AS DECIMAL(17, 0)) * CAST({n}L AS DECIMAL(17, 0)))"
        f" div (CAST({left}L AS DECIMAL(17, 0)) * CAST({right}L AS DECIMAL(17, 0))) AS s"
    )
    assert row.first()["s"] == 1000 * a * n // (left * right)
