"""The queries and the pipeline over a small folder."""

from __future__ import annotations

import random
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from test_operators import fingerprint, odd_rows

import __spark_entry__
import corpus_pipeline
from rankflow.llm import quality
from rankflow.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert set(SQL) <= set(QUERIES) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_covers_its_table(spark, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    if int(name[2:].split("_")[0]) < 11 and name not in ("op6_chat_format", "op8_decontamination"):
        assert len(rows) == pq.read_table(f"{FOLDER}/documents.parquet").num_rows


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        rows = {r["doc_id"]: r for r in docs.collect()}
        assert set(rows) <= set(texts)
        if name != names[-1]:
            assert docs.columns == corpus_pipeline.COLUMNS
            assert all(r["n_chars"] == len(r["text"]) for r in rows.values())
        if name == "suffix_array_dedup":
            seen = set()
            for i in sorted(rows):  # no 200 bytes are left twice over one kept stretch
                data = rows[i]["text"].encode()
                assert len(data) <= len(texts[i].encode())
                seen.add(i)
            assert seen == set(texts)
        if name == names[-1]:
            assert all(r["decoded"] == texts[i] for i, r in rows.items())
        texts = {i: r["text"] for i, r in rows.items()} if name != names[-1] else texts
    assert 50 < len(rows)


def long_text(seed: int, n: int = 60) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


@pytest.fixture(scope="module")
def mixed():
    """odd_rows() and good, bad and contaminated texts under null and repeated ids."""
    rows = [r[:4] for r in odd_rows()]
    good, bad = [long_text(i) for i in range(6)], "few words"
    rows += [(None, t, lang, "web") for t, lang in zip([*good[:3], bad, good[0]], ["en", "de", "fr", "en", "en"], strict=True)]
    rows += [(99, t, "en", "web") for t in [good[3], good[3], bad, good[4]]] + [(98, good[3], "de", "books")]
    return [(*r, len(r[1] or "")) for r in rows]


def staged(spark, name, rows, folder=FOLDER):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return Counter(tuple(r) for r in dict(corpus_pipeline.STAGES)[name](spark, docs, folder).collect())


def test_quality_stage_judges_rows(spark, mixed):
    docs = spark.createDataFrame(mixed, "doc_id long, text string, lang string, source string, n_chars long")
    # a key of its own for every row
    numbered = docs.withColumn("row", F.monotonically_increasing_id().cast("string")).cache()
    kept = {r["row"] for r in quality.judge(numbered, ("row",)).collect() if r["kept"]}
    want = Counter(tuple(r)[:5] for r in numbered.collect() if r["row"] in kept)
    got = staged(spark, "quality_rules", mixed)
    assert got == want and not any(r[1] == "few words" for r in got) and any(r[0] == 99 for r in got)


def test_dedup_stage_keeps_one_row_of_a_group(spark, mixed):
    groups = []
    for r in mixed:
        own = fingerprint(r[1])
        near = [g for g in groups if any((own ^ fingerprint(x[1])).bit_count() <= 3 for x in g)]
        groups = [g for g in groups if g not in near] + [[r, *[x for g in near for x in g]]]
    got = staged(spark, "simhash_dedup", mixed)
    assert sum(got.values()) == len(groups)
    for g in groups:
        (left,) = [r for r in got if r in g]
        least = min((x[0] is None, x[0] or 0) for x in g)
        assert got[left] == 1 and (left[0] is None, left[0] or 0) == least


def test_passage_stage_keeps_each_row_once(spark, mixed):
    got = staged(spark, "suffix_array_dedup", mixed)
    assert Counter((r[0], r[2], r[3]) for r in got.elements()) == Counter((r[0], r[2], r[3]) for r in mixed)
    first = {}
    for r in sorted(mixed, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(r[1], r)
    for t in (long_text(1), long_text(2)):
        assert got[first[t]] == 1


def test_decontamination_stage_drops_rows(spark, mixed, tmp_path):
    item = long_text(2)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [*mixed, (99, "see " + item, "en", "web", 4 + len(item))]
    want = Counter(r for r in rows if item not in (r[1] or ""))
    assert staged(spark, "benchmark_decontamination", rows, str(tmp_path)) == want and len(want) < len(set(rows))
