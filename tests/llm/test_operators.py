"""The operators of the llm subpackage against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from rankflow.llm import chat, common, decontaminate, license_scan, lpf_dedup, ngram_lm, quality, sentencepiece_codec, sharding, simhash, toxicity
from rankflow.llm import queries as llm_queries
from rankflow.llm.elias_fano import EliasFano, Levels, Trie
from rankflow.llm.packets import thaw
from rankflow.session import scoped_conf

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id long, size string, rank int"
PASSAGE = " ".join(f"w{i}passage" for i in range(60))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows, names that clash."""
    rng = random.Random(3)
    plain = lambda n: " ".join(rng.choice(["der", "the", "maison", "né", "x|", "long.\nline", "  "]) + str(rng.randint(0, 40)) for _ in range(n))
    texts = [None, "", "", " \t\n", "one", "two words", plain(40), plain(40), PASSAGE, "before " + PASSAGE + " after", plain(1_500)]
    texts += [texts[6]] * 3 + [texts[6] + " more"] + ["▁ a  b c\x00d", "é" * 400, "a" * 900]
    rows = [(i, t, ["en", None, "de"][i % 3], ["s", None][i % 2], None, 7, "clash", 1) for i, t in enumerate(texts)]
    return rows + [rows[6], (None, "null id " + PASSAGE, None, None, None, None, None, None), (3, "same id again", "en", "s", 1, 1, "", 1)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_text(frame, odd, *columns):
    """Multiset of (doc_id, …) for comparison with lists made from odd_rows()."""
    return Counter(tuple(r[c] for c in ("doc_id", *columns)) for r in frame.collect())


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def test_sentencepiece_is_the_library(odd, none):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = by_text(sentencepiece_codec.encode(odd, MODEL), odd, "n_tokens", "ids", "decoded")
    want = Counter()
    for row in odd_rows():
        ids = sp.encode(row[1] or "")
        want[row[0], len(ids), ",".join(map(str, ids)), sp.decode(ids)] += 1
    assert got == want
    assert sentencepiece_codec.encode(none, MODEL).count() == 0


def test_sentencepiece_chunks_and_ids_at_random():
    codec = sentencepiece_codec.Codec(open(MODEL, "rb").read())
    codec.check()
    rng = random.Random(1)
    letters = [*"abc the  \n\n\t▁é日😀.,!\x00\x0b1234567890", "  ", " the", " ation"]
    for _ in range(3000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 25)))
        ids = [i for w in codec.segment(sentencepiece_codec.chunks(text)) for i in w] if text else []
        assert ids == codec.sp.encode(text)
        mixed = [rng.randint(0, 300 if rng.random() < 0.3 else 31_999) for _ in range(rng.randint(0, 12))]
        assert codec.decode(np.array(mixed, dtype=np.int64)).decode() == codec.sp.decode(mixed)


def fingerprint(text: str | None) -> int:
    found = words(text)
    grams = [b" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))] if found else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_fingerprints_and_components(odd, none):
    rows = odd_rows()
    prints = [fingerprint(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[top(i)] = min(r[0], least.get(top(i), r[0]))
    want = Counter((r[0], f"{prints[i]:016x}", least.get(top(i))) for i, r in enumerate(rows))
    assert by_text(simhash.near_duplicates(odd), odd, "fingerprint", "component_id") == want
    assert simhash.near_duplicates(none).count() == 0


def as_signed(prints):
    return sorted(p - (1 << 64) if p >> 63 else p for p in prints)


def near(rng, base: int, most: int) -> int:
    for bit in rng.sample(range(64), rng.randint(0, most)):
        base ^= 1 << bit
    return base


def linked_by_brute_force(signed, most: int) -> set[frozenset]:
    parts = {p: {p} for p in signed}
    for i, a in enumerate(signed):
        for b in signed[i + 1 :]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= most and parts[a] is not parts[b]:
                parts[a] |= parts[b]
                for p in parts[b]:
                    parts[p] = parts[a]
    return {frozenset(p) for p in parts.values()}


def groups(rows) -> set[frozenset]:
    found = defaultdict(set)
    for r in rows:
        found[r["comp"]].add(r["fp"])
    return {frozenset(p) for p in found.values()}


def test_trie_finds_all_components(spark):
    seed = 5
    rng = random.Random(seed)
    prints = {rng.getrandbits(64) for _ in range(300)}
    centre = rng.getrandbits(64)
    prints |= {near(rng, p, 4) for p in list(prints)[:60]}
    prints |= {near(rng, centre, 4) for _ in range(120)} | {near(rng, ~centre & (1 << 64) - 1, 9) for _ in range(80)}
    for p in list(prints)[:20]:  # chains of links of exactly 3 bits
        for step in range(5):
            p ^= 0b111 << (7 * step + seed)
            prints.add(p)
    signed = as_signed(prints)
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    want = linked_by_brute_force(signed, 3)
    whole = {p: part for part in linked_by_brute_force(signed, 2) for p in part}
    labels = simhash._labels(simhash._spot_links(frame)).collect()
    assert len(labels) > 80 and all(whole[r["fp"]] == whole[r["comp"]] for r in labels)
    assert groups(simhash.linked(frame).collect()) == want
    assert 1 < len(want) < len(linked_by_brute_force(signed, 2)) < len(signed)


def test_dense_groups_are_not_all_compared(spark, monkeypatch):
    """2,000 fingerprints within 6 bits of one centre have 2 million pairs; the walk compares a small part."""
    counts = []
    plain = simhash._compared

    def counted(*args):
        counts.append(plain(*args).count())
        return plain(*args)

    monkeypatch.setattr(simhash, "_compared", counted)
    rng, centre, size = random.Random(1), 0x0123456789ABCDEF, 2000
    pool = list(dict.fromkeys(near(rng, centre, 6) for _ in range(8_000)))[:size]
    frame = spark.createDataFrame([(p,) for p in as_signed(pool)], "fp long")
    labels = simhash._labels(simhash._spot_links(frame))
    simhash._walked(frame.join(labels, "fp", "left").selectExpr("fp", "coalesce(comp, fp) AS comp")).count()
    assert sum(counts) <= 100 * size, counts


@pytest.mark.parametrize("first", [False, True])
def test_repeats_are_those_of_brute_force(odd, none, monkeypatch, first):
    for name, value in {"BLOCK_BYTES": 60_000, "SHARD_BYTES": 40_000, "PIECE": 2_000, "BATCH": 400}.items():
        monkeypatch.setattr(lpf_dedup, name, value)
    length, rows = 200, [(r[0], (r[1] or "").encode()) for r in odd_rows()]
    seen, place = Counter(), {}
    for doc, text in rows:
        for i in range(len(text) - length + 1):
            own = text[i : i + length]
            seen[own] += 1
            order = (math.inf if doc is None else doc, i)
            place[own] = min(place.get(own, order), order)
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in lpf_dedup.remove_repeats(odd, length, first).collect())
    want, lead = Counter(), set()
    for doc, text in rows:
        covered = bytearray(len(text))
        for i in range(len(text) - length + 1):
            own = text[i : i + length]
            order = (math.inf if doc is None else doc, i)
            # of equal places in repeated rows one is the first
            is_first = place[own] == order and (own not in lead)
            if first and is_first:
                lead.add(own)
            if seen[own] > 1 and not (first and is_first):
                covered[i : i + length] = b"\1" * length
        kept = bytes(b for b, c in zip(text, covered, strict=True) if not c)
        want[doc, len(text), sum(covered), len(bytes(covered).replace(b"\0", b" ").split()), kept] += 1
    assert got == want
    assert lpf_dedup.remove_repeats(none).count() == 0


def test_whole_characters_stay_valid(spark):
    same = "é" * 300
    docs = spark.createDataFrame([(1, "a" + same), (2, same + "z"), (3, "日" + same)], "doc_id long, text string")
    for r in lpf_dedup.remove_repeats(docs, whole_characters=True).collect():
        bytes(r["kept"]).decode()


def test_elias_fano_and_trie():
    rng = np.random.default_rng(0)
    for n, top in ((1, 5), (10, 20), (1000, 10**6), (5000, 3000), (3000, 2**40)):
        values = np.sort(rng.integers(0, top, n))
        sequence = EliasFano(values, Levels())
        assert (sequence.get(np.arange(n)).astype(np.int64) == values).all()
        asked = np.concatenate([values, rng.integers(0, top + 100, 500)])
        zero = np.zeros(len(asked), dtype=np.int64)
        at, hit = sequence.successor(asked, zero, zero + n)
        assert (at == np.searchsorted(values, asked)).all() and (hit == np.isin(asked, values)).all()
    keys = np.unique(rng.integers(0, 300, 20_000) << 32 | rng.integers(1, 5000, 20_000))
    context, word = keys >> 32, keys & 0xFFFFFFFF
    value = -rng.random(len(keys))
    trie = Trie(context, word, value, -np.floor(context / 20.0))
    c, w = np.append(context, rng.integers(0, 400, 9000)), np.append(word, rng.integers(1, 5100, 9000))
    known, _, pair, found = trie.find(c, w)
    assert (known == np.isin(c, context)).all() and (pair == np.isin(c << 32 | w, keys)).all()
    assert np.abs(found[: len(keys)] - value).max() < 0.0003
    with pytest.raises(OverflowError):
        Trie(context[:1], word[:1], np.array([-40.0]), np.array([0.0]))
    empty = np.zeros(0, dtype=np.int64)
    assert not Trie(empty, empty, empty.astype(float), empty.astype(float)).find(c, w)[2].any()


def test_scores_do_not_depend_on_the_layout(spark, odd, monkeypatch):
    """Many blocks and shards, any partitions: the same scores, to the rounding of sums."""
    text = spark.createDataFrame([(1000 + i, " ".join(f"w{(i * 7 + j * j) % 90}" for j in range(80)), "en", "s", 0, 0, "", 0) for i in range(120)], SCHEMA)
    docs = odd.unionByName(text)
    runs = []
    for blocks, shards, parts in ((None, None, 3), (3_000, 20_000, 7), (9_000, 4_000, 3)):
        if blocks:
            monkeypatch.setattr(ngram_lm, "BLOCK_BYTES", blocks)
            monkeypatch.setattr(ngram_lm, "SHARD_BYTES", shards)
        rows = ngram_lm.score(docs.repartition(parts)).collect()
        runs.append(sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["score"]) for r in rows))
    for other in runs[1:]:
        assert [r[:2] for r in other] == [r[:2] for r in runs[0]]
        assert max(abs(a[2] - b[2]) for a, b in zip(runs[0], other, strict=True)) < 1e-6


def test_scores_are_those_of_the_model(odd, none):
    rows = odd_rows()
    held = [zlib.crc32(b"" if r[0] is None else b"%d" % r[0]) % 7 == 2 for r in rows]
    texts = [[*words(r[1]), b"\n"] for r in rows]
    one, two = Counter(), Counter()
    for text, out in zip(texts, held, strict=True):
        if not out:
            one.update(text)
            two.update(zip([b"", *text], text, strict=False))
    total, kinds = sum(one.values()), len(one)
    p = lambda w: (one[w] + 1) / (total + kinds + 1)
    seen = one | Counter({b"": one[b"\n"]})

    def log(v, w):
        m = 2 * seen[v] + 2
        return math.log10((two[v, w] + m * p(w)) / (seen[v] + m)) if seen[v] else math.log10(p(w))

    want = []
    for r, text, out in zip(rows, texts, held, strict=True):
        base = sum(math.log10(p(w)) for w in text)
        score = sum(log(v, w) for v, w in zip([b"", *text], text, strict=False))
        want.append((-1 if r[0] is None else r[0], out, len(text), sum(one[w] > 0 for w in text), total, base, score))
    got = [(-1 if r["doc_id"] is None else r["doc_id"], *r[1:]) for r in ngram_lm.score(odd).collect()]
    assert len(got) == len(want)
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[:5] == b[:5]
        assert a[5] == pytest.approx(b[5], abs=1e-6) and a[6] == pytest.approx(b[6], rel=0.02, abs=0.05)
    assert ngram_lm.score(none).count() == 0


def test_toxicity_learns_and_points(spark, none):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(400):
        toxic = i % 5 == 1 or i % 7 == 1
        lines = [" ".join(f"w{rng.randint(0, 50)}" for _ in range(8)) + "." for _ in range(6)]
        if toxic:
            lines[3] = "you are an idiot w1 w2."
        docs.append((i, " ".join(lines)))
        labels.append((i, int(toxic), None))
    docs += [(None, None), (1000, ""), (1001, "w1 " * 20_000)]
    labels += [(None, 1, 1), (1000, None, 0), (3, 0, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    truth = spark.createDataFrame(labels, "doc_id long, toxic int, score int")
    got = {r["doc_id"]: r for r in toxicity.score(frame, truth).collect()}
    assert len(got) == len(docs)
    told = [(got[i], t) for i, t, _ in labels if i is not None and t is not None and got[i]["held_out"]]
    assert told and all(r["predicted"] == t for r, t in told)
    assert [s["sentence"] for s in got[1]["offending"]] == [3]
    assert got[None]["score"] == got[1000]["score"] and not got[1001]["predicted"]
    assert toxicity.score(none, truth).count() == 0
    assert toxicity.score(frame, truth.limit(0)).count() == len(docs)


def test_licences(spark, odd, none):
    apache = "".join(license_scan.SENTENCES[i] + ".\n" for i in (2, 3))
    texts = [None, "", "Hi. Released under the MIT License. Bye", apache + "All rights reserved.", "licence, but none known", "x " * 5_000 + "\nLicensed under CC BY-NC 4.0."]
    frame = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "doc_id long, text string, rules int")
    got = [(r["rules"], r["licences"]) for r in sorted(license_scan.scan(frame).collect())]
    assert got[:3] == [("", ""), ("", ""), ("mit-line@1", "MIT")]
    assert got[3] == ("apache-2.0-header@0,proprietary-line@2", "Apache-2.0,LicenseRef-proprietary")
    assert got[4:] == [("", ""), ("cc-by-nc-4.0-line@1", "CC-BY-NC-4.0")]
    assert license_scan.scan(odd).count() == len(odd_rows()) and license_scan.scan(none).count() == 0
    assert all(any(stem in s.lower() for stem in license_scan.STEMS) for s in license_scan.SENTENCES.values())


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software"""
MIT = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""


def test_wrapped_licences(spark):
    notices = {"apache-2.0-header@0": (APACHE, 2), "mit-text@2": (MIT, 2), "bsd-2-clause-text@0": (BSD, 3), "gpl-3.0-notice@0": (GPL, 2)}
    forms = [
        lambda t: t,
        lambda t: t.replace("\n", "\r\n"),
        lambda t: "\n".join("# " + x for x in t.split("\n")),
        lambda t: "\n".join(" * " + x for x in t.split("\n")),
        lambda t: t.replace("1. ", "(1) ").replace("2. ", "b) "),
        lambda t: " ".join(t.split()) if "MIT License" not in t and "http" not in t else t,
        lambda t: "\n".join(t.split(" ")) if "1. " not in t and "MIT License" not in t else t,
    ]
    texts, want = [], []
    for rule, (notice, known) in notices.items():
        for form in forms:
            texts.append(form(notice))
            want.append((known, rule))
    odd = [BSD.replace("2. Redis", "Another line.\n2. Redis"), MIT.replace("copies of the Software, and", "copies of the thing, and"), "All\n# rights\n# reserved", "the\n" * 3000 + MIT, "All rights reserved. " * 3000]
    texts += odd
    want += [(3, ""), (1, ""), (1, "proprietary-line@0"), (2, "mit-text@3002"), (3000, ",".join(f"proprietary-line@{i}" for i in range(3000)))]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [(r["n_sentences_known"], r["rules"]) for r in sorted(license_scan.scan(frame).collect())]
    for text, a, b in zip(texts, got, want, strict=True):
        assert a == b, text[:300]


def test_own_sentences_and_rules(spark):
    frame = spark.createDataFrame([(1, "Do as\n\nyou wish.\n\n3. No more of it! End"), (2, "You do as you wish. No more of it")], "doc_id long, text string")
    got = license_scan.scan(frame, {1: "Do as you wish", 2: "No more of it", 3: "as you"}, [("free", "X", [1, 2])]).collect()
    assert sorted(tuple(r) for r in got) == [(1, 2, "free@0", "X"), (2, 1, "", "")]


def test_perspectives(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|x"), (1, 2, "bob b", None), (1, 3, None, ""), (1, 3, None, ""), (2, 0, "system", "alone"), (None, None, "ann", "first")]
    turns += [(5, i, "ann" if i % 2 else "bob", f"t{i}") for i in range(3000)]
    frame = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, seq int")
    rows = chat.rotate(frame).collect()
    dialogues = {}
    for r in sorted(rows, key=lambda r: (r["conv_id"] or 0, r["perspective"], r["seq"])):
        said = dialogues.setdefault((r["conv_id"], r["perspective"]), [])
        assert r["seq"] == len(said) and r["begin"] == sum(map(len, said)) and r["end"] - r["begin"] == len(r["segment"])
        said.append(r["segment"])
        if r["mask"]:
            assert "".join(said)[r["train_begin"] : r["train_end"]].endswith("<|im_end|>")
    assert set(dialogues) == {(1, "ann"), (1, "bob_b"), (1, "unknown"), (5, "ann"), (5, "bob"), (None, "ann")}
    assert "".join(dialogues[1, "ann"][:3]) == "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi < |x<|im_end|>\n<|im_start|>user name=bob_b\n<|im_end|>\n"
    assert chat.rotate(frame.limit(0)).count() == 0


def test_containment(spark, odd, none):
    items = [(1, PASSAGE, 0), (2, PASSAGE.replace("w5p", "W5P") + " tail", 0), (3, "too short", 0), (None, "a b c d e f", 0), (4, None, 0), (5, " ".join(f"w{i}passage" for i in range(0, 120)), 0)]
    bench = spark.createDataFrame(items, "item_id long, text string, doc_id int")
    grams = lambda t: {tuple(words(t)[i : i + 5]) for i in range(len(words(t)) - 4)}
    want = {}
    for r in odd_rows():
        for item, text, _ in items:
            if grams(text) and (n := len(grams(text) & grams(r[1]))) * 100 >= 80 * len(grams(text)):
                want[r[0], item] = max(n, want.get((r[0], item), 0))
    got = decontaminate.contained(odd, bench).collect()
    assert {(r["doc_id"], r["item_id"]): r["n_shared"] for r in got} == want and len(got) == len(want) > 3
    assert decontaminate.contained(none, bench).count() == 0 == decontaminate.contained(odd, bench.limit(0)).count()


def test_shards(odd, none):
    rows = sharding.shard_documents(odd, 4).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in odd_rows())
    for shard in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    home = {}
    for r in odd_rows():
        own = {x["shard"] for x in rows if x["doc_id"] == r[0] and x["text_crc32"] == zlib.crc32((r[1] or "").encode())}
        if r[0] is not None and r[1]:
            assert len(own | home.get(r[1], own)) == 1
            home[r[1]] = own
    assert sharding.shard_documents(none).count() == 0


def test_minimax_capacity_is_least():
    rng = random.Random(2)
    for _ in range(200):
        sizes = sorted((rng.randint(1, 30) for _ in range(rng.randint(1, 12))), reverse=True)
        k = rng.randint(1, 5)
        plan = sharding.Sizes(list(Counter(sizes).items()))

        def parts(c, sizes=sizes):
            count, room = 0, 0
            for s in sizes:
                if s > room:
                    count, room = count + 1, c
                room -= s
            return count

        least = next(c for c in range(max(sizes), sum(sizes) + 1) if parts(c) <= k)
        assert plan.capacity(0, k) == least


def test_quality_counts_and_odd_rows(odd, none):
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in quality.judge(odd).collect())
    want = Counter()
    for r in odd_rows():
        text = r[1] or ""
        own = text.encode().split()
        windows = [tuple(own[i : i + 8]) for i in range(len(own) - 7)]
        seen, marked = Counter(windows), set()
        for i, w in enumerate(windows):
            if seen[w] > 1:
                marked |= set(range(i, i + 8))
        lines = [x for x in text.split("\n") if x.encode().split()]
        failed = len(own) < 20 or 100 * len(marked) > 30 * len(own)
        want[r[0], len(own), sum(len(w.decode()) for w in own), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(marked), failed] += 1
    assert got == want
    assert quality.judge(none).count() == 0


def test_windows_with_equal_fingerprints_are_counted_exactly(monkeypatch):
    monkeypatch.setattr(quality, "mix64", lambda x: np.zeros(len(x), dtype=np.uint64))
    ids = np.array([*range(8), *range(8), *range(20, 40)])
    assert quality.repeated_words(ids, np.array([0, 16, 36])).tolist() == [16, 0]


def test_kept_digest_is_of_all_other_bytes(spark):
    docs = spark.createDataFrame([(1, "x" + PASSAGE), (2, PASSAGE)], "doc_id long, text string")
    got = {r["doc_id"]: bytes(r["kept"]) for r in lpf_dedup.remove_repeats(docs, keep_first=False).collect()}
    assert hashlib.sha256(got[1]).hexdigest() == hashlib.sha256(b"x").hexdigest() and got[2] == b""


def quality_rows(lang: str, symbols: int, repeats: int, n: int = 150) -> list[tuple]:
    """Documents of 200 different words: every fifth has up to ``symbols`` symbol words, every thirtieth ``repeats`` repeated words."""
    rows = []
    for i in range(n):
        own = [f"{lang}{i}w{j}" for j in range(200)]
        for j in range(symbols * (i % 5 == 0) + (i % 3 == 0)):
            own[j * 6] = "#"
        if repeats and i % 30 == 0:
            own[100 : 100 + repeats] = own[:repeats]
        rows.append((i, " ".join(own), lang, "s", None, 0, "", 0))
    return rows


def test_quality_fences_follow_their_group(spark):
    """Two languages with different distributions: the same document passes in one and fails in the other."""
    probe = " ".join("#" if j % 10 == 3 else f"p{j}" for j in range(200))
    twice = " ".join([f"r{j}" for j in range(20)] * 2 + [f"x{j}" for j in range(160)])  # 20 % of the words repeat
    rows = [*quality_rows("aa", 30, 25), *quality_rows("bb", 1, 0)]
    rows += [(900, probe, "aa", "s", None, 0, "", 0), (901, probe, "bb", "s", None, 0, "", 0)]
    rows += [(902, twice, "aa", "s", None, 0, "", 0), (903, twice, "bb", "s", None, 0, "", 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    fences = {r["group_key"]: r for r in quality.thresholds(quality.measure(frame)).collect()}
    assert len({r["symbol_rate_most"] for r in fences.values()}) == 2
    found = {r["doc_id"]: r for r in quality.judge(frame).collect() if r["doc_id"] >= 900}
    assert [found[i]["kept"] for i in (900, 901)] == [True, False]
    assert found[903]["repeat_rate"] < 300 and not found[903]["base_failed"] and not found[903]["kept"]
    assert found[902]["kept"]  # where a thirtieth repeats a quarter of its words, a fifth is no outlier


def test_quality_fences_follow_their_group_at_equal_word_lengths(spark):
    """As above, with words as long as those of the group, so that symbols and repeats alone decide."""
    probe = " ".join("#" if j % 10 == 3 else f"pp900w{j}" for j in range(200))
    twice = " ".join([f"rr900w{j}" for j in range(20)] * 2 + [f"xx900w{j}" for j in range(160)])
    rows = [*quality_rows("aa", 30, 25), *quality_rows("bb", 1, 0)]
    rows += [(i, t, lang, "s", None, 0, "", 0) for i, t, lang in ((900, probe, "aa"), (901, probe, "bb"), (902, twice, "aa"), (903, twice, "bb"))]
    found = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [found[i] for i in (900, 901, 902, 903)] == [True, False, True, False]


def longer_model(rows: list[tuple], order: int) -> dict:
    """n_tokens and score of each row by its key (id or -1, text), by brute force over n-grams of up to ``order`` words."""
    held = [zlib.crc32(b"" if r[0] is None else b"%d" % r[0]) % 7 == 2 for r in rows]
    texts = [[b"", *words(r[1]), b"\n"] for r in rows]
    grams = Counter()
    for text, out in zip(texts, held, strict=True):
        if not out:
            grams.update(tuple(text[i : i + n]) for n in range(1, order + 1) for i in range(len(text) - n + 1))
    single = {g: c for g, c in grams.items() if len(g) == 1 and g != (b"",)}
    norm = sum(single.values()) + len(single) + 1

    def p(gram: tuple) -> float:
        if len(gram) == 1:
            return (grams[gram] + 1) / norm
        c = grams[gram[:-1]]
        return (grams[gram] + (2 * c + 2) * p(gram[1:])) / (3 * c + 2) if c else p(gram[1:])

    return {
        (-1 if r[0] is None else r[0], r[1]): (len(text) - 1, sum(math.log10(p(tuple(text[max(0, i - order + 1) : i + 1]))) for i in range(1, len(text))))
        for r, text in zip(rows, texts, strict=True)
    }


def longer_rows() -> list[tuple]:
    rng = random.Random(8)
    lines = [" ".join(f"w{rng.randint(0, 25)}" for _ in range(rng.randint(1, 12))) for _ in range(40)]
    return [(2000 + i, " ".join(rng.choice(lines) for _ in range(6)), "en", "s", 0, 0, "", 0) for i in range(90)]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores_follow_longer_contexts(spark, odd, monkeypatch, order):
    """N-grams of every level, in one block and shard and in many, against brute force."""
    rows = [*odd_rows(), *longer_rows()]
    docs = odd.unionByName(spark.createDataFrame(longer_rows(), SCHEMA))
    want = sorted((i, *v) for (i, _), v in ((k, v) for k, v in longer_model(rows, order).items()) if i >= 2000)
    for blocks, shards, parts in ((None, None, 3), (3_000, 8_000, 5)):
        if blocks:
            monkeypatch.setattr(ngram_lm, "BLOCK_BYTES", blocks)
            monkeypatch.setattr(ngram_lm, "SHARD_BYTES", shards)
        found = ngram_lm.score(docs.repartition(parts), order=order).collect()
        got = sorted((r["doc_id"], r["n_tokens"], r["score"]) for r in found if (r["doc_id"] or 0) >= 2000)
        assert len(found) == len(rows) and [r[:2] for r in got] == [r[:2] for r in want]
        # a step is at most 1/4096 off, once a level and token
        assert all(abs(a[2] - b[2]) < a[1] * order / 4000 for a, b in zip(got, want, strict=True))


def test_answers_about_ngrams_are_small(spark, monkeypatch):
    """Counts alone come back from the shards: under two thirds of the questions' bytes, and both together under one byte a word and level."""
    rng = random.Random(3)
    common_words = [f"w{int(rng.paretovariate(0.6)) % 3000}" for _ in range(60_000)]
    rows = [(i, " ".join(common_words[i * 300 : i * 300 + 300]), "en", "s", 0, 0, "", 0) for i in range(200)]
    monkeypatch.setattr(ngram_lm, "BLOCK_BYTES", 60_000)
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 120_000)
    real, asked, told = ngram_lm.answer, [], []

    def measured(messages, work):
        answers = common.cut(real(messages, work))
        for frame, sizes in ((messages, asked), (answers, told)):
            sizes.append(frame.agg(F.sum(F.length("payload"))).first()[0])
        return answers

    monkeypatch.setattr(ngram_lm, "answer", measured)
    assert ngram_lm.score(spark.createDataFrame(rows, SCHEMA), order=3).count() == 200
    assert len(asked) == len(told) == 3
    assert 0 < sum(told[1:]) * 3 < sum(asked[1:]) * 2
    assert sum(told[1:]) + sum(asked[1:]) < 2 * 60_000


def test_ids_over_32_bits_keep_their_counts():
    """Shards count n-grams by their words, however large the ids."""
    rng = np.random.default_rng(5)
    grams = [np.unique(rng.integers(1, 12, (150, 3)), axis=0) for _ in range(4)]
    trained = [rng.integers(0, 3, len(g)) for g in grams]
    want = Counter()
    for own, n in zip(grams, trained, strict=True):
        for gram, count in zip(map(tuple, own.tolist()), n.tolist(), strict=True):
            want[gram] += count
    for scale in (1, 1 << 33):
        sent = [thaw(ngram_lm._message(list(g.T * scale), n)) for g, n in zip(grams, trained, strict=True)]
        for own, answer in zip(grams, map(thaw, ngram_lm._score(3, False)(sent)), strict=True):
            assert answer["seen"].tolist() == [want[tuple(g)] for g in own.tolist()]
            shared = [sum((g == other).all(axis=1).any() for other in grams) for g in own]
            assert np.unpackbits(answer["only"], count=len(own)).tolist() == [int(n == 1) for n in shared]


def test_tokens_are_words_between_ascii_blanks():
    rng = random.Random(6)
    texts = [bytes(rng.choices(b" \t\n\x0b\x0c\r\x00\x1c\x1f\x85\xa0\xc2\xe3\xffAZaz[@", k=rng.randint(0, 30))) for _ in range(400)]
    for own in (texts, texts[3:40], [b"", b" "], []):
        table = pa.table({"text": pa.array(own, pa.binary())})
        found, index, counts = ngram_lm.tokens(table)
        want = [w for t in own for w in [*t.lower().split(), ngram_lm.END]]
        assert found.take(pa.array(index)).to_pylist() == want and counts.tolist() == [len(t.split()) + 1 for t in own]


def test_op5_models_more_than_pairs(spark, tmp_path):
    """The query's score is that of words under two words before them."""
    rows = longer_rows()
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    three, two = longer_model(rows, 3), longer_model(rows, 2)
    texts = {r[0]: r[1] for r in rows}
    found = llm_queries.op5_lm_scoring(spark, str(tmp_path)).collect()
    for r in found:
        n, score = three[r["doc_id"], texts[r["doc_id"]]]
        assert r["n_tokens"] == n and abs(r["score"] - score) < n * 3 / 4000
    assert abs(sum(r["score"] for r in found) - sum(v[1] for v in two.values())) > 50


def test_small_results_are_stored_in_few_files(spark):
    """What a step of many partitions leaves goes to a few files, and nothing of it stays in the cache."""
    many = spark.range(1000).repartition(97).withColumn("k", F.col("id") % 7)
    kept = common.store(many)
    assert kept.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert sorted(kept.collect()) == [(i, i % 7) for i in range(1000)] and not many.is_cached
    assert common.store(many.where("false")).count() == 0


def test_near_duplicates_leave_few_files(spark, odd, tmp_path):
    """The steps of the search over 60 partitions: a part file for each task at a time, not for each partition."""
    parts = []
    context, before = spark.sparkContext, spark.sparkContext.getCheckpointDir()
    context.setCheckpointDir(str(tmp_path))
    try:
        with scoped_conf(spark, {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}):
            found = simhash.near_duplicates(odd.repartition(60))
            parts = [len(list(folder.glob("part-*"))) for folder in tmp_path.glob("*/rdd-*")]
            assert len(parts) >= 5 and max(parts) <= context.defaultParallelism
            assert found.count() == odd.count()
    finally:
        if before is not None:
            context.setCheckpointDir(os.path.dirname(before.removeprefix("file:")))
