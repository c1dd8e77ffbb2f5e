"""Licence scans by sentence rules, in built-in expressions only.

A text is cut into pieces at line feeds, sentence ends, colons and list marks. A known
licence sentence is found where it equals one piece or several neighbouring ones, so
wrapped and commented notices count as much as one-line ones; of sentences that begin
at one piece the longest counts. Rules are sequences of sentences with nothing but blank
lines and list numbers between them, tried longest first at every place; a match that
begins inside an earlier match is part of that. Everything happens within the row of
a document: no shuffle, no key that could be hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sentences of licence notices, by identifier.
SENTENCES = {
    1: "Licensed under the Apache License, Version 2.0",
    2: 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License',
    3: "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    4: "Released under the MIT License",
    5: "This project is licensed under the MIT License",
    6: 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    7: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    8: "This work is licensed under the GNU General Public License, version 3",
    9: "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    10: "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    11: "Licensed under CC BY-NC 4.0",
    12: "This work is licensed under CC BY 4.0",
    13: "All rights reserved",
    14: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    15: "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    16: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution",
}
#: Rule, licence, sequence of sentences.
RULES = [
    ("apache-2.0-header", "Apache-2.0", [2, 3]),
    ("apache-2.0-line", "Apache-2.0", [1]),
    ("apache-2.0-terms", "Apache-2.0", [2]),
    ("mit-text", "MIT", [6, 7]),
    ("mit-line", "MIT", [4]),
    ("mit-project-line", "MIT", [5]),
    ("gpl-3.0-notice", "GPL-3.0-or-later", [9, 10]),
    ("gpl-3.0-line", "GPL-3.0-only", [8]),
    ("cc-by-nc-4.0-line", "CC-BY-NC-4.0", [11]),
    ("cc-by-4.0-line", "CC-BY-4.0", [12]),
    ("proprietary-line", "LicenseRef-proprietary", [13]),
    ("bsd-2-clause-text", "BSD-2-Clause", [14, 15, 16]),
]
#: Every known sentence holds one of these; texts without any need no further look.
STEMS = ("licen", "permission", "redistribut", "copyright", "rights reserved", "warrant")
#: A sentence ends at a line feed, or at . ! ? before white space or the end of the text.
SENTENCE_END = r"[.!?]+[ \t\n\r]+|[.!?]+$|\n"
OUTSIDE = r"[^a-z0-9.]+"
#: Inside a line, a known sentence may also end at a colon, and begin after a list mark such as (1) or a).
COLON = r":[ \t]+|\n"
LIST_MARK = r"^([^A-Za-z0-9]*([0-9]{1,3}|[A-Za-z])\))[ \t]+"
#: A piece that only numbers what follows; it may stand between the sentences of a rule.
LIST_NUMBER = r"^([0-9]{1,3}|[a-z]|[ivx]{1,4})\.?$"


def normalised(sentence: Column) -> Column:
    """Lower case, everything but letters, digits and dots as one blank, no blanks around."""
    return F.trim(F.regexp_replace(F.lower(sentence), OUTSIDE, " "))


def plain(sentence: str) -> str:
    """``normalised`` for the fixed sentences."""
    kept = "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789." else " " for c in sentence.lower())
    return " ".join(kept.split()).rstrip(".")


def _pieces(text: Column) -> Column:
    """The pieces of a text that hold a letter or digit: s, normalised, and the number i of their sentence."""
    sentences = F.split(F.regexp_replace(text, SENTENCE_END, "\n"), "\n")
    parts = F.transform(
        sentences,
        lambda x, i: F.transform(
            F.split(F.regexp_replace(x, LIST_MARK, "$1\n"), COLON), lambda y: F.struct(normalised(y).alias("s"), i.alias("i"))
        ),
    )
    return F.filter(F.flatten(parts), lambda p: p["s"] != "")


def _known(found: DataFrame, sentences: dict[int, str]) -> DataFrame:
    """Add ``hits``: the known sentences in ``pieces``, with first piece k, number of pieces m and place i."""
    texts = sorted(((plain(s), i) for i, s in sentences.items()), key=lambda x: -len(x[0]))
    known = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(i).alias("id")) for s, i in texts])
    longest = len(texts[0][0])
    # a piece has a word at least, so no sentence has more pieces than words
    most = max(len(s.split()) for s, _ in texts)
    # a piece longer than any sentence can't be part of one
    found = found.withColumn("short", F.transform("pieces", lambda p: F.substring(p["s"], 1, longest + 1)))

    def ahead(p: Column, k: Column) -> Column:
        joined = F.substring(F.array_join(F.slice("short", k + 1, most), "\n"), 1, longest + 1)
        begun = F.exists(known, lambda y: F.startswith(y["s"], p["s"]))
        return F.when(begun, F.struct(k.alias("k"), p["i"].alias("i"), joined.alias("text")))

    found = found.withColumn("begun", F.filter(F.transform("pieces", ahead), lambda x: x.isNotNull()))

    def whole(x: Column) -> Column:
        """The longest sentence that the text ahead begins with and that ends where a piece does."""
        n = lambda y: F.length(y["s"])
        return F.get(
            F.filter(
                known,
                lambda y: F.startswith(F.translate(x["text"], "\n", " "), y["s"])
                & F.substr(x["text"], n(y) + 1, F.lit(1)).isin("", "\n"),
            ),
            0,
        )

    tried = F.transform("begun", lambda x: F.struct(x["k"].alias("k"), x["i"].alias("i"), x["text"].alias("text"), whole(x).alias("y")))
    tried = F.filter(tried, lambda x: x["y"].isNotNull())
    breaks = lambda x: F.regexp_count(F.substr(x["text"], F.lit(1), F.length(x["y"]["s"])), F.lit("\n"))
    every = F.transform(
        tried, lambda x: F.struct(x["y"]["id"].alias("id"), x["k"].alias("k"), x["i"].alias("i"), (breaks(x) + 1).alias("m"))
    )
    found = found.withColumn("every", every)
    # what begins inside an earlier sentence is part of that
    before = lambda j: F.slice("every", F.greatest(j - most, F.lit(0)) + 1, F.least(j, F.lit(most)))
    clear = lambda h, j: ~F.exists(before(j), lambda e: e["k"] + e["m"] > h["k"])
    return found.withColumn("hits", F.filter("every", clear)).drop("short", "begun", "every")


def scan(docs: DataFrame, sentences: dict[int, str] | None = None, rules: list[tuple] | None = None) -> DataFrame:
    """Licence rules that match in each text of ``docs`` (doc_id, text, any others).

    ``sentences`` (text by identifier) and ``rules`` (name, licence, identifiers) replace
    the fixed ones. Returns doc_id, n_sentences_known, rules (rule and number of the
    sentence or line it begins in, from 0, joined: 'mit-line@3,…', in order) and licences
    (distinct, sorted, joined by commas). No match gives empty strings, and so do null
    and empty texts; repeated rows are scanned one by one; an empty table gives no rows.
    """
    sentences, rules = sentences or SENTENCES, rules or RULES
    ordered = sorted(rules, key=lambda r: -len(r[2]))
    text = F.coalesce(F.col("text"), F.lit(""))
    looked = F.lit(True)
    if all(any(stem in s.lower() for stem in STEMS) for s in sentences.values()):
        lowered, looked = F.lower(text), F.lit(False)
        for stem in STEMS:
            looked |= lowered.contains(stem.split()[-1])  # the words of a stem may be on two lines
    none = F.array().cast("array<struct<s: string, i: int>>")
    found = docs.select("doc_id", F.when(looked, _pieces(text)).otherwise(none).alias("pieces"))
    found = _known(found, sentences)

    def next_to(h: Column, j: Column) -> Column:
        """Nothing but list numbers stands between this known sentence and the next."""
        end = h["k"] + h["m"]
        gap = F.greatest(F.get("hits", j + 1)["k"] - end, F.lit(0))
        return F.coalesce(F.forall(F.slice("pieces", end + 1, gap), lambda p: p["s"].rlike(LIST_NUMBER)), F.lit(False))

    found = found.withColumns({"ids": F.transform("hits", lambda h: h["id"]), "near": F.transform("hits", next_to)})

    def rule_at(i: Column) -> Column:
        """Number of the first rule that matches from known sentence i on, from 1; 0 for none."""
        number = F.lit(0)
        for k in range(len(ordered), 0, -1):
            sequence = ordered[k - 1][2]
            same = F.get(F.col("ids"), i) == sequence[0]
            for step, wanted in enumerate(sequence[1:], 1):
                follows = (F.get(F.col("ids"), i + step) == wanted) & F.get(F.col("near"), i + (step - 1))
                same &= F.coalesce(follows, F.lit(False))
            number = F.when(same, k).otherwise(number)
        return number

    lengths = F.array(F.lit(0), *[F.lit(len(r[2])) for r in ordered])
    longest = len(ordered[0][2])
    names = F.array(F.lit(""), *[F.lit(r[0]) for r in ordered])
    licences = F.array(F.lit(""), *[F.lit(r[1]) for r in ordered])
    found = found.withColumn("at", F.transform("ids", lambda x, i: rule_at(i)))

    def free(i: Column) -> Column:
        """No match that begins before known sentence i reaches it."""
        clear = F.lit(True)
        for back in range(1, longest):
            reach = F.get(lengths, F.when(i >= back, F.get(F.col("at"), i - back)).otherwise(0))
            clear &= F.coalesce(reach, F.lit(0)) <= back
        return clear

    matches = F.filter(
        F.transform("at", lambda k, i: F.when((k > 0) & free(i), F.struct(k.alias("k"), F.get("hits", i)["i"].alias("i")))),
        lambda h: h.isNotNull(),
    )
    found = found.withColumn("matches", matches)
    shown = F.transform("matches", lambda h: F.concat(F.get(names, h["k"]), F.lit("@"), h["i"].cast("string")))
    own = F.array_sort(F.array_distinct(F.transform("matches", lambda h: F.get(licences, h["k"]))))
    return found.select(
        "doc_id",
        F.size("hits").cast("long").alias("n_sentences_known"),
        F.array_join(shown, ",").alias("rules"),
        F.array_join(own, ",").alias("licences"),
    )
