"""Quality rules with thresholds that adapt to each language and source.

Every measure of a document is an integer. Its distribution per language and source, over the
documents that the base rules leave,
is kept as a mergeable quantile sketch: counts of values cut to their leading bits,
so any quantile is known to one part in 2 ** (KEEP_BITS - 1). Sketches merge by
adding counts; a small group takes the sketch of its language, a small language that
of all documents. A fence lies beyond a high quantile, by a multiple of that quantile's distance
to the median; the fences replace fixed cutoffs and are joined to the documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm.common import BLANKS, cut, join_hot, mix64, null_safe_key, raw_texts, slices, sums_by_row

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
KEEP_BITS = 7
#: Fewer documents than this borrow the sketch of the next wider group.
LEAST_DOCS = 100
#: A fence lies beyond its quantile by so many times the quantile's distance to the median.
REACH = 2
#: By measure: the upper quantile, the lower one if it has a fence below (both per thousand), and
#: what is added against rounding, so that a group of equal values doesn't lose the next value.
MEASURES = {
    "symbol_rate": (900, None, 20),
    "dup_line_rate": (980, None, 20),
    "repeat_rate": (980, None, 20),
    "word_length": (900, 50, 5),
}
_COUNTS = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_lines long, n_repeat_words long"


def repeated_words(ids: np.ndarray, offsets: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """For each document (word ids between offsets): words inside windows that occur twice or more."""
    starts = np.arange(max(0, len(ids) - size + 1))
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    starts = starts[starts + size <= offsets[1:][owner[: len(starts)]]]
    marked = np.zeros(len(ids) + 1, dtype=np.int64)
    if len(starts):
        spread = mix64(ids.astype(np.uint64) + np.uint64(1))
        print_ = mix64(owner[starts].astype(np.uint64) + np.uint64(0x9E37))
        for j in range(size):
            print_ = print_ * np.uint64(0x9E3779B97F4A7C15) + spread[starts + j]
        order = np.argsort(mix64(print_), kind="stable")
        same = np.diff(print_[order]) == 0
        left, right = starts[order[:-1][same]], starts[order[1:][same]]
        equal = owner[left] == owner[right]
        for j in range(size):
            equal &= ids[left + j] == ids[right + j]
        if not equal.all():  # two windows share a fingerprint: count these documents exactly
            for doc in set(owner[right[~equal]].tolist()) | set(owner[left[~equal]].tolist()):
                own = [tuple(ids[i : i + size]) for i in range(offsets[doc], offsets[doc + 1] - size + 1)]
                seen = Counter(own)
                twice = offsets[doc] + np.array([i for i, w in enumerate(own) if seen[w] > 1], dtype=np.int64)
                np.add.at(marked, twice, 1)
                np.add.at(marked, twice + size, -1)
            bad = set(owner[right[~equal]].tolist()) | set(owner[left[~equal]].tolist())
            fine = ~np.isin(owner[left], list(bad)) & ~np.isin(owner[right], list(bad))
            left, right = left[fine], right[fine]
        twice = np.unique(np.concatenate([left, right]))
        np.add.at(marked, twice, 1)
        np.add.at(marked, twice + size, -1)
    return sums_by_row((np.cumsum(marked)[:-1] > 0).astype(np.int64), offsets)


def _count(keep: tuple[str, ...]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield _counted(part, keep)
        pa.default_memory_pool().release_unused()  # a worker that waits for its next task keeps little

    return work


def _counted(part: pa.RecordBatch, keep: tuple[str, ...]) -> pa.RecordBatch:
    texts = raw_texts(part["text"])
    found = [t.split() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in found])]).astype(np.int64)
    flat = pa.array([w for ws in found for w in ws], type=pa.binary())
    ids = np.asarray(flat.dictionary_encode().indices, dtype=np.int64)
    solid = [t.translate(None, BLANKS) for t in texts]
    lines = [[x for x in t.split(b"\n") if x.strip(BLANKS)] for t in texts]
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": part["doc_id"].cast(pa.int64()),
            "lang": part["lang"],
            "source": part["source"],
            "n_words": np.diff(offsets),
            "word_chars": [len(s.decode()) for s in solid],
            "n_symbols": [len(s) - len(s.translate(None, SYMBOLS)) for s in solid],
            "n_dup_lines": [len(x) - len(set(x)) for x in lines],
            "n_lines": [len(x) for x in lines],
            "n_repeat_words": repeated_words(ids, offsets),
            **{c: part[c] for c in keep},
        }
    )


def measure(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Counts and integer measures of every document; rates are per thousand, lengths in hundredths.

    The columns of ``keep`` (strings) go along.
    """
    schema = ", ".join([_COUNTS, *[f"{c} string" for c in keep]])
    counted = docs.select("doc_id", "lang", "source", "text", *keep).mapInArrow(_count(keep), schema)
    return counted.withColumns(
        {
            "symbol_rate": F.expr("n_symbols * 1000 div greatest(n_words, 1)"),
            "dup_line_rate": F.expr("n_dup_lines * 1000 div greatest(n_lines, 1)"),
            "repeat_rate": F.expr("n_repeat_words * 1000 div greatest(n_words, 1)"),
            "word_length": F.expr("word_chars * 100 div greatest(n_words, 1)"),
            "base_failed": (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30),
            "group_key": null_safe_key("lang", "source"),
            "lang_key": null_safe_key("lang"),
        }
    )


def sketches(measured: DataFrame) -> DataFrame:
    """lang_key, group_key, measure, bucket, n: the quantile sketch of every language and source."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("v")) for m in MEASURES])
    return (
        measured.where("NOT base_failed")
        .select("lang_key", "group_key", F.explode(pairs).alias("p"))
        .select("lang_key", "group_key", "p.measure", "p.v")
        .withColumn("cut", F.expr(f"greatest(0, length(bin(v)) - {KEEP_BITS})"))
        .withColumn("bucket", F.expr("shiftleft(shiftright(v, cut), cut)"))
        .groupBy("lang_key", "group_key", "measure", "bucket")
        .agg(F.count("*").alias("n"))
    )


def _level(side: int) -> Column:
    """The quantile of a row's measure, per thousand; none if it has no fence on that side."""
    level = F.lit(None).cast("int")
    for name, row in MEASURES.items():
        level = F.when(F.col("measure") == name, F.lit(row[side]).cast("int")).otherwise(level)
    return level


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Merge sketches by keys and measure; return docs, low, middle and high of each."""
    by = [*keys, "measure"]
    merged = sketch.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))
    run = F.sum("n").over(Window.partitionBy(*by).orderBy("bucket"))
    whole = F.sum("n").over(Window.partitionBy(*by))
    marked = merged.withColumn("run", run).withColumn("docs", whole)

    def at(level: Column, name: str) -> Column:
        return F.min(F.when(F.col("run") * 1000 >= F.col("docs") * level, F.col("bucket"))).alias(name)

    return marked.groupBy(*by).agg(
        F.max("docs").alias("docs"), at(_level(1), "low"), at(F.lit(500), "middle"), at(_level(0), "high")
    )


def thresholds(measured: DataFrame) -> DataFrame:
    """One row per language and source of which the base rules leave documents: the fences of each measure."""
    sketch = cut(sketches(measured))
    own = quantiles(sketch, ["lang_key", "group_key"])
    wide = quantiles(sketch, ["lang_key"])
    every = quantiles(sketch, [])
    names = ("docs", "low", "middle", "high")
    wide = wide.select("lang_key", "measure", *[F.col(c).alias(f"lang_{c}") for c in names])
    every = every.select("measure", *[F.col(c).alias(f"all_{c}") for c in names])
    # every has one row per measure: a size fixed by MEASURES
    joined = own.join(wide, ["lang_key", "measure"]).join(F.broadcast(every), "measure")

    def pick(c: str) -> Column:
        return (
            F.when(F.col("docs") >= LEAST_DOCS, F.col(c))
            .when(F.col("lang_docs") >= LEAST_DOCS, F.col(f"lang_{c}"))
            .otherwise(F.col(f"all_{c}"))
        )

    joined = joined.withColumns({f"own_{c}": pick(c) for c in names[1:]})
    fences = []
    for name, (_, low, slack) in MEASURES.items():
        here = F.col("measure") == name
        high, middle = F.col("own_high"), F.col("own_middle")
        fences.append(F.max(F.when(here, high + (high - middle) * REACH + slack)).alias(f"{name}_most"))
        if low is not None:
            least = F.col("own_low") - (middle - F.col("own_low")) * REACH - slack
            fences.append(F.max(F.when(here, least)).alias(f"{name}_least"))
    return joined.groupBy("group_key").agg(*fences)


def judge(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Measure every document and judge it by the fences of its language and source.

    ``docs``: doc_id, text, lang, source, any others. Returns the counts, base_failed
    (under 20 words, or over 30 % of the words in repeated 8-word windows) and kept.
    A null text counts as empty; null language or source is a group of its own; rows
    with equal ids are judged one by one, string columns named in ``keep`` stay with their
    row; an empty table gives no rows.
    """
    measured = cut(measure(docs, keep))
    left = measured.where("NOT base_failed")
    sizes = left.groupBy("group_key").agg(F.count("*").alias("group_docs"))
    fences = cut(thresholds(measured).join(sizes, "group_key"))
    judged = join_hot(left, fences, "group_key", "group_docs", left.count())
    inside = F.lit(True)
    for name, (_, low, _) in MEASURES.items():
        inside &= F.col(name) <= F.col(f"{name}_most")
        if low is not None:
            inside &= F.col(name) >= F.col(f"{name}_least")
    kept = judged.withColumn("kept", inside)
    failed = measured.where("base_failed").withColumn("kept", F.lit(False))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    names += [*MEASURES, *keep]
    return kept.select(*names).unionByName(failed.select(*names))
