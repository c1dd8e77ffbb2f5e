"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a probability from the words in it,
and the document is toxic unless no sentence is: the noisy-or. Labels exist for documents only; the
gradient of the noisy-or divides a label among the sentences. The fitted model
then scores every text and points to its offending sentences.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import cut, slices

#: Words share this many weights by hash.
FEATURES = 1 << 18
#: At most about so many labelled documents are fitted, those of least hash, of at most so many words each.
MOST_DOCS, MOST_WORDS = 6_000, 20_000
#: A word gets a weight only if labels depend on it: log-likelihood ratio with one degree of freedom.
LEAST_EVIDENCE = 20.0
STEPS, BATCH, RATE, DECAY = 1_500, 256, 0.1, 1e-4
#: A word counts as itself and as a stem of so many bytes, so its compounds are known too.
STEM = 5
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n")
EDGES = b".,;:!?\"'()[]{}|*$%&#<>-"
RESULT = "doc_id long, held_out boolean, score double, predicted int, n_sentences long, offending array<struct<sentence: int, begin: int, end: int, score: double>>"


def in_training(doc_id: int | None, folds: int, fold: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else b"%d" % doc_id) % folds != fold


def sentences(text: str) -> list[tuple[int, int]]:
    """Begins and ends of the sentences of a text, in characters; an empty text is one of its own."""
    found, start = [], 0
    for end in SENTENCE.finditer(text):
        if end.start() > start:
            found.append((start, end.start()))
        start = end.end()
    if start < len(text) or not found:
        found.append((start, len(text)))
    return found


def bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[list[tuple[int, int]]]]:
    """Two features for every word (itself, its stem), features per sentence, and the sentences per text."""
    held, counts, spans = [], [], []
    for text in texts:
        own = sentences(text)
        spans.append(own)
        for a, b in own:
            found = text[a:b].lower().encode().split()
            counts.append(len(found))
            held += found
    coded = pa.array(held, pa.binary()).dictionary_encode()
    known = [w.strip(EDGES) for w in coded.dictionary.to_pylist()]
    hashed = np.array([(zlib.crc32(w) % FEATURES, zlib.crc32(w[:STEM], 1) % FEATURES) for w in known], dtype=np.int32)
    features = hashed.reshape(-1, 2)[np.asarray(coded.indices).astype(np.int64)].reshape(-1)
    return features, 2 * np.array(counts, dtype=np.int64), spans


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            rows = []
            for text, toxic in zip(part["text"].to_pylist(), part["toxic"].to_pylist(), strict=True):
                words, counts, _ = bags([text or ""])
                if len(words) <= 2 * MOST_WORDS:
                    rows.append({"toxic": toxic, "words": words, "counts": counts.astype(np.int32)})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("toxic", pa.int32()), ("words", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32()))]))


class Model:
    """Weights of words and a bias; the probability of a sentence is logistic in the sum of its words."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights.astype(np.float32), float(bias)

    def sentence_scores(self, words: np.ndarray, counts: np.ndarray) -> np.ndarray:
        logits = _sums(self.weights[words].astype(np.float64), counts) + self.bias
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def evidence(truth: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """How far the share of toxic documents among those with a word is from that of all."""
    seen, toxic = np.zeros(FEATURES), np.zeros(FEATURES)
    for label, own in zip(truth, words, strict=True):
        found = np.unique(own)
        seen[found] += 1
        toxic[found] += label
    share = truth.mean()
    with np.errstate(divide="ignore", invalid="ignore"):
        yes = np.where(toxic > 0, toxic * np.log(toxic / (seen * share)), 0.0)
        no = np.where(seen > toxic, (seen - toxic) * np.log((seen - toxic) / (seen * (1 - share))), 0.0)
    return 2 * (yes + no)


def fit(labels: list[int], words: list[np.ndarray], counts: list[np.ndarray]) -> Model:
    """Maximise the likelihood of document labels under the noisy-or of their sentences (Adam, fixed order)."""
    weights, bias = np.zeros(FEATURES), -4.0
    if not labels or len(set(labels)) < 2:
        share = (sum(labels) + 0.5) / (len(labels) + 1)
        return Model(weights, float(np.log(share / (1 - share))))
    truth = np.array(labels, dtype=np.float64)
    usable = evidence(truth, words) >= LEAST_EVIDENCE
    moment, square = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    shuffled, step = np.random.default_rng(7), 0
    while step < STEPS:
        order = shuffled.permutation(len(labels))
        for start in range(0, len(order), BATCH):
            pick = order[start : start + BATCH]
            w, c = np.concatenate([words[i] for i in pick]), np.concatenate([counts[i] for i in pick]).astype(np.int64)
            per_doc = np.array([len(counts[i]) for i in pick])
            p = 1 / (1 + np.exp(-np.clip(_sums(weights[w], c) + bias, -30, 30)))
            none = np.exp(_sums(np.log1p(-p), per_doc))
            p_doc = np.clip(1 - none, 1e-9, 1 - 1e-9)
            # d log likelihood / d logit of a sentence: p (t / p_doc - 1)
            grad = np.repeat(truth[pick] / p_doc - 1, per_doc) * p
            full = np.append(np.bincount(w, np.repeat(grad, c), FEATURES) * usable, grad.sum()) / len(pick)
            full[:-1] -= DECAY * weights * usable
            step += 1
            moment = 0.9 * moment + 0.1 * full
            square = 0.99 * square + 0.01 * full * full
            move = RATE * moment / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
            weights += move[:-1]
            bias += move[-1]
    return Model(weights * usable, bias)


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> Model:
    """Fit on labelled documents outside the held-out fold.

    At most about MOST_DOCS of them are fitted, those whose ids have the least hashes,
    and none of more than MOST_WORDS words; so the driver holds a bounded sample.
    """
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    told = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (crc % folds != fold))
    told = told.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    count = told.count()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))
    chosen = cut(told.where(share * count < 1_000_000 * MOST_DOCS))
    # a bounded number of rows: see MOST_DOCS
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = texts.mapInArrow(_read, "toxic int, words array<int>, counts array<int>")
    picked = rows.toArrow()
    words = [np.asarray(x.values) for x in picked["words"]]
    counts = [np.asarray(x.values, dtype=np.int64) for x in picked["counts"]]
    return fit(picked["toxic"].to_pylist(), words, counts)


def _apply(model: Model, folds: int, fold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words, counts, spans = bags([t or "" for t in part["text"].to_pylist()])
                p = model.sentence_scores(words, counts)
                per_doc = np.array([len(s) for s in spans], dtype=np.int64)
                score = -np.expm1(_sums(np.log1p(-p), per_doc))
                ids = part["doc_id"].to_pylist()
                ends = np.cumsum(per_doc)
                found = []
                for i, own in enumerate(spans):
                    q = p[ends[i] - len(own) : ends[i]]
                    bad = np.nonzero(q >= 0.5)[0].tolist()
                    found.append([{"sentence": k, "begin": own[k][0], "end": own[k][1], "score": float(q[k])} for k in bad])
                kind = pa.list_(pa.struct([("sentence", pa.int32()), ("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array([not in_training(i, folds, fold) for i in ids], pa.bool_()),
                        pa.array(np.clip(score, 0.0, 1.0)),
                        pa.array((score >= 0.5).astype(np.int32)),
                        pa.array(per_doc),
                        pa.array(found, kind),
                    ],
                    ["doc_id", "held_out", "score", "predicted", "n_sentences", "offending"],
                )

    return run


def score(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """Score every text of ``docs`` (doc_id, text, any others), learning from ``labels`` (doc_id, toxic, any others).

    Rows whose crc32(doc_id as text) mod ``folds`` is ``fold`` are held out of the fit. Returns doc_id, held_out,
    score, predicted, n_sentences and offending (sentences of probability 0.5 or more, with their places in
    characters). Null and empty texts are one sentence without words; null labels and labels of null ids are not
    learned from, of several labels of one id the largest counts; with labels of one kind or none
    every text gets their share; repeated rows are scored alike; an empty table gives no rows.
    """
    model = train(docs, labels, folds, fold)
    return docs.select("doc_id", "text").mapInArrow(_apply(model, folds, fold), RESULT)
