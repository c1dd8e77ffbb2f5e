"""Language-model scores from an Elias-Fano n-gram trie spread over the cluster.

Word counts, word ids and the counts of each level of n-grams live in shards. A block of documents
learns the ids and counts of its own words. Then, level by level, it sends every distinct n-gram
once, as the ids of its words, with its count in training, and gets back for each the count of the
whole corpus. All else that a probability needs, the count of the context (all but the last word)
and the value of the n-gram without its first word, the block knows from the levels below, so neither
moves; which documents hold an n-gram, and how often, stays with the block too, which finds its n-grams
in the same order each time. A shard has all n-grams that begin with some words; words, and contexts, so
frequent that one would outgrow a shard are spread by the word that follows. It builds a trie
of its training n-grams and looks up all n-grams it was sent. An n-gram with a word, a context or a rest
that stands in no other block, held out or not, stands in no other block itself, and none with a context or
a rest (all but the first word) out of training is in training. The former the block looks up in
a trie of its own, the latter nowhere.

Probabilities: p(w) = (c(w) + 1) / (N + V + 1), and with a context h, and h' without its first
word, p(w | h) = (c(h w) + m p(w | h')) / (c(h) + m) with m = PRIOR_SHARE c(h) + PRIOR, Bayesian
smoothing towards the shorter context with a prior that grows with the context (of a dozen priors
tried for pairs, the best on held-out text). A context without training places leaves the shorter
one's probability. No count is pruned or capped. Logarithms are stored in
fixed steps, so scores don't depend on how documents and n-grams are spread.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankflow.llm.common import cut, mix64
from rankflow.llm.elias_fano import Codebook, Counts, Trie
from rankflow.llm.packets import answer, binary, freeze, pack, send, settle, shard_count, strings, thaw

PRIOR_SHARE, PRIOR = 2.0, 2.0
#: Words of the longest n-grams.
ORDER = 3
#: Small blocks: a block's n-grams are held as two dozen arrays of 8 bytes a word.
BLOCK_BYTES, SHARD_BYTES = 5 << 20, 16 << 20
#: Stands for the end of a text; no word holds a line feed.
END = b"\n"
BEGIN_ID, UNKNOWN_ID, FIRST_ID = 0, 1, 2
#: An odd number that spreads words over shards.
SPREAD = 0x9E3779B97F4A7C15
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def prior(context_count: np.ndarray) -> np.ndarray:
    return PRIOR_SHARE * context_count + PRIOR


def _weight(context_count: np.ndarray) -> np.ndarray:
    """log10 of what the probability under the shorter context counts for if the n-gram isn't in training."""
    return np.log10(prior(context_count) / (context_count + prior(context_count)))


def _steps(values: np.ndarray) -> np.ndarray:
    return Codebook.steps(values).astype(np.int64)


def in_training(doc_id: int | None, folds: int, fold: int) -> bool:
    """Documents of one fold by the CRC of the id as text are held out; a null id counts as empty text."""
    return zlib.crc32(b"" if doc_id is None else b"%d" % doc_id) % folds != fold


def tokens(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct tokens of a block, the index of each token, and the tokens per document, ends included."""
    texts = pa.concat_arrays([pa.array([], pa.binary()), *table["text"].chunks])
    # bytes that pass for a string: both functions look at single bytes
    texts = pa.StringArray.from_buffers(len(texts), *texts.buffers()[1:], offset=texts.offset)
    parts = pa.compute.ascii_split_whitespace(pa.compute.ascii_lower(texts))
    held = parts.flatten()
    word = np.asarray(pa.compute.binary_length(held)) > 0  # blanks at either end leave empty parts
    coded = held.filter(pa.array(word)).dictionary_encode()
    own = np.diff(np.concatenate([[0], np.cumsum(word)])[np.asarray(parts.offsets) - parts.offsets[0].as_py()])
    words = pa.concat_arrays([coded.dictionary.cast(pa.binary()), pa.array([END], pa.binary())])
    index = np.full(own.sum() + len(own), len(words) - 1)
    index[np.arange(own.sum()) + np.repeat(np.arange(len(own)), own)] = np.asarray(coded.indices)
    return words, index, own + 1


def _home(words: pa.Array, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The words in order of their shards, and where each shard's begin; by a polynomial in the bytes, modulo 2 ** 64."""
    offsets, data = strings(words)
    power, back = (np.cumprod(np.append(np.uint64(1), np.full(len(data), x, dtype=np.uint64))) for x in (SPREAD, pow(SPREAD, -1, 1 << 64)))
    sums = np.append(np.uint64(0), np.cumsum((data + np.uint64(1)) * power[:-1]))
    home = mix64((sums[offsets[1:]] - sums[offsets[:-1]]) * back[offsets[:-1]]) % np.uint64(shards)
    home = home.astype(np.min_scalar_type(shards))
    order = np.argsort(home, kind="stable")
    return order, np.searchsorted(home[order], np.arange(shards + 1))


def _training(table: pa.Table, folds: int, fold: int) -> np.ndarray:
    return np.array([in_training(i, folds, fold) for i in table["doc_id"].to_pylist()], dtype=bool)


def _count(shards: int, folds: int, fold: int):
    def work(table: pa.Table) -> Iterator[tuple[int, bytes]]:
        words, index, counts = tokens(table)
        trained = np.repeat(_training(table, folds, fold), counts)
        seen = np.bincount(index[trained], minlength=len(words))
        order, ends = _home(words, shards)
        for shard in range(shards):  # every shard, for its answer carries its totals
            own = order[ends[shard] : ends[shard + 1]]
            offsets, data = strings(words.take(pa.array(own)))
            yield shard, freeze(lengths=np.diff(offsets).astype(np.uint32), data=data, seen=seen[own].astype(np.uint32))

    return work


def _number(messages: list[dict]) -> Iterator[bytes]:
    """Of the words of each block: ranks (most frequent first; -1 without training counts), counts, whether no other block has them."""
    asked = [binary(np.concatenate([[0], np.cumsum(m["lengths"])]), m["data"]) for m in messages]
    index = np.asarray(pa.concat_arrays(asked).dictionary_encode().indices).astype(np.int64)
    counts = np.bincount(index, np.concatenate([m["seen"] for m in messages]), index.max(initial=-1) + 1).astype(np.int64)
    only = np.bincount(index, minlength=len(counts)) == 1  # a block names a word once
    rank = np.empty(len(counts), dtype=np.int64)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
    rank[counts == 0] = -1
    totals = np.array([counts.sum(), np.count_nonzero(counts)])
    at = 0
    for words in asked:
        own = index[at : at + len(words)]
        at += len(words)
        yield freeze(rank=rank[own], count=_narrow(counts[own]), only=np.packbits(only[own]), totals=totals)


def _narrow(counts: np.ndarray) -> np.ndarray:
    """In as few bytes as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def _distinct(front: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of numbers under 2 ** 31, in order: both parts, a place of each; and which of them stands at each place."""
    bits = int(word.max(initial=0)).bit_length()
    keys = front << bits | word
    own = len(keys).bit_length()
    if int(keys.max(initial=0)).bit_length() + own < 64:  # places fit beside the keys, and plain numbers are sorted fastest
        keys = np.sort(keys << own | np.arange(len(keys)))
        at, keys = keys & (1 << own) - 1, keys >> own
    else:
        at = np.argsort(keys, kind="stable")
        keys = keys[at]
    new = np.append(True, np.diff(keys) != 0)[: len(keys)]
    which = np.empty(len(keys), dtype=np.int64)
    which[at] = np.cumsum(new) - 1
    keys = keys[new]
    return keys >> bits, keys & (1 << bits) - 1, at[new], which


def _counts(context: np.ndarray, word: np.ndarray, trained: np.ndarray) -> np.ndarray:
    """Counts of distinct n-grams, in order of context and word (from 1 on), looked up in the trie of those in training."""
    own = trained > 0
    *_, found, count = Trie(context[own], word[own], trained[own], None, Counts).find(context, word)
    return np.where(found, count, 0).astype(np.int64)


class _Block:
    """What a block of documents knows about its tokens, level by level.

    Its words are numbered in order of their ids, the begin of a text first. For every token: ``log``,
    log10 of its probability under the longest context so far, and ``slot``, the number of the n-gram
    that ends there (-1 if it can't be in training). For every n-gram, in order of its words: ``grams``, the
    numbers of its words, its count in the whole training (``seen``), the step of its value (``code``), whether it
    stands in no other block (``only``) and the number that its home is drawn from (``spread``).
    """

    def __init__(self, table: pa.Table, replies: dict[int, dict], shards: int, folds: int, fold: int):
        self.replies, self.shards = replies, shards
        words, index, self.counts = tokens(table)
        order, _ = _home(words, shards)
        listed = [replies[s] for s in range(shards)]
        sizes = [len(m["rank"]) for m in listed]
        rank = np.concatenate([m["rank"] for m in listed])
        ids = np.where(rank < 0, UNKNOWN_ID, FIRST_ID + rank * shards + np.repeat(np.arange(shards), sizes))
        ranked = np.argsort(ids, kind="stable")
        number = np.empty(len(words), dtype=np.int64)
        number[order[ranked]] = np.arange(len(words)) + 1
        self.index = number[index]
        end = number[words.index(pa.scalar(END, pa.binary())).as_py()]

        def held(column: Iterator[np.ndarray], kind: type) -> np.ndarray:
            values = np.concatenate(list(column)).astype(kind)[ranked]
            return np.concatenate([values[end - 1 : end], values])  # as many begins as ends

        self.word_ids = np.concatenate([[BEGIN_ID], ids[ranked]])
        self.word_counts = held((m["count"] for m in listed), np.int64)
        self.total, kinds = np.sum([m["totals"] for m in listed], axis=0)
        self.norm = self.total + kinds + 1
        self.in_training = _training(table, folds, fold)
        self.trained = np.repeat(self.in_training, self.counts)
        self.begins = np.cumsum(self.counts) - self.counts
        self.base = np.log10((self.word_counts + 1) / self.norm)[self.index]
        # single words as n-grams of the first level
        self.level, self.slot, self.log = 1, self.index, self.base
        self.grams, self.seen, self.spread = np.arange(len(self.word_ids))[None], self.word_counts, mix64(self.word_ids)
        self.only = held((np.unpackbits(m["only"], count=n) for m, n in zip(listed, sizes, strict=True)), bool)

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(np.repeat(np.arange(len(self.counts)), self.counts), values, len(self.counts))

    def rise(self) -> None:
        """On to the n-grams of the next level: which there are, and whose shards they are."""
        self.level += 1
        front = np.roll(self.slot, 1)
        front[self.begins] = 0 if self.level == 2 else -1  # no longer context begins before the text
        known = np.nonzero(front >= 0)[0]
        known = known[self.seen[front[known]] > 0]
        there = self.slot[known] >= 0
        there[there] = self.seen[self.slot[known[there]]] > 0
        less = known[~there]  # without their first word they aren't in training either
        self.short, self.log = self.log, self.log.copy()
        weight = _weight(self.seen[front[less]])
        self.log[less] += weight if self.level == 2 else -_steps(weight) * Codebook.STEP
        places = known[there]
        self.front, word, at, slot = _distinct(front[places], self.index[places])
        back = self.slot[places[at]]
        self.often = np.bincount(slot[self.trained[places]], minlength=len(word))
        self.under = self.seen[self.front]
        self.shorter = self.seen[back] if self.level == 2 else self.code[back]
        self.own = self.only[self.front] | self.only[back]
        self.slot = np.full(len(self.index), -1, dtype=np.int64)
        self.slot[places] = slot
        self.grams = np.concatenate([self.grams[:, self.front], word[None]])
        # a home for all that begins with a word; for the frequent with one more word, and so on
        hot = self.under * 2 * self.shards > self.total
        self.spread = self.spread[self.front] + np.where(hot, mix64(self.word_ids[word] + self.level), np.uint64(0))
        asked = np.nonzero(~self.own)[0]
        home = (mix64(self.spread[asked]) % np.uint64(self.shards)).astype(np.min_scalar_type(self.shards))
        order = np.argsort(home, kind="stable")
        self.asked, self.ends = asked[order], np.searchsorted(home[order], np.arange(self.shards + 1))

    def messages(self) -> Iterator[tuple[int, bytes]]:
        for shard in range(self.shards):
            own = self.asked[self.ends[shard] : self.ends[shard + 1]]
            if len(own):
                yield shard, _message([self.word_ids[column[own]] for column in self.grams], self.often[own])

    def learn(self) -> None:
        """Take in what the shards have told about the n-grams of this level."""
        sizes = np.diff(self.ends)
        told = [(self.replies[(self.level - 1) * self.shards + s], sizes[s]) for s in np.nonzero(sizes)[0].tolist()]
        self.seen, self.only = np.zeros(len(self.own), dtype=np.int64), self.own.copy()
        if told:
            self.seen[self.asked] = np.concatenate([m["seen"] for m, _ in told])
            if "only" in told[0][0]:
                self.only[self.asked] = np.concatenate([np.unpackbits(m["only"], count=n) for m, n in told]).astype(bool)
        # n-grams of which a part stands in no other block; no shard is asked about them
        own = self.own
        self.seen[own] = _counts(self.front[own], self.grams[-1][own], self.often[own])
        seen, m = self.seen, prior(self.under)
        lower = (self.shorter + 1) / self.norm if self.level == 2 else (10.0 ** (np.arange(1 << 16) * -Codebook.STEP))[self.shorter]
        self.code = _steps(np.where(seen > 0, np.log10((seen + m * lower) / (self.under + m)), _weight(self.under)))
        held = np.nonzero(self.slot >= 0)[0]
        slot = self.slot[held]
        self.log[held] = self.code[slot] * -Codebook.STEP + np.where(seen[slot] > 0, 0.0, self.short[held])


def _ask(level: int, shards: int, folds: int, fold: int):
    """Per block: the n-grams of a level, for every shard."""

    def work(table: pa.Table, replies: dict[int, dict]) -> pa.Table:
        block = _Block(table, replies, shards, folds, fold)
        block.rise()
        for _ in range(2, level):
            block.learn()
            block.rise()
        listed = list(block.messages())
        return pa.table({"shard": pa.array([s for s, _ in listed], pa.int32()), "payload": pa.array([p for _, p in listed], pa.binary())})

    return work


def _message(columns: list[np.ndarray], trained: np.ndarray) -> bytes:
    """Distinct n-grams in order, by the ids of their words, and their counts in training.

    Every word stands once under what comes before it: as the difference to the word before it there, the first as it is.
    """
    parts = {"trained": _narrow(trained)}
    new = np.zeros(len(trained), dtype=bool)
    new[0] = True
    parents = new.copy()
    for k, column in enumerate(columns):
        new[1:] |= np.diff(column) != 0
        first = np.nonzero(new)[0]
        if k:
            parts[f"under{k}"] = _narrow(np.diff(np.append(np.nonzero(parents[first])[0], len(first))))
        step = np.diff(column[first], prepend=0)
        opens = parents[first]
        step[opens] = column[first[opens]]
        parts[f"word{k}"] = _narrow(step)
        parents = new.copy()
    return freeze(**parts)


def _words(step: np.ndarray, under: np.ndarray) -> np.ndarray:
    """Ids from the differences of ``_message``; ``under``: how many stand under each that comes before."""
    ids = np.cumsum(step, dtype=np.int64)
    begins = np.cumsum(under, dtype=np.int64) - under
    return ids - np.repeat(ids[begins] - step[begins].astype(np.int64), under)


def _score(level: int, last: bool):
    """Build the trie of a shard from all training n-grams in it. Of each n-gram of each message: count, whether no other block asks."""

    def work(messages: list[dict]) -> Iterator[bytes]:
        ids = [np.cumsum(m["word0"], dtype=np.int64) for m in messages]
        found, at = np.unique(np.concatenate(ids), return_inverse=True)
        del ids
        for k in range(1, level):  # n-grams of k + 1 words by the number of their first k words and the last word
            under = [m.pop(f"under{k}").astype(np.int64) for m in messages]
            word = np.concatenate([_words(m.pop(f"word{k}"), u) for m, u in zip(messages, under, strict=True)])
            if word.max() >> 32:  # numbered anew within the shard, so that two numbers fit into one
                word = np.unique(word, return_inverse=True)[1] + 1
            found, at = np.unique(np.repeat(at, np.concatenate(under)) << 32 | word, return_inverse=True)
            del under, word
        trained = np.bincount(at, np.concatenate([m["trained"] for m in messages]), len(found)).astype(np.int64)
        seen = _counts(found >> 32, found & 0xFFFFFFFF, trained)
        only = np.bincount(at, minlength=len(found)) == 1  # a block asks once
        del found, trained
        start = 0
        for m in messages:
            own = at[start : start + len(m["trained"])]
            start += len(own)
            yield freeze(seen=_narrow(seen[own])) if last else freeze(seen=_narrow(seen[own]), only=np.packbits(only[own]))

    return work


def _sum(shards: int, folds: int, fold: int, order: int):
    def work(table: pa.Table, replies: dict[int, dict]) -> pa.Table:
        block = _Block(table, replies, shards, folds, fold)
        for _ in range(2, order + 1):
            block.rise()
            block.learn()
        return pa.table({
            "doc_id": table["doc_id"],
            "held_out": ~block.in_training,
            "n_tokens": block.counts, "n_known": block.sums(block.word_counts[block.index] > 0).astype(np.int64),
            "train_tokens": np.full(len(table), int(block.total), dtype=np.int64),
            "base_score": block.sums(block.base), "score": block.sums(block.log),
        })

    return work


def score(docs: DataFrame, folds: int = 7, fold: int = 2, order: int = 2) -> DataFrame:
    """Score every text of ``docs`` (doc_id, text, any others) under a model of those in training.

    Rows whose crc32(doc_id as text) mod ``folds`` is ``fold`` are held out. The model knows n-grams of up to
    ``order`` words (2 or more), the begin of a text counted as one. Returns
    doc_id, held_out, n_tokens, n_known, train_tokens, base_score (single words) and score
    (log10). Null and empty texts hold the end alone. Repeated rows count and are scored one by one;
    a null id is in training; without training rows every token is unknown; an empty
    table gives no rows.
    """
    if order < 2:
        raise ValueError("an n-gram has a context of one word at least")
    blocks, weight = pack(docs, BLOCK_BYTES)
    shards = shard_count(weight, SHARD_BYTES)
    replies = cut(answer(send(blocks, _count(shards, folds, fold)), _number))
    for level in range(2, order + 1):  # answers of a level are numbered behind those of the levels below
        asked = settle(blocks, replies, _ask(level, shards, folds, fold), "shard int, payload binary", with_block=True)
        told = answer(asked, _score(level, level == order))
        told = cut(told) if level < order else told
        replies = replies.unionByName(told.withColumn("shard", F.col("shard") + F.lit((level - 1) * shards)))
    return settle(blocks, replies, _sum(shards, folds, fold, order), RESULT)
