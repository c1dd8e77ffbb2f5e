"""Repeated passages by longest-previous-factor arrays over a distributed suffix order.

Only suffixes that share their first LENGTH bytes with another matter, so a suffix is
cut there, and the suffix order is only needed among suffixes that can agree so far.
They are brought together by an anchor: the ANCHOR-byte string with the least hash in
the first LENGTH bytes, the leftmost of equals. Equal prefixes have equal anchors.

1. Every block of documents sends its anchors to shards, which tell the blocks the
   anchors that occur twice or more. All other suffixes have no match.
2. Neighbouring suffixes with one anchor make a factor, a stretch of text. Blocks send
   each distinct factor with a repeated anchor once, with all its places.
3. A shard sorts the suffixes of its factors, those with equal prefixes by place. So
   the previous smaller place in suffix order is the neighbour before, the next
   larger one the neighbour after; where the common prefix with it reaches LENGTH, the
   suffix has an earlier, or later, match. The bytes of matches go back to the blocks.

Work and messages grow with the text, never with the square of the copies of a passage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from rankflow.llm.common import mix64
from rankflow.llm.packets import answer, binary, freeze, pack, send, settle, shard_count, strings

LENGTH, ANCHOR = 200, 64
BLOCK_BYTES, SHARD_BYTES = 8 << 20, 4 << 20
#: Bytes of text and suffixes worked on at a time.
PIECE, BATCH = 1 << 20, 60_000
RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<begin: long, end: long>>, kept binary"


def _pieces(table: pa.Table, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Stretches of text: bytes, and for each text in them its row, its begin here and in the text."""
    held, rows, begins, offsets, size = [], [], [], [], 0
    for row, text in enumerate(table["text"]):
        data = np.frombuffer(text.as_buffer(), np.uint8)
        for offset in range(0, max(0, len(data) - length + 1), PIECE):
            part = data[offset : offset + PIECE + length - 1]
            held.append(part)
            rows.append(row)
            begins.append(size)
            offsets.append(offset)
            size += len(part)
            if size >= PIECE:
                yield np.concatenate(held), np.array(rows), np.array(begins), np.array(offsets)
                held, rows, begins, offsets, size = [], [], [], [], 0
    if held:
        yield np.concatenate(held), np.array(rows), np.array(begins), np.array(offsets)


def _factors(data: np.ndarray, begins: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of suffixes with one anchor: first suffix, number, hash of the anchor, text they are in."""
    size = len(data)
    hashed, power, width = data.astype(np.uint64) + np.uint64(1), 0x9E3779B97F4A7C15, 1
    while width < ANCHOR:  # a string of 2 k bytes from its halves
        hashed = hashed[:-width] * np.uint64(power) + hashed[width:]
        power, width = power * power % (1 << 64), width * 2
    hashed = mix64(hashed)
    reach = length - ANCHOR + 1
    key = hashed & np.uint64(0xFFFFFFFF00000000) | np.arange(len(hashed), dtype=np.uint64)
    pad = -len(key) % reach
    rows = np.append(key, np.full(pad, ~np.uint64(0))).reshape(-1, reach)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts = size - length + 1
    at = (np.minimum(behind[:starts], ahead[reach - 1 : reach - 1 + starts]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ends = np.append(begins[1:], size)
    valid = np.zeros(starts + 1, dtype=np.int64)
    np.add.at(valid, begins, 1)
    np.add.at(valid, np.minimum(ends - length + 1, starts), -1)
    inside = np.cumsum(valid[:-1]) > 0
    new = inside & np.concatenate([[True], (np.diff(at) != 0) | ~inside[:-1]])
    new[begins] = True
    first = np.nonzero(new)[0]
    text = np.searchsorted(begins, first, "right") - 1
    stop = np.minimum(np.append(first[1:], starts), ends[text] - length + 1)
    return first, stop - first, hashed[at[first]], text


def _home(anchors: np.ndarray, shards: int) -> np.ndarray:
    return (mix64(anchors) % np.uint64(shards)).astype(np.int64)


def _ask(shards: int, length: int):
    def work(table: pa.Table) -> Iterator[tuple[int, bytes]]:
        found = [np.zeros(0, np.uint64)]
        for data, _, begins, _ in _pieces(table, length):
            found.append(_factors(data, begins, length)[2])
        anchors, counts = np.unique(np.concatenate(found), return_counts=True)
        home = _home(anchors, shards)
        order = np.argsort(home, kind="stable")
        ends = np.searchsorted(home[order], np.arange(shards + 1))
        for shard in range(shards):
            own = order[ends[shard] : ends[shard + 1]]
            if len(own):
                yield shard, freeze(anchors=anchors[own], more=(counts[own] > 1).astype(np.uint8))

    return work


def _repeated(messages: list[dict]) -> Iterator[bytes]:
    every = np.concatenate([m["anchors"] for m in messages])
    anchors, back = np.unique(every, return_inverse=True)
    counts = np.bincount(back, 1 + np.concatenate([m["more"] for m in messages]), len(anchors))
    repeated = anchors[counts > 1]
    for m in messages:
        yield freeze(anchors=m["anchors"][np.isin(m["anchors"], repeated)])


def _send(shards: int, length: int):
    def work(table: pa.Table, replies: dict[int, dict]) -> pa.Table:
        repeated = np.concatenate([np.zeros(0, np.uint64), *[r["anchors"] for r in replies.values()]])
        ids = np.array([i if i is not None else np.iinfo(np.int64).max for i in table["doc_id"].to_pylist()], dtype=np.int64)
        factors, places = [], []
        for data, rows, begins, offsets in _pieces(table, length):
            first, count, anchor, text = _factors(data, begins, length)
            own = np.nonzero(np.isin(anchor, repeated))[0]
            raw = data.tobytes()
            spans = zip(first[own].tolist(), (first[own] + count[own] + length - 1).tolist(), strict=True)
            factors.append(pa.array([raw[a:b] for a, b in spans], pa.binary()))
            places.append(np.stack([rows[text[own]], first[own] - begins[text[own]] + offsets[text[own]], anchor[own].view(np.int64)]))
        shard, payload = [], []
        if factors and sum(map(len, factors)):
            coded = pa.concat_arrays(factors).dictionary_encode()
            which = np.asarray(coded.indices).astype(np.int64)
            row, start, anchor = np.concatenate(places, axis=1)
            home = _home(anchor.view(np.uint64), shards)
            order = np.lexsort((start, row, ids[row], which, home))  # places of a factor in order
            ends = np.searchsorted(home[order], np.arange(shards + 1))
            for s in np.unique(home).tolist():
                own = order[ends[s] : ends[s + 1]]
                head = np.nonzero(np.append(True, np.diff(which[own]) != 0))[0]
                lengths, data = strings(coded.dictionary.take(pa.array(which[own][head])))
                shard.append(s)
                payload.append(freeze(
                    lengths=np.diff(lengths).astype(np.uint32), data=data, anchors=anchor[own][head].view(np.uint64),
                    copies=np.diff(np.append(head, len(own))).astype(np.uint32),
                    rows=row[own].astype(np.uint32), starts=start[own].astype(np.uint64), ids=ids[row[own][head]],
                ))
        return pa.table({"shard": pa.array(shard, pa.int32()), "payload": pa.array(payload, pa.binary())})

    return work


def matched(offsets: np.ndarray, data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix of factors given in order of place: has it an earlier match, has it a later one.

    A factor of n bytes has n - length + 1 suffixes here.
    """
    counts = np.diff(offsets) - length + 1
    where = np.repeat(offsets[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    rows = np.lib.stride_tricks.sliding_window_view(data, length)[where]
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{length}").reshape(-1), kind="stable")
    equal = (rows[order[1:]] == rows[order[:-1]]).all(axis=1)  # a common prefix of the whole length
    earlier, later = np.zeros(len(where), dtype=bool), np.zeros(len(where), dtype=bool)
    earlier[order[1:][equal]] = True
    later[order[:-1][equal]] = True
    return earlier, later


def _match(length: int, keep_first: bool):
    def work(messages: list[dict]) -> Iterator[bytes]:
        asked = [binary(np.concatenate([[0], np.cumsum(m["lengths"], dtype=np.int64)]), m["data"]) for m in messages]
        coded = pa.concat_arrays(asked).dictionary_encode()
        which = np.asarray(coded.indices).astype(np.int64)
        factors = len(coded.dictionary)
        copies = np.bincount(which, np.concatenate([m["copies"] for m in messages]), factors)
        head = [np.cumsum(m["copies"], dtype=np.int64) - m["copies"] for m in messages]
        start = np.concatenate([m["starts"][h] for m, h in zip(messages, head, strict=True)]).astype(np.int64)
        ids = np.concatenate([m["ids"] for m in messages])
        source = np.repeat(np.arange(len(messages)), [len(a) for a in asked])
        anchors = np.concatenate([m["anchors"] for m in messages])
        # the first place of each distinct factor stands for it
        rank = np.lexsort((source, start, ids, which))
        lead = rank[np.append(True, np.diff(which[rank]) != 0)] if len(rank) else rank
        size = np.asarray(pa.compute.binary_length(coded.dictionary)).astype(np.int64) - length + 1
        order = np.lexsort((start[lead], ids[lead], anchors[lead]))
        flags: list[np.ndarray | None] = [None] * factors
        group = np.append(True, np.diff(anchors[lead][order]) != 0) if factors else np.zeros(0, bool)
        cuts, held = [0], 0
        for i, (fresh, n) in enumerate(zip(group.tolist(), size[order].tolist(), strict=True)):
            if fresh and held > BATCH:  # factors with one anchor stay together
                cuts.append(i)
                held = 0
            held += n
        for a, b in zip(cuts, [*cuts[1:], factors], strict=True):
            own = order[a:b]
            if not len(own):
                continue
            # places rise from factor to factor within an anchor; others never match
            earlier, later = matched(*strings(coded.dictionary.take(pa.array(own))), length)
            found = earlier if keep_first else earlier | later
            for factor, flag in zip(own.tolist(), np.split(found, np.cumsum(size[own])[:-1]), strict=True):
                flags[factor] = flag
        at = 0
        for number, m in enumerate(messages):
            own = which[at : at + len(m["copies"])]
            leads = lead[own] == at + np.arange(len(own))
            at += len(own)
            rows, begins, ends = [], [], []
            for j, factor in enumerate(own.tolist()):
                first, last = int(head[number][j]), int(head[number][j] + m["copies"][j])
                if copies[factor] > 1:  # all suffixes of the copies match
                    skip = 1 if keep_first and leads[j] else 0
                    rows.append(m["rows"][first + skip : last])
                    begins.append(m["starts"][first + skip : last])
                    ends.append(m["starts"][first + skip : last] + np.uint64(size[factor] + length - 1))
                    if not skip:
                        continue
                edges = np.diff(np.concatenate([[0], flags[factor].astype(np.int8), [0]]))
                a, b = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
                if len(a):
                    rows.append(np.repeat(m["rows"][first : first + 1], len(a)))
                    begins.append(m["starts"][first] + a.astype(np.uint64))
                    ends.append(m["starts"][first] + (b + length - 1).astype(np.uint64))
            none = np.zeros(0, np.uint64)
            yield freeze(rows=np.concatenate([none, *rows]).astype(np.uint32), begins=np.concatenate([none, *begins]).astype(np.uint64), ends=np.concatenate([none, *ends]).astype(np.uint64))

    return work


def _remove(whole_characters: bool, extra: tuple[str, ...]):
    def work(table: pa.Table, replies: dict[int, dict]) -> pa.Table:
        none = np.zeros(0, np.int64)
        rows, begins, ends = (np.concatenate([none, *[r[k] for r in replies.values()]]).astype(np.int64) for k in ("rows", "begins", "ends"))
        order = np.argsort(rows, kind="stable")
        rows, begins, ends = rows[order], begins[order], ends[order]
        bound = np.searchsorted(rows, np.arange(len(table) + 1))
        sizes, removed, spans, kept = [], [], [], []
        for row, text in enumerate(table["text"]):
            data = np.frombuffer(text.as_buffer(), np.uint8)
            edges = np.zeros(len(data) + 1, dtype=np.int64)
            np.add.at(edges, begins[bound[row] : bound[row + 1]], 1)
            np.add.at(edges, ends[bound[row] : bound[row + 1]], -1)
            covered = np.cumsum(edges[:-1]) > 0
            if whole_characters and covered.any() and (data >= 0x80).any():
                # a character goes only if all its bytes do
                lead = np.nonzero(data & 0xC0 != 0x80)[0]
                whole = np.minimum.reduceat(covered, lead)
                covered = np.repeat(whole, np.diff(np.append(lead, len(data))))
            change = np.diff(np.concatenate([[0], covered.astype(np.int8), [0]]))
            runs = zip(np.nonzero(change == 1)[0].tolist(), np.nonzero(change == -1)[0].tolist(), strict=True)
            sizes.append(len(data))
            removed.append(int(covered.sum()))
            spans.append([{"begin": a, "end": b} for a, b in runs])
            kept.append(data[~covered].tobytes())
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        return pa.table({
            "doc_id": table["doc_id"], "n_bytes": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "spans": pa.array(spans, span), "kept": pa.array(kept, pa.binary()), **{c: table[c] for c in extra},
        })

    return work


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep_first: bool = True, whole_characters: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """Remove the bytes of passages of ``length`` bytes or more that occur elsewhere too.

    ``docs``: doc_id, text, any others. Texts are UTF-8 bytes, matches never cross
    documents and may overlap; all are judged on the input. With ``keep_first`` a
    passage stays where it comes first (by doc_id, then by place), else every copy goes.
    ``whole_characters`` keeps a character of which only some bytes would go. Returns
    doc_id, n_bytes, n_removed, spans (maximal, in bytes) and kept (the other bytes).
    Null and empty texts have no bytes; repeated rows repeat each other; null ids come
    last; string columns named in ``extra`` stay with their row; an empty table gives no rows.
    """
    if length < ANCHOR:
        raise ValueError(f"a passage has at least {ANCHOR} bytes")
    blocks, weight = pack(docs, BLOCK_BYTES, extra)
    shards = shard_count(weight, SHARD_BYTES)
    repeated = answer(send(blocks, _ask(shards, length)), _repeated)
    factors = settle(blocks, repeated, _send(shards, length), "shard int, payload binary", with_block=True)
    found = answer(factors, _match(length, keep_first))
    result = ", ".join([RESULT, *[f"{c} string" for c in extra]])
    return settle(blocks, found, _remove(whole_characters, extra), result)
