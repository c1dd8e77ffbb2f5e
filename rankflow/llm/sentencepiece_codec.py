"""SentencePiece encoding and decoding over a table of distinct chunks.

If no piece of a model holds a whitespace marker behind another character, merges
never cross from one marked word into the next, so a marked word is segmented alike
wherever it stands. Every block of documents sends its distinct words to shards; a
shard segments each distinct word of the corpus that hashes to it once; the ids come
back to the blocks and are joined by the positions of the words. Line feeds, which no
piece holds together with another character, part words in the same way.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from rankflow.llm.packets import answer, binary, freeze, pack, send, settle, shard_count, strings

MARK = "▁"
CHUNK = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
#: Bytes of text per shard of the chunk table, in whose shares its words come.
SHARD_BYTES = 24 << 20
SLICE_BYTES = 2 << 20


def chunks(text: str) -> list[str]:
    """The marked words of a text; joined, they are the text with marks, one more in front."""
    return CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []


class Codec:
    """A model with what encoding and decoding need; travels as the bytes of the model."""

    def __init__(self, model: bytes):
        self.model = model
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.special = [i for i in (self.sp.bos_id(), self.sp.eos_id(), self.sp.pad_id()) if i >= 0]
        shown, listed = [], []
        for i in range(self.sp.get_piece_size()):
            piece = self.sp.id_to_piece(i)
            if self.sp.is_byte(i):
                shown.append(bytes([int(piece[3:5], 16)]))
            elif self.sp.is_control(i):
                shown.append(b"")
            elif self.sp.is_unknown(i):
                shown.append(b"\xff")  # no text has this byte: such ids go to the library
            else:
                shown.append(piece.replace(MARK, " ").encode())
            listed.append(b"%d," % i)
        #: For every id: the bytes it stands for, and its decimal form with a comma.
        self.surfaces, self.forms = pa.array(shown, pa.binary()), pa.array(listed, pa.binary())

    def __reduce__(self) -> tuple:
        return Codec, (self.model,)

    def check(self) -> None:
        """Refuse a model whose words can't be segmented on their own."""
        for i in range(self.sp.get_piece_size()):
            piece = self.sp.id_to_piece(i)
            if re.search(f"[^{MARK}]{MARK}", piece) or ("\n" in piece and len(piece) > 1):
                raise ValueError(f"piece {i} crosses a whitespace marker or a line feed")
        odd = "  a  b \n"
        if self.sp.encode_as_pieces(odd)[0][0] != MARK or self.sp.decode(self.sp.encode(odd)) != odd:
            raise ValueError("the model must mark the start of a text and keep whitespace as it is")

    def segment(self, words: list[str]) -> list[list[int]]:
        """Ids of each marked word.

        The library marks the start of what it gets, so one mark is left out. A word
        without a mark goes behind a line feed, a lone mark before one, and the ids
        that are not the word's are cut off.
        """
        given = ["\n" if w == MARK else w[1:] if w[0] == MARK else "\n" + w for w in words]
        found = self.sp.encode(given, num_threads=1)
        return [
            ids[:1] if w == MARK else ids if w[0] == MARK else ids[2:] for w, ids in zip(words, found, strict=True)
        ]

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of a sequence of ids, as the library decodes it."""
        joined = strings(self.surfaces.take(pa.array(ids, pa.int32())))[1].tobytes()
        try:
            joined.decode()
        except UnicodeDecodeError:  # bytes that form no character, or an unknown id
            return self.sp.decode(ids.tolist()).encode()
        if np.isin(ids, self.special).any():
            return self.sp.decode(ids.tolist()).encode()
        return joined[1:] if len(ids) and self.sp.id_to_piece(int(ids[0]))[:1] == MARK else joined


def _distinct(table: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct chunks of a block, the index of every chunk, and the chunk counts of documents."""
    parts, counts, held, size = [], [], [], 0
    for text in table["text"]:
        own = chunks(text.as_py().decode("utf-8", "surrogatepass"))
        counts.append(len(own))
        held += own
        size += len(own)
        if size > SLICE_BYTES // 8:
            parts.append(pa.array(held, pa.string()))
            held, size = [], 0
    parts.append(pa.array(held, pa.string()))
    coded = pa.chunked_array(parts).combine_chunks().dictionary_encode()
    return coded.dictionary, np.asarray(coded.indices), np.array(counts, dtype=np.int64)


def _shards(words: pa.Array, shards: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(w) % shards for w in words.cast(pa.binary()).to_pylist()), np.int64, len(words))


def _ask(shards: int):
    def work(table: pa.Table) -> Iterator[tuple[int, bytes]]:
        words = _distinct(table)[0]
        home = _shards(words, shards)
        order = np.argsort(home, kind="stable")
        ends = np.searchsorted(home[order], np.arange(shards + 1))
        for shard in range(shards):
            if ends[shard] < ends[shard + 1]:
                offsets, data = strings(words.cast(pa.binary()).take(pa.array(order[ends[shard] : ends[shard + 1]])))
                yield shard, freeze(lengths=np.diff(offsets).astype(np.uint32), data=data)

    return work


def _segment(codec: Codec):
    def work(messages: list[dict]) -> Iterator[bytes]:
        asked = [binary(np.concatenate([[0], np.cumsum(m["lengths"])]), m["data"], pa.string()) for m in messages]
        coded = pa.concat_arrays(asked).dictionary_encode()
        found = []
        for start in range(0, len(coded.dictionary), 50_000):  # each distinct word once
            words = coded.dictionary[start : start + 50_000].to_pylist()
            found.append(pa.array(codec.segment(words), pa.list_(pa.int32())))
        table, at = pa.concat_arrays(found), 0
        for words in asked:
            own = table.take(coded.indices[at : at + len(words)])
            at += len(words)
            yield freeze(lengths=np.asarray(own.value_lengths()).astype(np.uint32), ids=np.asarray(own.flatten()).astype(np.uint32))

    return work


def _join(codec: Codec, shards: int):
    def work(table: pa.Table, replies: dict[int, dict]) -> pa.Table:
        words, index, counts = _distinct(table)
        order = np.argsort(_shards(words, shards), kind="stable")
        lengths = np.concatenate([replies[s]["lengths"] for s in sorted(replies)]) if replies else np.zeros(0, np.int64)
        ids = np.concatenate([replies[s]["ids"] for s in sorted(replies)]) if replies else np.zeros(0, np.int64)
        if len(lengths) != len(words):
            raise RuntimeError("answers do not match the words of the block")
        known = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]), pa.int32()), pa.array(ids, pa.int32()))
        place = np.empty(len(words), dtype=np.int64)
        place[order] = np.arange(len(words))
        ends = np.concatenate([[0], np.cumsum(counts)])
        totals, listed, texts = [], [], []
        for start, stop in zip(ends[:-1], ends[1:], strict=True):  # joined back by position
            own = known.take(pa.array(place[index[start:stop]])).flatten()
            totals.append(len(own))
            listed.append(strings(codec.forms.take(own))[1].tobytes()[:-1])
            texts.append(codec.decode(np.asarray(own)))
        ids_column = pa.array(listed, pa.binary()).cast(pa.string())
        return pa.table({"doc_id": table["doc_id"], "n_tokens": pa.array(totals, pa.int64()), "ids": ids_column, "decoded": pa.array(texts, pa.binary()).cast(pa.string())})

    return work


def encode(docs: DataFrame, model: str) -> DataFrame:
    """Encode every text of ``docs`` (doc_id, text, any others) and decode the ids again.

    ``model``: path of a SentencePiece model on the driver; its bytes travel with the job.
    Returns doc_id, n_tokens, ids (decimal, joined by commas) and decoded (the text that the ids stand for),
    without begin or end ids. Null and empty texts have no ids; each row is encoded, repeated
    or not; an empty table gives no rows.
    """
    with open(model, "rb") as file:
        codec = Codec(file.read())
    codec.check()
    blocks, weight = pack(docs)
    shards = shard_count(weight, SHARD_BYTES)
    answers = answer(send(blocks, _ask(shards)), _segment(codec))
    return settle(blocks, answers, _join(codec, shards), "doc_id long, n_tokens long, ids string, decoded string")
