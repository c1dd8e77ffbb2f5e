"""Phrase collocations from lossless counters of word-id n-grams.

Documents are packed into blocks of one language each, their words numbered within the block. Words
are counted over all blocks, in shards by their hash; the frequent ones get ids. Then level by level: a phrase of
n + 1 words can be frequent only if its first n and its last n words are, so a block packs
(id of the first n words, id of the next word) into one number wherever both parts are frequent,
counts the numbers in counting quotient filters, one for each range of permuted numbers, and
sends them to the shards of these ranges. A shard merges the sorted filters of all blocks, gives
ids to what is frequent, and tells each block which of its entries these are. A block
is never larger than BLOCK_BYTES of text and one document, whatever language or source is hot, and a hot phrase
is one entry of a block's filter.

Counts are exact at every level: nothing is sampled, hashed together or cut off.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankflow.llm import quotient
from rankflow.llm.common import cut, raw_texts
from rankflow.llm.packets import freeze, thaw
from rankflow.session import shared_path

#: A phrase has 2 to LONGEST words and occurs LEAST times or more in its language.
LONGEST, LEAST = 5, 100
#: A candidate goes if a longer one has this share of its occurrences, in hundredths.
COVER = 100
FIRST = 2000
UNKNOWN = "und"
BLOCK_BYTES = 8 << 20
#: Entries that a shard holds at a time, on average.
SHARD_ENTRIES = 8 << 20
#: Totals of this many languages at most are broadcast.
MANY_LANGUAGES = 10_000
#: Parts in which the best of a language are found before they are compared.
SALTS = 32

SPACES, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_TABLE = bytes.maketrans(_UPPER + SPACES + BREAKS, _LOWER + b" " * len(SPACES) + b"\n" * len(BREAKS))

_BLOCK = "lang string, n_words long, words array<string>, counts array<long>, payload binary"
_PACKET = "block long, shard int, weight long, payload binary"
#: Shard of a block's own state, and block of a shard's own table.
STATE, TABLE = -1, -1


def tokens(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """The words of a text, lower-cased, and for each whether it begins a piece."""
    line = np.frombuffer(text.translate(_TABLE), np.uint8)
    ends = line == 10
    solid = ~(ends | (line == 32))
    begin = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]]))
    end = np.flatnonzero(solid & ~np.concatenate([solid[1:], [False]])) + 1
    offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_string(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(line[solid])]
    )
    piece = np.cumsum(ends)[begin]
    return words, np.concatenate([[True], piece[1:] != piece[:-1]]) if len(begin) else np.zeros(0, bool)


def _block(lang: str, texts: list[bytes]) -> dict:
    words, begins = tokens(b"\n".join(texts))
    numbered = words.dictionary_encode()
    local = np.asarray(numbered.indices, dtype=np.int64)
    counts = np.bincount(local, minlength=len(numbered.dictionary)).tolist()
    payload = freeze(local=local.astype(np.uint32), begins=np.packbits(begins))
    known = numbered.dictionary.to_pylist()
    return {"lang": lang, "n_words": len(local), "words": known, "counts": counts, "payload": payload}


def _blocks(batches: Iterator[pa.RecordBatch], size: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Blocks of ``size`` bytes of one language; all that is held is under 4 * size and one document."""
    held: dict[str, list[bytes]] = {}
    weight: dict[str, int] = {}

    def leave(lang: str) -> pa.RecordBatch:
        weight.pop(lang)
        return pa.RecordBatch.from_pylist([_block(lang, held.pop(lang))], schema=schema)

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), raw_texts(batch["text"]), strict=True):
            if not text:
                continue
            held.setdefault(lang, []).append(text)
            weight[lang] = weight.get(lang, 0) + len(text) + 1
            if weight[lang] >= size:
                yield leave(lang)
            elif sum(weight.values()) >= 4 * size:
                yield leave(max(weight, key=weight.get))
    for lang in list(held):
        yield leave(lang)


def pack(docs: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """Stored blocks: block, lang, n_words, words, counts, payload (word numbers, starts of pieces)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_BLOCK))
    spark = docs.sparkSession
    path = shared_path(spark, "phrases")
    texts = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    packed = texts.mapInArrow(lambda batches: _blocks(batches, size, schema), _BLOCK)
    packed.withColumn("block", F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


def _rows(block: int, shards: list[int], weights: list[int], payloads: list[bytes]) -> pa.Table:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
    columns = ([block] * len(shards), shards, weights, payloads)
    names = ["block", "shard", "weight", "payload"]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _entries(at: np.ndarray, gram: np.ndarray, last: np.ndarray, widths: tuple[int, int]) -> tuple[np.ndarray, ...]:
    """Phrases that are longer by a word: where they are, which entries these are; the entries and their counts.

    ``at``: places of frequent phrases in the block, with a gap between pieces; ``gram``: their ids;
    ``last``: ids of their last words. ``widths``: bits of a phrase's and of a word's id.
    """
    near = np.flatnonzero(at[1:] == at[:-1] + 1)
    packed = (gram[near].astype(np.uint64) << np.uint64(widths[1])) | last[near + 1].astype(np.uint64)
    entries, slots, counts = np.unique(quotient.permute(packed, sum(widths)), return_inverse=True, return_counts=True)
    return at[near], slots, entries, counts


def _filters(block: int, entries: np.ndarray, counts: np.ndarray, bits: int, shards: int, state: bytes | None = None) -> pa.Table:
    """A block's filter for each shard, and what the block must keep."""
    home = quotient.shard_of(entries, bits, shards)
    edges = np.concatenate([[0], np.flatnonzero(np.diff(home)) + 1, [len(home)]]) if len(home) else np.zeros(1, np.int64)
    filters = [quotient.encode(entries[a:b], counts[a:b], bits) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    starts = edges[:-1].tolist()
    if state is None:
        return _rows(block, home[starts].tolist(), starts, filters)
    return _rows(block, [STATE, *home[starts].tolist()], [0, *starts], [state, *filters])


def _longer(block: int, known: tuple[np.ndarray, np.ndarray], at: np.ndarray, slots: np.ndarray, widths: tuple[int, int], shards: int) -> pa.Table:
    """Filters of the phrases that follow from the answers (id and last word of each entry), and where they are."""
    gram, last = known[0][slots], known[1][slots]
    live = gram >= 0
    at, slots, entries, counts = _entries(at[live], gram[live], last[live], widths)
    if not len(entries):
        return _rows(block, [], [], [])
    state = freeze(gaps=np.diff(at, prepend=0).astype(np.uint32), slots=slots.astype(np.uint32))
    return _filters(block, entries, counts, sum(widths), shards, state)


def _listed(words: pa.Table, lang: str) -> bytes:
    sink = pa.BufferOutputStream()
    words = words.replace_schema_metadata({"lang": lang})
    with pa.ipc.new_stream(sink, words.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(words)
    return sink.getvalue().to_pybytes()


def _send_words(blocks: DataFrame, shards: int) -> DataFrame:
    """Each block's words with their numbers and counts, one message for each shard of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (block, lang) in enumerate(zip(batch["block"].to_pylist(), batch["lang"].to_pylist(), strict=True)):
                words, counts = batch["words"][i].values, batch["counts"][i].values
                if not len(words):
                    continue
                home = np.fromiter((zlib.crc32(w.encode()) for w in words.to_pylist()), np.int64, len(words)) % shards
                order = np.argsort(home, kind="stable")
                listed = pa.table({"local": np.arange(len(words)), "word": words.cast(pa.large_string()), "n": counts}).take(order)
                edges = np.concatenate([[0], np.flatnonzero(np.diff(home[order])) + 1, [len(order)]])
                payloads = [_listed(listed.slice(a, b - a), lang) for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield from _rows(block, home[order][edges[:-1]].tolist(), [0] * len(payloads), payloads).to_batches()

    return blocks.select("block", "lang", "words", "counts").mapInArrow(run, _PACKET)


def _merge_words(sent: DataFrame, shards: int, least: int) -> DataFrame:
    """The frequent words of each shard with their ids, and which of its words these are for each block."""

    def run(table: pa.Table) -> pa.Table:
        shard, messages = table["shard"][0].as_py(), []
        for payload in table["payload"]:
            words = pa.ipc.open_stream(payload.as_buffer()).read_all()
            messages.append((words.schema.metadata[b"lang"].decode(), words.replace_schema_metadata(None)))
        named = [words.append_column("lang", pa.repeat(pa.scalar(lang), len(words))) for lang, words in messages]
        sums = pa.concat_tables(named).group_by(["lang", "word"]).aggregate([("n", "sum")])
        often = sums.filter(pa.compute.greater_equal(sums["n_sum"], least)).sort_by([("lang", "ascending"), ("word", "ascending")])
        often = often.append_column("id", pa.array(np.arange(len(often)) * shards + shard, pa.int64())).combine_chunks()
        out = [(TABLE, len(often), _listed(often, ""))] if len(often) else []
        langs = np.asarray(often["lang"].to_pylist(), dtype=object)
        known = {lang: often.filter(pa.array(langs == lang)) for lang in set(langs)}
        for block, (lang, words) in zip(table["block"].to_pylist(), messages, strict=True):
            if lang not in known:
                continue
            own = known[lang]
            place = pa.compute.index_in(words["word"].combine_chunks(), value_set=own["word"].combine_chunks())
            at = np.flatnonzero(np.asarray(place.is_valid()))
            if len(at):
                ids = np.asarray(own["id"])[np.asarray(place.take(pa.array(at)))]
                out.append((block, 0, freeze(entries=np.asarray(words["local"])[at], ids=ids)))
        return _answers(shard, out)

    return cut(sent.groupBy("shard").applyInArrow(run, _PACKET))


def _answers(shard: int, out: list[tuple[int, int, bytes]]) -> pa.Table:
    columns = list(zip(*out, strict=True)) or [(), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.binary())
    block, weight, payload = (pa.array(c, k) for c, k in zip(columns, kinds, strict=True))
    names = ["block", "shard", "weight", "payload"]
    return pa.table([block, pa.array([shard] * len(block), pa.int32()), weight, payload], names=names)


def _known(size: int, payloads: list, starts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Id and last word of each of a block's entries by the shards' answers, -1 without one."""
    ids, last = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    for start, payload in zip(starts, payloads, strict=True):
        reply = thaw(payload.as_py())
        place = start + reply["entries"].astype(np.int64)
        ids[place], last[place] = reply["ids"], reply.get("last", reply["ids"])
    return ids, last


def _answered(size: int, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return _known(size, list(answers["payload"]), answers["weight"].to_pylist())


def _places(payload: bytes, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Where a block has frequent words, with a gap between pieces, and their ids."""
    own = thaw(payload)
    local = own["local"].astype(np.int64)
    begins = np.unpackbits(own["begins"], count=len(local))
    at = np.arange(len(local)) + np.cumsum(begins, dtype=np.int64)
    gram = _answered(int(local.max()) + 1, answers)[0][local]
    return at[gram >= 0], gram[gram >= 0]


def _replies(merged: DataFrame, level: int) -> DataFrame:
    return merged.where(F.col("block") != TABLE).select("block", F.lit(level).alias("level"), "weight", "payload")


def _pairs(blocks: DataFrame, words: DataFrame, widths: tuple[int, int], shards: int) -> DataFrame:
    """Filters of word pairs, from a block's words and the shards' answers."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not right.num_rows:
            return _rows(0, [], [], [])
        at, gram = _places(left["payload"][0].as_py(), right)
        _, _, entries, counts = _entries(at, gram, gram, widths)
        return _filters(left["block"][0].as_py(), entries, counts, sum(widths), shards)

    both = blocks.select("block", "payload").groupBy("block").cogroup(_replies(words, 1).groupBy("block"))
    return cut(both.applyInArrow(run, _PACKET))


def _triples(
    blocks: DataFrame, words: DataFrame, pairs: DataFrame, before: tuple[int, int], widths: tuple[int, int], shards: int
) -> DataFrame:
    """Filters of three words. Where pairs are is found anew: words take less space than places of pairs."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        level = np.asarray(right["level"])
        if not (level == 2).any():
            return _rows(0, [], [], [])
        at, gram = _places(left["payload"][0].as_py(), right.filter(pa.array(level == 1)))
        at, slots, entries, _ = _entries(at, gram, gram, before)
        known = _answered(len(entries), right.filter(pa.array(level == 2)))
        return _longer(left["block"][0].as_py(), known, at, slots, widths, shards)

    answers = _replies(words, 1).unionByName(_replies(pairs, 2))
    both = blocks.select("block", "payload").groupBy("block").cogroup(answers.groupBy("block"))
    return cut(both.applyInArrow(run, _PACKET))


def _go_on(sent: DataFrame, merged: DataFrame, level: int, widths: tuple[int, int], shards: int) -> DataFrame:
    """Filters of the next longer phrases, from a block's state and the shards' answers."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _rows(0, [], [], [])
        own = thaw(left["payload"][0].as_py())
        slots = own["slots"].astype(np.int64)
        known = _answered(int(slots.max()) + 1, right)
        return _longer(left["block"][0].as_py(), known, np.cumsum(own["gaps"].astype(np.int64)), slots, widths, shards)

    state = sent.where(F.col("shard") == STATE).select("block", "payload")
    return cut(state.groupBy("block").cogroup(_replies(merged, level).groupBy("block")).applyInArrow(run, _PACKET))


def _merge(sent: DataFrame, widths: tuple[int, int], shards: int, least: int) -> DataFrame:
    """The frequent entries of each shard, and which of its entries these are for each block."""
    bits = sum(widths)

    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        decoded = [quotient.decode(p.as_py()) for p in table["payload"]]
        numbers, sums, went = quotient.merge(decoded)
        often = sums >= least
        ids = np.where(often, (np.cumsum(often) - 1) * shards + shard, -1)
        packed = quotient.restore(numbers, bits)
        last = (packed & np.uint64((1 << widths[1]) - 1)).astype(np.int64)
        found = freeze(left=(packed[often] >> np.uint64(widths[1])).astype(np.int64), last=last[often], n=sums[often], id=ids[often])
        out = [(TABLE, int(often.sum()), found)] if often.any() else []
        start = 0
        for block, base, (own, _) in zip(table["block"].to_pylist(), table["weight"].to_pylist(), decoded, strict=True):
            here = went[start : start + len(own)]
            start += len(own)
            entries = np.flatnonzero(ids[here] >= 0)
            if len(entries):
                mine = here[entries]
                out.append((block, base, freeze(entries=entries.astype(np.uint32), ids=ids[mine], last=last[mine])))
        return _answers(shard, out)

    return cut(sent.where(F.col("shard") != STATE).groupBy("shard").applyInArrow(run, _PACKET))


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for payload in batch["payload"]:
            yield pa.RecordBatch.from_pydict(thaw(payload.as_py()))


def _unpacked_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for payload in batch["payload"]:
            words = pa.ipc.open_stream(payload.as_buffer()).read_all()
            plain = {c: words[c].cast(pa.string()) for c in ("lang", "word")}
            rows = pa.table({**plain, "n": words["n_sum"].cast(pa.int64()), "id": words["id"]})
            yield from rows.to_batches()


def frequent(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    block_bytes: int = BLOCK_BYTES,
    shards: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``longest`` words that occur ``least`` times or more in their language.

    Returns (lang, phrase, n_words, n), words joined by spaces, and (lang, n): all word occurrences.
    """
    spark = docs.sparkSession
    blocks = pack(docs, block_bytes)
    sizes = cut(blocks.groupBy("lang").agg(F.sum("n_words").alias("n")))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if shards is None:
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_ENTRIES))

    answers = _merge_words(_send_words(blocks, shards), shards, least)
    tables = answers.where(F.col("block") == TABLE)
    most = tables.agg(F.coalesce(F.max("weight"), F.lit(0))).first()[0]
    word_bits = max(1, (most * shards).bit_length())
    vocabulary = cut(tables.select("payload").mapInArrow(_unpacked_words, "lang string, word string, n long, id long"))
    known = vocabulary.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("n_words"), "n", "id")
    found = known
    words = vocabulary.select(F.col("id").alias("last"), "word")
    if most and longest > 1:
        widths = (word_bits, word_bits)
        sent = _pairs(blocks, answers, widths, shards)
        for level in range(2, longest + 1):
            merged = _merge(sent, widths, shards, least)
            tables = merged.where(F.col("block") == TABLE)
            most = tables.agg(F.coalesce(F.max("weight"), F.lit(0))).first()[0]
            if not most:
                break
            rows = tables.select("payload").mapInArrow(_unpacked, "left long, last long, n long, id long")
            parts = known.select(F.col("id").alias("left"), "lang", "phrase")
            named = rows.join(parts, "left").join(words, "last")
            phrase = F.concat_ws(" ", "phrase", "word").alias("phrase")
            known = cut(named.select("lang", phrase, F.lit(level).alias("n_words"), "n", "id"))
            found = found.unionByName(known)
            if level < longest:
                before, widths = widths, ((most * shards).bit_length(), word_bits)
                if sum(widths) > 64:
                    raise ValueError(f"phrases of {level + 1} words need {sum(widths)} bits; a packed number has 64")
                if level == 2:
                    sent = _triples(blocks, answers, merged, before, widths, shards)
                else:
                    sent = _go_on(sent, merged, level, widths, shards)
    return found.drop("id"), sizes


def _first(rows: DataFrame, most: int, *ordering: Column) -> DataFrame:
    """The first rows of each language with their rank; a hot language is ranked in parts before."""
    part = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    some = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*ordering)))
    some = some.where(F.col("rank") <= most)
    whole = F.row_number().over(Window.partitionBy("lang").orderBy(*ordering)).cast("long")
    return some.withColumn("rank", whole).where(F.col("rank") <= most)


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    cover: int = COVER,
    first: int = FIRST,
    block_bytes: int = BLOCK_BYTES,
    shards: int | None = None,
) -> DataFrame:
    """The best collocations of every language.

    ``docs``: text, lang, any others. A-Z are lower-cased, texts split at ``[.,;:!?\\x0A-\\x0D]`` into
    pieces and these into words ``[^\\x20\\x09]+``. Candidates are phrases of 2 to ``longest``
    words with ``least`` occurrences or more (a) in their language. A cut after k words gives l and r, the
    occurrences of both parts, and floor(1000 * a * n / (l * r)), n being all words of the language;
    the lowest score counts, ties to the smallest k. A candidate goes if it lies inside a longer
    one, itself gone or not, with ``cover`` hundredths of its occurrences or more. Returns lang, rank, phrase, a, l, r,
    n, score: the ``first`` of each language by score, then a, both descending, then phrase.

    A null text counts as empty, a null language as ``und`` (one language with rows that say
    so); repeated rows count as often as they occur; an empty table gives no rows. Arithmetic is exact for
    counts under 10 ** 17; larger ones raise an error.
    """
    found, sizes = frequent(docs, longest, least, block_bytes, shards)
    found = cut(found)
    parts = found.select("lang", F.col("phrase").alias("part"), F.col("n").alias("of"))
    split = F.split("phrase", " ")
    candidates = found.where("n_words > 1").select("lang", "phrase", "n_words", F.col("n").alias("a"), split.alias("w"))
    cuts = candidates.withColumn("k", F.explode(F.expr("sequence(1, n_words - 1)")))
    cuts = cuts.withColumn("head", F.array_join(F.expr("slice(w, 1, k)"), " "))
    cuts = cuts.withColumn("tail", F.array_join(F.expr("slice(w, k + 1, n_words - k)"), " ")).drop("w")
    cuts = cuts.join(parts.select("lang", F.col("part").alias("head"), F.col("of").alias("l")), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("part").alias("tail"), F.col("of").alias("r")), ["lang", "tail"])
    if sizes.count() <= MANY_LANGUAGES:
        sizes = F.broadcast(sizes)
    cuts = cuts.join(sizes, "lang")
    exact = {c: f"CAST({c} AS DECIMAL(17, 0))" for c in ("a", "n", "l", "r")}
    score = f"(CAST(1000 AS DECIMAL(4, 0)) * {exact['a']} * {exact['n']}) div ({exact['l']} * {exact['r']})"
    lowest = F.min(F.struct(F.expr(score).alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(lowest)

    inside = candidates.where("n_words > 2").select(
        "lang", "w", "a", "n_words", F.explode(F.expr("sequence(2, n_words - 1)")).alias("size")
    )
    inside = inside.withColumn("start", F.explode(F.expr("sequence(1, n_words - size + 1)")))
    inside = inside.select("lang", F.array_join(F.expr("slice(w, start, size)"), " ").alias("phrase"), "a")
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left")
    kept = kept.where(F.coalesce(F.col("longer") * 100 < F.col("a") * cover, F.lit(True)))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    best = _first(kept, first, F.desc("score"), F.desc("a"), F.asc("phrase"))
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
