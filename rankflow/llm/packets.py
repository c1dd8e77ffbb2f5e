"""Blocks of documents and compact messages between blocks and key shards.

Some operators look up every word or passage of a text in a table as large as the
corpus. One row per occurrence would multiply the text. Instead the documents are
packed into blocks, once, in a table in the shared checkpoint folder that is bucketed
by block, so the text itself never moves again. Each block sends its
distinct keys to shards chosen by a hash of the key, one message per shard; each
shard works on its own share of all keys and answers each block; the block and its
answers meet again by block id. Messages are rows with a compressed payload, moved
by ordinary groupings and co-groupings, so a lost task is simply run again. A hot key
reaches its shard at most once per block.
"""

from __future__ import annotations

import atexit
import contextlib
import io
import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.session import shared_path

BLOCK_BYTES = 10 << 20
LEVEL = 6
MESSAGE = "block long, shard int, payload binary"


def freeze(**arrays: np.ndarray) -> bytes:
    """Arrays as one compressed message; integers are split into byte planes, which pack better."""
    head, body = [], io.BytesIO()
    for name, array in arrays.items():
        array = np.ascontiguousarray(array)
        head.append((name, array.dtype.str, array.shape))
        planes = array.reshape(-1).view(np.uint8).reshape(-1, array.dtype.itemsize) if array.size else array
        body.write(np.ascontiguousarray(planes.T).tobytes() if array.size else b"")
    meta = json.dumps(head).encode()
    return zstandard.ZstdCompressor(level=LEVEL).compress(len(meta).to_bytes(4, "little") + meta + body.getvalue())


def thaw(payload: bytes) -> dict[str, np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(payload)
    size = int.from_bytes(data[:4], "little")
    at, found = 4 + size, {}
    for name, kind, shape in json.loads(data[4:at]):
        dtype, count = np.dtype(kind), int(np.prod(shape))
        planes = np.frombuffer(data, np.uint8, count * dtype.itemsize, at).reshape(dtype.itemsize, count)
        found[name] = np.ascontiguousarray(planes.T).view(dtype).reshape(shape) if count else np.zeros(shape, dtype)
        at += count * dtype.itemsize
    return found


def _blocks(size: int, extra: list[str]) -> Callable:
    def write(parts: list[pa.RecordBatch], weight: int) -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        codec = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=LEVEL))
        with pa.ipc.new_stream(sink, parts[0].schema, options=codec) as out:
            for part in parts:
                out.write_batch(part)
        payload = pa.array([sink.getvalue().to_pybytes()], pa.binary())
        return pa.RecordBatch.from_arrays([payload, pa.array([weight], pa.int64())], ["payload", "weight"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weight = [], 0
        for batch in batches:
            texts = batch["text"].cast(pa.binary()).fill_null(b"")
            ids = batch["doc_id"].cast(pa.int64())
            batch = pa.RecordBatch.from_arrays([ids, texts, *[batch[c] for c in extra]], ["doc_id", "text", *extra])
            ends = np.cumsum(np.asarray(pa.compute.binary_length(texts), dtype=np.int64) + 64)
            start = 0
            while start < len(ends):
                base = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, base + size - weight, "right")))
                # a slice written as such would carry the whole batch along
                part = pa.Table.from_batches([batch]).take(pa.array(np.arange(start, stop))).to_batches()
                held += part
                weight += int(ends[stop - 1] - base)
                start = stop
                if weight >= size:
                    yield write(held, weight)
                    held, weight = [], 0
        if held:
            yield write(held, weight)
        del held
        pa.default_memory_pool().release_unused()

    return run


def _forget(spark: SparkSession, table: str, path: str) -> None:
    """Drop a table of blocks when the application ends."""
    with contextlib.suppress(Exception):  # the session may be gone
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def pack(docs: DataFrame, size: int = BLOCK_BYTES, extra: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """Documents as stored blocks (block, payload, weight) of about ``size`` bytes of text; and all bytes.

    A null text becomes empty. Ids of blocks are fixed once stored. The table is
    bucketed by block and goes with the application.
    """
    spark = docs.sparkSession
    packed = docs.select("doc_id", "text", *extra).mapInArrow(_blocks(size, list(extra)), "payload binary, weight long")
    path, table = shared_path(spark, "blocks"), f"blocks_{uuid.uuid4().hex}"
    atexit.register(_forget, spark, table, path)
    writer = packed.withColumn("block", F.monotonically_increasing_id()).write.format("parquet")
    writer = writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "block")
    writer.option("compression", "uncompressed").option("path", path).saveAsTable(table)
    blocks = spark.table(table)
    return blocks, blocks.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]


def unpack(payload: bytes) -> pa.Table:
    """doc_id, text (binary) and extra columns of a block."""
    return pa.ipc.open_stream(payload).read_all().combine_chunks()


def send(blocks: DataFrame, work: Callable[[pa.Table], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Messages of every block: ``work`` yields (shard, payload) for the documents of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, payload in zip(batch["block"].to_pylist(), batch["payload"], strict=True):
                for shard, message in work(unpack(payload.as_buffer())):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int64()), pa.array([shard], pa.int32()), pa.array([message], pa.binary())],
                        ["block", "shard", "payload"],
                    )
        pa.default_memory_pool().release_unused()

    return blocks.select("block", "payload").mapInArrow(run, MESSAGE)


def answer(messages: DataFrame, work: Callable[[list[dict]], Iterator[bytes]]) -> DataFrame:
    """Answers of every shard: ``work`` gets the messages of all blocks and yields one answer for each."""

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table["block"].to_numpy(), kind="stable")
        payloads = table["payload"]  # read in place, for a sorted copy would hold them twice
        replies = list(work([thaw(payloads[int(at)].as_buffer()) for at in order]))
        blocks, shards = table["block"].take(order), table["shard"].take(order)
        pa.default_memory_pool().release_unused()  # a worker that waits for its next task keeps little
        return pa.table({"block": blocks, "shard": shards, "payload": pa.array(replies, pa.binary())})

    return messages.groupBy("shard").applyInArrow(run, MESSAGE)


def settle(
    blocks: DataFrame,
    answers: DataFrame,
    work: Callable[[pa.Table, dict[int, dict]], pa.Table],
    schema: str,
    with_block: bool = False,
) -> DataFrame:
    """Rows from every block: ``work`` gets its documents and the answers by shard."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        replies = {s: thaw(p.as_buffer()) for s, p in zip(right["shard"].to_pylist(), right["payload"], strict=True)}
        rows = work(unpack(left["payload"][0].as_buffer()), replies)
        pa.default_memory_pool().release_unused()
        if with_block:
            rows = rows.add_column(0, "block", pa.array([left["block"][0].as_py()] * len(rows), pa.int64()))
        return rows

    rows = blocks.select("block", "payload")
    schema = f"block long, {schema}" if with_block else schema
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def shard_count(weight: int, size: int) -> int:
    return max(1, -(-weight // size))


def strings(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary array, from 0 on."""
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(values) else np.zeros(0, np.uint8)
    return (offsets - offsets[0] if len(values) else np.zeros(1, np.int64)), data


def binary(offsets: np.ndarray, data: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """The array that ``strings`` took apart."""
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(kind or pa.binary(), len(offsets) - 1, buffers)
