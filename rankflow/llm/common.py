"""What the operators share: word patterns, reliable cuts of lineage, skew-safe joins."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankflow.session import ensure_checkpoint_dir

#: A word is a run of anything but these ASCII characters.
BLANKS = b" \t\n\x0b\x0c\r"
NON_WORD = r"[\x20\x09-\x0D]+"

#: A key with more than total / HOT_SHARE rows is hot; there can be at most HOT_SHARE such keys.
HOT_SHARE = 1000
#: Rows of a file of ``store``, unless there are fewer files than tasks at a time.
FILE_ROWS = 1 << 16


def cut(frame: DataFrame) -> DataFrame:
    """Store the rows in the shared checkpoint folder and go on from there."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()


def store(frame: DataFrame) -> DataFrame:
    """Like ``cut``, in as few files as the rows need.

    A step of many small partitions would write as many tiny files, and a file system that sets
    rights by a command starts one or two processes for each.
    """
    ensure_checkpoint_dir(frame.sparkSession)
    held = frame.persist()
    files = max(frame.sparkSession.sparkContext.defaultParallelism, -(-held.count() // FILE_ROWS))
    stored = held.coalesce(files).checkpoint()  # leaves fewer partitions as they are
    held.unpersist()
    return stored


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words of a text as an array; no words for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), NON_WORD), lambda w: w != "")


def null_safe_key(*columns: str) -> Column:
    """One string for several columns in which null and the empty string differ."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("0")) for c in columns]
    return F.concat_ws("\x01", *parts)


def join_hot(rows: DataFrame, table: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Inner join of many rows to one table row per key, hot keys apart.

    ``table`` holds one row per key and in ``count`` the number of rows with it.
    Keys with more than total / HOT_SHARE rows, at most HOT_SHARE of them, are joined
    by broadcast where their rows lie; all others meet by a shuffle.
    """
    hot = table.where(F.col(count) * HOT_SHARE > total)
    cold = table.where(F.col(count) * HOT_SHARE <= total)
    marks = F.broadcast(hot.select(key))
    there = rows.join(F.broadcast(hot), key)
    rest = rows.join(marks, key, "left_anti").join(cold, key)
    return there.unionByName(rest)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def slices(batch: pa.RecordBatch, text: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each, one row at least."""
    sizes = np.array(pa.compute.fill_null(pa.compute.binary_length(batch[text]), 0), dtype=np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def raw_texts(column: pa.Array) -> list[bytes]:
    """The texts of a column as UTF-8; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def sums_by_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the stretches between neighbouring offsets; empty stretches give 0."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]
