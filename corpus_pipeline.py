"""From raw documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankflow.llm import decontaminate, lpf_dedup, quality, sentencepiece_codec, simhash
from rankflow.llm.common import store
from rankflow.session import shared_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _keyed(docs: DataFrame) -> DataFrame:
    """Add ``key``, 128 bits of all that a row says: rows share it only if they are the same.

    Ids may be null or repeat; verdicts are joined back by this key instead.
    """
    said = [f(F.col(c)) for c in COLUMNS[:4] for f in (F.isnull, lambda x: x)]
    return docs.withColumn("key", F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(i), *said)), 16, "0") for i in range(2)]))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the rules of their language and source reject."""
    docs = _keyed(docs)
    kept = quality.judge(docs, ("key",)).where("kept").select("key").distinct()
    return docs.join(kept, "key", "left_semi").select(*COLUMNS)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates keep one row, of the smallest id."""
    docs = _keyed(docs)
    chosen = store(simhash.representatives(docs, "key"))
    single = docs.join(chosen.where("n_rows = 1"), "key", "left_semi")
    # rows that are the same in all columns: any one of them
    several = docs.join(chosen.where("n_rows > 1"), "key", "left_semi").dropDuplicates(["key"])
    return single.unionByName(several).select(*COLUMNS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 200 bytes or more that occurred before; whole characters only."""
    left = lpf_dedup.remove_repeats(docs, keep_first=True, whole_characters=True, extra=("lang", "source"))
    left = left.withColumn("text", F.decode("kept", "UTF-8"))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain a benchmark item."""
    docs = _keyed(docs)
    texts = docs.select(F.col("key").alias("doc_id"), "text")
    found = decontaminate.contained(texts, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = found.select(F.col("doc_id").alias("key")).distinct()
    return docs.join(found, "key", "left_anti").select(*COLUMNS)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to."""
    return sentencepiece_codec.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

#: Fingerprints, components and segmentation have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
