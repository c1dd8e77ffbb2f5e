"""Session helpers: checkpoint folder, scoped settings, a local session."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(app: str, cores: str = "*", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make reliable checkpoints possible.

    The folder named by the cluster (``spark.checkpoint.dir``, or a folder the
    application already set) wins. Only a local master falls back to a scratch
    folder of this machine: on a cluster other executors could not read it.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that all executors share"
            )
        folder = tempfile.mkdtemp(prefix="rankflow-")
    context.setCheckpointDir(folder)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for intermediate files in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scoped_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply SQL settings for the span of a block, then put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Delete the files of the block's shuffles at its end, for blocks whose results are stored.

    Else they stay until the driver happens to collect its garbage. Whoever still asks for one of them, such as a
    lost part of a stored table, has it computed again.
    """
    context = spark.sparkContext._jsc.sc()
    first = context.newShuffleId()
    try:
        yield
    finally:
        for number in range(first + 1, context.newShuffleId()):
            context.shuffleDriverComponents().removeShuffle(number, False)
