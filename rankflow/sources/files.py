"""Whole files on any file system that Spark reaches: ordered joining, listing, atomic small writes."""

from __future__ import annotations

import uuid

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import SparkSession

from rankflow.sources.paths import to_uri

_BUFFER = 4 << 20


class Files:
    """The file system that holds a path."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._system = self.path(to_uri(path)).getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(to_uri(name))

    def exists(self, name: str) -> bool:
        return self._system.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if it isn't there."""
        if not self.exists(folder):
            return []
        return sorted(entry.getPath().getName() for entry in self._system.listStatus(self.path(folder)))

    def size(self, name: str) -> int:
        return self._system.getFileStatus(self.path(name)).getLen()

    def remove(self, name: str) -> None:
        self._system.delete(self.path(name), True)

    def rename(self, name: str, to: str) -> None:
        if not self._system.rename(self.path(name), self.path(to)):
            raise OSError(f"{name} can't become {to}")

    def write_text(self, name: str, text: str) -> None:
        """A small file that is there as a whole or not at all."""
        draft = f"{name.rpartition('/')[0]}/_{uuid.uuid4().hex}"
        out = self._system.create(self.path(draft), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.remove(name)
        self.rename(draft, name)

    def joined(self, parts: list[str], target: str) -> str:
        """Join files in order into ``target``, which must not exist; says how: "concat" or "append".

        File systems that can, move the blocks of all parts into the first one. Otherwise the
        parts are streamed into the target through one small buffer. No rows are read, and
        no task holds more than a buffer of them. The parts are gone afterwards.
        """
        if self.exists(target):
            raise FileExistsError(target)
        parts = [part for part in parts if self.size(part)]
        if not parts:
            self._system.create(self.path(target), False).close()
            return "concat"
        try:
            if len(parts) > 1:
                sources = self._jvm.java.lang.reflect.Array.newInstance(self.path(parts[0]).getClass(), len(parts) - 1)
                for i, part in enumerate(parts[1:]):
                    sources[i] = self.path(part)
                self._system.concat(self.path(parts[0]), sources)
            self.rename(parts[0], target)
            return "concat"
        except UnsupportedOperationException:
            pass  # nothing has moved
        draft = f"{target}.{uuid.uuid4().hex}"
        out = self._system.create(self.path(draft), False)
        try:
            for part in parts:
                stream = self._system.open(self.path(part))
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, _BUFFER, False)
                finally:
                    stream.close()
        finally:
            out.close()
        self.rename(draft, target)
        for part in parts:
            self.remove(part)
        return "append"


def merge_parts(spark: SparkSession, folder: str, target: str, header: str | None = None) -> str:
    """Join the part files of a folder, in name order, into one file; the folder goes.

    ``header`` becomes the first line. Marker and hidden files are left out. Fails if the
    target exists.
    """
    files = Files(spark, folder)
    parts = [f"{folder}/{name}" for name in files.names(folder) if not name.startswith(("_", "."))]
    if header is not None:
        files.write_text(f"{folder}/header", header + "\n")
        parts.insert(0, f"{folder}/header")
    how = files.joined(parts, target)
    files.remove(folder)
    return how
