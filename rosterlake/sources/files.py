"""Folders and small marker files through the cluster's own file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """Moves, listings and small texts under any path Spark can write to."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names in a folder, in order; none where there is no folder."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def make(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def move(self, source: str, target: str) -> None:
        """Rename a file or folder in one step; the folder above the target is made."""
        self.make(target.rpartition("/")[0])
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def write(self, path: str, text: str) -> None:
        """A small text that is there whole or not at all: written beside its place, then moved."""
        out = self._fs.create(self._path(f"{path}.part"), True)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()
        self.move(f"{path}.part", path)

    def read(self, path: str) -> str:
        held = self._fs.open(self._path(path))
        try:
            return self._spark._jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8")
        finally:
            held.close()
