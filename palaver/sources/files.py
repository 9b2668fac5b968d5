"""Directories by the file system interface that Spark itself uses, for any store it can read."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The file system of a path, by Hadoop's own interface: listing, marks and removal."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def matching(self, pattern: str) -> list[str]:
        found = self._fs.globStatus(self._path(pattern))
        return sorted(s.getPath().toString() for s in found or [])

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def touch(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()

    def move(self, path: str, to: str) -> None:
        """Rename within this file system; ``to`` must not exist."""
        self._fs.mkdirs(self._path(to).getParent())
        if not self._fs.rename(self._path(path), self._path(to)):
            raise OSError(f"could not move {path} to {to}")

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)
