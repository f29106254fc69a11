"""Existence and removal of folders, on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """Names below one folder."""

    def __init__(self, spark: SparkSession, root: str):
        self._path_type = spark._jvm.org.apache.hadoop.fs.Path
        self.root = root.rstrip("/")
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path("").getFileSystem(conf)

    def _path(self, name: str):
        return self._path_type(f"{self.root}/{name}" if name else self.root)

    def has(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def names(self, pattern: str) -> list[str]:
        """Last parts of the paths that match, sorted."""
        found = self._fs.globStatus(self._path(pattern)) or []
        return sorted(s.getPath().getName() for s in found)

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)
