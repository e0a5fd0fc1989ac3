"""The few file system calls Spark's readers and writers do not offer."""

from __future__ import annotations

import os
import shutil

from pyspark.sql import SparkSession


class Folder:
    """A folder on whatever file system its path names.

    On a file system of the machine, what is asked for once per object, `exists` and
    `rename`, does without calls into the JVM.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._path_class = spark._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path_class(path).getFileSystem(conf)
        self._local = None
        if self.scheme == "file":
            self._local = self._fs.makeQualified(self._at("")).toUri().getPath()

    @property
    def scheme(self) -> str:
        """Of the file system that the path is on, named there or by default."""
        return self._fs.getUri().getScheme()

    def _at(self, name: str):
        return self._path_class(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        if self._local:
            return os.path.exists(f"{self._local}/{name}")
        return self._fs.exists(self._at(name))

    def names(self) -> list[str]:
        """Names of the direct children; none if the folder is not there."""
        if not self.exists():
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at("")))

    def make(self, name: str = "") -> None:
        self._fs.mkdirs(self._at(name))

    def rename(self, source: str, target: str) -> bool:
        if self._local:
            source, target = f"{self._local}/{source}", f"{self._local}/{target}"
            if os.path.exists(target):
                return False
            shutil.move(source, target)
            return True
        return self._fs.rename(self._at(source), self._at(target))

    def delete(self, name: str = "") -> None:
        self._fs.delete(self._at(name), True)
