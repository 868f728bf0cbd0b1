"""Folders of a table, through the file system that Spark uses for its path."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession

from tierline.sources.tables import Period
from tierline.trips import PERIOD

#: Folder name Spark gives a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def period_folder(period: Period) -> str:
    """Folder of a period below a table's path."""
    return "/".join(f"{k}={NULL_PARTITION if v is None else v}" for k, v in zip(PERIOD, period))


class Folders:
    """Folders of the file system that holds ``path``; names are given from there on."""

    def __init__(self, spark: SparkSession, path: str):
        context = spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self._root = path.rstrip("/")
        self._conf = context._jsc.hadoopConfiguration()
        self._system = self._path(path).getFileSystem(self._conf)

    def _at(self, name: str):
        return self._path(f"{self._root}/{name}" if name else self._root)

    def exists(self, name: str = "") -> bool:
        return self._system.exists(self._at(name))

    def make(self, name: str) -> None:
        self._system.mkdirs(self._at(name))

    def delete(self, name: str = "") -> None:
        self._system.delete(self._at(name), True)

    def move(self, name: str, to: str) -> None:
        """``name`` becomes ``to``, which must not be there."""
        target = self._at(to)
        self._system.mkdirs(target.getParent())
        if self._system.exists(target) or not self._system.rename(self._at(name), target):
            raise OSError(f"{self._at(name).toString()} cannot be moved to {target.toString()}")

    def holds(self, path: str) -> bool:
        """Whether ``path`` is on this file system, so that folders can be moved there."""
        other = self._path(path).getFileSystem(self._conf)
        return other.getUri().toString() == self._system.getUri().toString()

    def move_out(self, name: str, to: str) -> None:
        """``name`` becomes the whole path ``to`` on the same file system."""
        target = self._path(to)
        self._system.mkdirs(target.getParent())
        if self._system.exists(target) or not self._system.rename(self._at(name), target):
            raise OSError(f"{self._at(name).toString()} cannot be moved to {to}")

    def periods(self, name: str = "") -> Iterator[str]:
        """Folders of periods below ``name``, as ``period_folder`` writes them."""
        if not self.exists(name):
            return
        for year in self._system.listStatus(self._at(name)):
            upper = year.getPath().getName()
            if year.isDirectory() and upper.startswith(f"{PERIOD[0]}="):
                for month in self._system.listStatus(year.getPath()):
                    yield f"{upper}/{month.getPath().getName()}"
