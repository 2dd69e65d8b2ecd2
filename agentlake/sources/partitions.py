"""Listing only the partition directories that a filter wants.

Spark prunes partitions when it plans a scan, but lists the whole tree before that. Where the filter names partitions,
their directories are found level by level instead: a wanted value leads straight to its directory, a range takes one
listing of its level, and only what is left is handed to Spark. A query for a day of a lake of a thousand days thus
costs the same as in a lake of one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import SparkSession

#: Directories that are listed or looked up at once.
THREADS = 16


@dataclass(frozen=True)
class Wanted:
    """Partition values: the given ones, or those that a test accepts."""

    values: tuple[str, ...] | None = None
    test: Callable[[str], bool] | None = None

    def accepts(self, value: str) -> bool:
        return value in self.values if self.values is not None else self.test(value)


class Directories:
    """Directory listings of one Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.system = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self.names = self.jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.system.exists(self._path(path))

    def children(self, path: str) -> list[tuple[str, str, str]]:
        """(key, value, path) of the partition directories in a directory, by name; none if it does not exist."""
        place = self._path(path)
        if not self.system.exists(place):
            return []
        found = []
        for status in self.system.listStatus(place):
            key, sign, value = status.getPath().getName().partition("=")
            if sign and status.isDirectory():
                found.append((self.names.unescapePathName(key), self.names.unescapePathName(value), f"{path}/{status.getPath().getName()}"))
        return sorted(found)

    def child(self, path: str, key: str, value: str) -> str:
        return f"{path}/{self.names.escapePathName(key)}={self.names.escapePathName(value)}"


def partition_layout(directories: Directories, root: str) -> list[str]:
    """Partition columns from the top, as the first directory of each level has them."""
    keys, path = [], root
    while inside := directories.children(path):
        keys.append(inside[0][0])
        path = inside[0][2]
    return keys


def partition_directories(spark: SparkSession, root: str, wanted: Mapping[str, Wanted]) -> list[str] | None:
    """Directories below ``root`` that hold all rows with the wanted partition values, or None if no wanted column is a
    partition column, so that the root has to be read. An empty list: there are no such rows.

    Levels above the last wanted one are listed or looked up, several directories at a time; those below are left to Spark.
    """
    directories = Directories(spark, root)
    layout = partition_layout(directories, root)
    named = [k for k, key in enumerate(layout) if key in wanted]
    if not named:
        return None
    found = [root]
    with ThreadPoolExecutor(THREADS) as pool:
        for key in layout[: named[-1] + 1]:
            want = wanted.get(key)
            if want is not None and want.values is not None:
                paths = [directories.child(path, key, value) for path in found for value in want.values]
                found = [path for path, there in zip(paths, pool.map(directories.exists, paths)) if there]
            else:
                inside = pool.map(directories.children, found)
                found = [path for some in inside for own, value, path in some if own == key and (want is None or want.accepts(value))]
    return found
