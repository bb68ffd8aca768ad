"""Whole folders of a table, moved and dropped by the driver through Hadoop's file systems."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


class Folders:
    """The file system of one path. Every method is harmless to repeat."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._system.listStatus(self._path(path)))

    def files(self, path: str) -> list[tuple[str, int]]:
        """Path and bytes of all data files below a folder."""
        found, listed = [], self._system.listFiles(self._path(path), True) if self.exists(path) else None
        while listed is not None and listed.hasNext():
            file = listed.next()
            if not file.getPath().getName().startswith(("_", ".")):
                found.append((file.getPath().toString(), file.getLen()))
        return sorted(found)

    def matching(self, pattern: str) -> list[str]:
        return sorted(s.getPath().toString() for s in self._system.globStatus(self._path(pattern)) or [])

    def make(self, path: str) -> None:
        self._system.mkdirs(self._path(path))

    def drop(self, path: str) -> None:
        self._system.delete(self._path(path), True)

    def replace(self, source: str, target: str) -> None:
        """Put a folder in the place of another; nothing is left to do once the source is gone."""
        if self.exists(source):
            self.drop(target)
            self._move(source, target)

    def add_files(self, source: str, target: str) -> None:
        """Move a folder's files into another one; their names are unique."""
        for name in self.names(source):
            self._system.mkdirs(self._path(target))
            self._move(f"{source}/{name}", f"{target}/{name}")

    def _move(self, source: str, target: str) -> None:
        self._system.mkdirs(self._path(target).getParent())
        if not self._system.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def write_lines(self, path: str, lines: Iterable[str]) -> None:
        """A small text file that appears complete or not at all."""
        draft = f"{path}.draft"
        out = self._system.create(self._path(draft), True)
        out.write(bytearray("\n".join(lines).encode()))
        out.close()
        self.drop(path)
        self._move(draft, path)

    def read_lines(self, path: str) -> list[str]:
        source = self._system.open(self._path(path))
        try:
            return bytes(source.readAllBytes()).decode().split("\n")
        finally:
            source.close()
