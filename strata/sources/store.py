"""Small metadata files and folders in whatever store Spark reads, and tables whose versions switch at once.

Everything here goes through the Hadoop file system of the path, so that it works wherever the data lies. It
touches names and a few small files; rows are read and written by Spark alone.

A *numbered* folder holds files ``000000000001.json``, ``000000000002.json``, ... that are written under a
hidden name first and appear by a rename: a reader sees a file whole or not at all, and a number that is taken
already tells a second writer that it was overtaken.

:class:`Versions` keeps a set of tables in version folders. One numbered file names the folder of every table,
so a run that writes many tables becomes visible by one rename, or, if it dies, not at all.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

DIGITS = 12


class Overtaken(RuntimeError):
    """Another writer has published the same number first."""


class Store:
    """The file system of a path."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str = "") -> bool:
        return bool(self._fs.exists(self._path(name)))

    def names(self, name: str = "", folders: bool | None = None) -> list[str]:
        """Sorted names in a folder; nothing if there is no such folder."""
        if not self.exists(name):
            return []
        found = self._fs.listStatus(self._path(name))
        return sorted(s.getPath().getName() for s in found if folders is None or s.isDirectory() == folders)

    def read(self, name: str, limit: int = 1 << 28) -> bytes:
        stream = self._fs.open(self._path(name))
        try:
            return bytes(stream.readNBytes(limit))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def numbers(self, folder: str) -> list[int]:
        return [int(n[:DIGITS]) for n in self.names(folder, False) if n.endswith(".json") and n[:DIGITS].isdigit()]

    def numbered(self, folder: str, number: int) -> str:
        return f"{folder}/{number:0{DIGITS}d}.json"

    def publish(self, folder: str, number: int, content: dict) -> None:
        """Make ``content`` appear as the file of ``number``."""
        hidden, name = f"{folder}/.{uuid.uuid4().hex}", self.numbered(folder, number)
        if self.exists(name):
            raise Overtaken(f"{self.root}/{name} is there already")
        stream = self._fs.create(self._path(hidden), False)
        try:
            stream.write(json.dumps(content, sort_keys=True).encode())
        finally:
            stream.close()
        if self.exists(name) or not self._fs.rename(self._path(hidden), self._path(name)):
            self.delete(hidden)
            raise Overtaken(f"{self.root}/{name} is there already")

    def content(self, folder: str, number: int) -> dict:
        return json.loads(self.read(self.numbered(folder, number)))


class Versions:
    """The tables under ``root`` as of one version, and a run's new folders for them.

    The version is resolved once, when the object is made: whoever holds it goes on reading the same folders,
    whatever is published meanwhile (until they are pruned, ``keep`` versions later). A table that has never been
    published is read from ``<root>/<table>`` itself, where it lies without versions.
    """

    POINTERS = "_versions"

    def __init__(self, spark: SparkSession, root: str):
        self.store = Store(spark, root)
        numbers = self.store.numbers(self.POINTERS)
        self.number = numbers[-1] if numbers else 0
        self.tables: dict[str, str] = self.store.content(self.POINTERS, self.number)["tables"] if numbers else {}
        self.staged: dict[str, str] = {}

    def path(self, table: str) -> str:
        """Where to read a table: as staged by this run, else as published."""
        return f"{self.store.root}/{self.staged.get(table) or self.tables.get(table) or table}"

    def stage(self, table: str) -> str:
        """A fresh folder to write the next version of a table to."""
        self.staged[table] = f"{table}/v{self.number + 1:0{DIGITS}d}-{uuid.uuid4().hex[:8]}"
        return self.path(table)

    def publish(self, keep: int = 2) -> int:
        """Switch to the staged folders; folders that the last ``keep`` versions do not name are removed."""
        self.store.publish(self.POINTERS, self.number + 1, {"tables": self.tables | self.staged})
        self.number += 1
        self.tables, self.staged = self.tables | self.staged, {}
        self.prune(keep)
        return self.number

    def prune(self, keep: int) -> None:
        """Remove what no version kept can read: earlier folders, and those of runs that died before this one."""
        numbers = [n for n in self.store.numbers(self.POINTERS) if n <= self.number]
        for n in numbers[:-keep]:
            self.store.delete(self.store.numbered(self.POINTERS, n))
        used = {p for n in numbers[-keep:] for p in self.store.content(self.POINTERS, n)["tables"].values()}
        for table in self.tables:
            for name in self.store.names(table, True):
                if name[:1] == "v" and name[1 : 1 + DIGITS].isdigit() and int(name[1 : 1 + DIGITS]) <= self.number and f"{table}/{name}" not in used:
                    self.store.delete(f"{table}/{name}")
