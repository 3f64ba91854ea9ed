"""Numbered pointer files of which each number is taken once, and appends that are made known by them.

A pointer is written beside its place and then given its name in one step that
fails if the name is taken, so it is there complete or not at all. That step is
a hard link on ``file:`` and a rename without replacement, one operation of the
name node, on ``hdfs:`` and ``viewfs:``. Stores without such a step (``s3a:`` and the like)
are refused: give them a folder on one of these for their pointers.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Last line of a complete pointer.
_END = "."


class NoExclusiveName(RuntimeError):
    """The file system can't give a name to one writer only."""


class Pointers:
    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway
        self._folder = self.path(folder)
        self._files = self._folder.getFileSystem(self._conf)

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _child(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._folder, name)

    def found(self) -> dict[int, list[str] | None]:
        """Lines by number; None for a file without its end, which nobody reads but whose number is gone."""
        if not self._files.exists(self._folder):
            return {}
        names = [f.getPath().getName() for f in self._files.listStatus(self._folder) if f.isFile()]
        return {int(n): self._lines(n) for n in names if n.isdigit()}

    def _lines(self, name: str) -> list[str] | None:
        opened = self._files.open(self._child(name))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8")
        finally:
            opened.close()
        lines = text.split("\n")
        return lines[:-1] if lines[-1] == _END else None

    def claim(self, number: int, lines: list[str]) -> bool:
        """Write the pointer of a number; False if another writer has it."""
        aside = self._child(f"_aside/{uuid.uuid4().hex}")
        opened = self._files.create(aside, False)
        try:
            opened.write(bytearray("\n".join([*lines, _END]).encode()))
            opened.hflush()
        finally:
            opened.close()
        try:
            return self._name(aside, self._child(str(number)))
        finally:
            self._files.delete(aside, False)

    def _name(self, aside, place) -> bool:
        scheme = self._files.getUri().getScheme()
        try:
            if scheme == "file":
                file = self._jvm.java.io.File
                source, target = (file(p.toUri().getPath()).toPath() for p in (aside, place))
                self._jvm.java.nio.file.Files.createLink(target, source)
            elif scheme in ("hdfs", "viewfs"):
                self._rename_new(aside, place)
            else:
                raise NoExclusiveName(f"{scheme}: has no rename that fails if the name is taken")
        except NoExclusiveName:
            raise
        except Exception:
            if self._files.exists(place):
                return False
            raise
        return True

    def _rename_new(self, aside, place) -> None:
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        options = self._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), self._conf)
        context.rename(self._files.makeQualified(aside), self._files.makeQualified(place), options)


class AppendLog:
    """Appends to a folder of Parquet files by several writers.

    A writer reads the folder as of some number of appends, writes its rows
    beside it and claims the next number; if somebody else has claimed it, the
    rows were made from a stale view and are given up. Only then the files move
    into the folder. If a writer is lost before that, whoever comes next moves
    them. Readers need nothing but the folder.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder
        self._pointers = Pointers(spark, f"{folder}/_appends")
        self._files = self._pointers.path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def settled(self) -> int:
        """The number of the last append, after its files have been moved."""
        found = self._pointers.found()
        complete = [n for n, lines in found.items() if lines]
        if complete:
            self._move(found[max(complete)][0])
        return max(found, default=0)

    def append(self, rows: DataFrame, after: int) -> bool:
        """Add rows that were made from the folder as of append ``after``; False if there was another since."""
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self._folder}/_pending/{name}")
        if not self._pointers.claim(after + 1, [name]):
            self._files.delete(self._pointers.path(f"{self._folder}/_pending/{name}"), True)
            return False
        self._move(name)
        return True

    def _move(self, name: str) -> None:
        path = self._pointers.path
        pending = path(f"{self._folder}/_pending/{name}")
        if not self._files.exists(pending):
            return
        for file in self._files.listStatus(pending):
            part = file.getPath().getName()
            target = path(f"{self._folder}/{part}")
            # Two writers may finish one append: a file that is gone was moved by the other.
            if part.startswith("part-") and not self._files.exists(target):
                try:
                    moved = self._files.rename(file.getPath(), target)
                except Exception:  # noqa: BLE001  a missing source is an error on some file systems
                    moved = False
                if not moved and not self._files.exists(target):
                    raise RuntimeError(f"{file.getPath()} could not be moved to {target}")
        self._files.delete(pending, True)
