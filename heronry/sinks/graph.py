"""Tables declared with the tables they are made from; only what is stale is built again."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from heronry.session import is_complete

Build = Callable[..., DataFrame]


def content_mark(spark: SparkSession, path: str) -> str:
    """A digest of the names, sizes and change times of the files at ``path``; the same in every session."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files, found = fs.listFiles(at, True), []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()


@dataclass(frozen=True)
class Table:
    """A table made by ``build`` from the tables or sources whose names are ``inputs``, in that order. Change
    ``version`` when ``build`` changes."""

    build: Build
    inputs: tuple[str, ...]
    version: str = "1"


class TableGraph:
    """Declared tables over sources (name → path of a Parquet dataset), stored under ``root``.

    A table lies in a folder named by a digest of its version and of what its inputs were when it was built, so a
    stored table is either right or not looked at. An input that changes gives its descendants new folders, and
    them alone; older ones stay until somebody removes them.
    """

    def __init__(self, spark: SparkSession, root: str, sources: dict[str, str]):
        self.spark, self.root, self.sources = spark, root, dict(sources)
        self.tables: dict[str, Table] = {}

    def declare(self, name: str, build: Build, *inputs: str, version: str = "1") -> None:
        """Add a table; its inputs may be declared later."""
        if name in self.tables or name in self.sources:
            raise ValueError(f"{name} is declared twice")
        self.tables[name] = Table(build, inputs, version)

    def order(self, *wanted: str) -> list[str]:
        """The tables that ``wanted`` (by default all) need, each after its inputs. Unknown inputs and cycles are
        errors that name them."""
        needed, open_ = set(), list(wanted or self.tables)
        while open_:
            name = open_.pop()
            if name in needed or name in self.sources:
                continue
            if name not in self.tables:
                raise LookupError(f"no table or source {name}")
            needed.add(name)
            open_ += self.tables[name].inputs
        inputs = {n: [i for i in self.tables[n].inputs if i in self.tables] for n in sorted(needed)}
        try:
            return list(TopologicalSorter(inputs).static_order())
        except CycleError as error:
            raise ValueError(f"tables need each other: {' -> '.join(error.args[1])}") from error

    def _read(self, name: str, marks: dict[str, str]) -> DataFrame:
        path = self.sources[name] if name in self.sources else f"{self.root}/{name}/{marks[name]}"
        return self.spark.read.parquet(path)

    def refresh(self, *wanted: str) -> list[str]:
        """Build what is stale among ``wanted`` and the tables they need; returns the tables that were built."""
        return self._refresh(wanted)[0]

    def _refresh(self, wanted: tuple[str, ...]) -> tuple[list[str], dict[str, str]]:
        built, marks = [], {}
        for name in self.order(*wanted):
            table = self.tables[name]
            for i in table.inputs:
                if i in self.sources and i not in marks:
                    marks[i] = content_mark(self.spark, self.sources[i])
            state = repr((name, table.version, [(i, marks[i]) for i in table.inputs]))
            marks[name] = hashlib.sha256(state.encode()).hexdigest()[:32]
            path = f"{self.root}/{name}/{marks[name]}"
            if not is_complete(self.spark, path):
                made = table.build(*[self._read(i, marks) for i in table.inputs])
                made.write.mode("overwrite").parquet(path)
                built.append(name)
        return built, marks

    def read(self, name: str) -> DataFrame:
        """A table, brought up to date first."""
        return self._read(name, self._refresh((name,))[1])
