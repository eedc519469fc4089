"""Parquet tables under one root.

A table is a set of folders, one per load, or one for all after a replacement. Which folders it has is told by a log of
commits (``commits``). Rows are written to fresh folders first and become visible with the commit that names them, for all tables
of a ``Change`` at once: a writer that stops before leaves unnamed folders, which nobody reads and ``sweep`` removes.

Of writers at the same time, appends all stay. Who replaces a table that another writer changed since it was last read here gets a
``ConflictError``, as does a change whose ``depends`` moved. A replaced table's folders are kept until the next replacement, for
readers that have begun.

Names are created in one step on HDFS, local disks and stores that can create a file only if it is absent.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from feedloom.sinks.commits import CommitLog, ConflictError

#: The one load of a table that was replaced.
BASE = "base"


class Change:
    """Rows of several tables, written aside and published together."""

    def __init__(self, tables: Tables, depends: Iterable[str] = ()):
        self.tables = tables
        self.base = tables.log.state().number
        self.changes: list[dict] = []
        self._since = {name: self.base for name in depends}

    def append(self, name: str, rows: DataFrame, load_id: str) -> DataFrame:
        """Rows of one load; returns what was written."""
        return self._write("append", name, rows, load_id)

    def replace(self, name: str, rows: DataFrame) -> DataFrame:
        self._depend(name)
        return self._write("replace", name, rows, BASE)

    def drop(self, names: Iterable[str]) -> None:
        for name in names:
            self._depend(name)
            self.changes.append({"do": "drop", "table": name})

    def mark(self, name: str, at: int) -> None:
        """Note that some step has worked up to commit ``at``."""
        self.changes.append({"do": "mark", "name": name, "at": at})

    def _depend(self, name: str) -> None:
        self._since.setdefault(name, min(self.base, self.tables.read_at.get(name, self.base)))

    def _write(self, kind: str, name: str, rows: DataFrame, load_id: str) -> DataFrame:
        folder = f"part-{uuid.uuid4().hex}"
        # Half of a stored row are hex digests, which snappy does not shrink.
        rows.write.option("compression", "zstd").parquet(f"{self.tables.path(name)}/{folder}")
        self.changes.append({"do": kind, "table": name, "load": load_id, "folder": folder, "schema": rows.schema.json()})
        return self.tables.spark.read.schema(rows.schema).parquet(f"{self.tables.path(name)}/{folder}")

    def publish(self) -> int:
        """Make all of it visible; returns the number of the commit."""
        try:
            number, unused = self.tables.log.commit(self.changes, self._since)
        except ConflictError as error:
            # The next attempt reads them again, or means to replace them whatever they hold.
            for name in error.names:
                self.tables.read_at.pop(name, None)
            raise
        for c in self.changes:
            if c["do"] != "mark":
                self.tables.read_at[c["table"]] = number
        for folder in unused:
            self.tables._delete(self.tables.path(folder))
        return number

    def discard(self) -> None:
        """Remove what was written aside."""
        for c in self.changes:
            if "folder" in c:
                self.tables._delete(f"{self.tables.path(c['table'])}/{c['folder']}")


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, self.root)
        #: The commit at which each table was last read here.
        self.read_at: dict[str, int] = {}

    def _delete(self, path: str) -> None:
        fs, folder = self.log._fs(path)
        fs.delete(folder, True)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _folders(self, name: str) -> dict[str, tuple[str, int, int]]:
        state = self.log.state()
        self.read_at[name] = state.number
        return dict(state.tables[name].folders) if name in state.tables else {}

    def exists(self, name: str) -> bool:
        return bool(self._folders(name))

    def change(self, depends: Iterable[str] = ()) -> Change:
        return Change(self, depends)

    def append(self, name: str, rows: DataFrame, load_id: str) -> None:
        """Store the rows of one load."""
        change = self.change()
        change.append(name, rows, load_id)
        change.publish()

    def replace(self, name: str, rows: DataFrame) -> DataFrame:
        """Store new rows in place of all."""
        change = self.change()
        change.replace(name, rows)
        change.publish()
        return self.read(name)

    def has_load(self, name: str, load_id: str) -> bool:
        return load_id in self._folders(name)

    def loads(self, name: str) -> list[str]:
        """Ids of the stored loads in the order of their commits."""
        return list(self._folders(name))

    def pending(self, name: str, step: str) -> tuple[list[str], list[str], int]:
        """Loads of a table, those that a step has not worked on, and what it marks when it has."""
        mark = self.log.state().marks.get(step, -1)
        folders = self._folders(name)
        return list(folders), [x for x, (_, number, _) in folders.items() if number > mark], max((n for _, n, _ in folders.values()), default=-1)

    def read(
        self, name: str, without: Sequence[str] = (), only: Sequence[str] | None = None, evolving: bool = False
    ) -> DataFrame | None:
        """The published rows, or None before the first write.

        ``without`` leaves out loads, for a step that is about to write them again; ``only`` reads some loads. The others'
        folders are not opened. ``evolving`` merges the schemas of the loads (raw tables gain columns).
        """
        folders = self._folders(name)
        if not folders:
            return None
        chosen = {load: f for load, f in folders.items() if load not in without and (only is None or load in only)}
        schema = self._schema(name, sorted({number for _, _, number in (chosen or folders).values()}), evolving)
        if not chosen:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path(name)}/{f}" for f, _, _ in chosen.values()])

    def _schema(self, name: str, numbers: list[int], evolving: bool) -> T.StructType:
        """The schema of the folders from the log, so that no file is opened for it."""
        schemas = [T.StructType.fromJson(json.loads(self.log.state().tables[name].schemas[n])) for n in numbers]
        if not evolving:
            return schemas[-1]
        fields = {f.name: f for s in schemas for f in s.fields}
        return T.StructType(list(fields.values()))

    def read_load(self, name: str, load_id: str) -> DataFrame | None:
        """The rows of one load only."""
        return self.read(name, only=[load_id]) if self.has_load(name, load_id) else None

    def read_or_empty(self, name: str, schema: T.StructType) -> DataFrame:
        stored = self.read(name)
        return stored if stored is not None else self.spark.createDataFrame([], schema)

    def drop(self, names: list[str]) -> None:
        """Remove the tables of one feed."""
        change = self.change()
        change.drop(names)
        change.publish()

    def sweep(self, name: str, older_than: dt.timedelta, now: dt.datetime) -> int:
        """Remove folders of a table that no commit names, if they are older than any running job; returns how many."""
        table = self.log.state().tables.get(name)
        named = {f for f, _, _ in table.folders.values()} | set(table.retired) if table else set()
        fs, path = self.log._fs(self.path(name))
        limit = int((now - older_than).timestamp() * 1000)
        doomed = [
            s.getPath().getName() for s in (fs.listStatus(path) if fs.exists(path) else [])
            if s.getPath().getName().startswith("part-") and s.getPath().getName() not in named and s.getModificationTime() < limit
        ]
        for folder in doomed:
            self._delete(f"{self.path(name)}/{folder}")
        return len(doomed)
