"""Commits: which files make up the tables below a folder, told by one small file written last.

Data files are only added, each write in a folder of its own. A commit lists, for every table, the
folders that hold it now; it is written beside its place and renamed to ``_commits/<number>.json``.
Readers take the newest commit, so they see all of a run or nothing of it, and whatever a failed run
left behind is named by no commit. Older commits stay readable until ``vacuum`` drops their files.

The store must rename files in one step and show them at once (HDFS, a local or a mounted disk).
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DATA, LOG = "data", "_commits"


@dataclass(frozen=True)
class TableFiles:
    """A table's schema and the folders of its parts, relative to the root; a part may have several."""

    schema: T.StructType
    parts: dict[str, tuple[str, ...]] = field(default_factory=dict)
    #: How the table is laid out, for whoever writes it next.
    layout: dict[str, int | str] = field(default_factory=dict)

    def read(self, spark: SparkSession, root: str, parts: list[str] | None = None) -> DataFrame:
        """Rows of all parts, or of those named; a column a folder lacks is NULL in its rows."""
        chosen = self.parts if parts is None else {p: self.parts[p] for p in parts if p in self.parts}
        paths = [f"{root}/{folder}" for folders in chosen.values() for folder in folders]
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def as_json(self) -> dict:
        return {"schema": self.schema.jsonValue(), "parts": self.parts, "layout": self.layout}

    @classmethod
    def from_json(cls, value: dict) -> TableFiles:
        parts = {name: tuple(folders) for name, folders in value["parts"].items()}
        return cls(T.StructType.fromJson(value["schema"]), parts, value["layout"])


@dataclass(frozen=True)
class Commit:
    number: int
    run_id: str
    tables: dict[str, TableFiles]


class Commits:
    """The commits of one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def new_folder(self) -> str:
        """A folder name, relative to the root, that no other write uses."""
        return f"{DATA}/{uuid.uuid4().hex}"

    def numbers(self) -> list[int]:
        """Numbers of all complete commits, oldest first."""
        path, files = self._path(LOG)
        if not files.exists(path):
            return []
        names = [s.getPath().getName() for s in files.listStatus(path)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_"))

    def get(self, number: int) -> Commit:
        path, files = self._path(f"{LOG}/{number:010d}.json")
        stream = files.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        found = json.loads(text)
        return Commit(number, found["run_id"], {name: TableFiles.from_json(t) for name, t in found["tables"].items()})

    def newest(self) -> Commit | None:
        numbers = self.numbers()
        return self.get(numbers[-1]) if numbers else None

    def publish(self, run_id: str, tables: dict[str, TableFiles], after: Commit | None) -> Commit:
        """Make ``tables`` the newest state, which was built on the commit ``after``.

        Refused if another commit was published in the meantime: its changes would be lost.
        """
        last, number = self.numbers()[-1:], (after.number if after else 0) + 1
        if last and last[0] >= number:
            raise RuntimeError(f"commit {last[0]} of {self.root} was published while {run_id} ran")
        content = {"run_id": run_id, "tables": {name: t.as_json() for name, t in tables.items()}}
        path, files = self._path(f"{LOG}/{number:010d}.json")
        beside, _ = self._path(f"{LOG}/_{uuid.uuid4().hex}")
        stream = files.create(beside, False)
        try:
            stream.write(bytearray(json.dumps(content).encode()))
        finally:
            stream.close()
        if files.exists(path) or not files.rename(beside, path):
            files.delete(beside, False)
            raise RuntimeError(f"commit {number} of {self.root} was published while {run_id} ran")
        return Commit(number, run_id, tables)

    def vacuum(self, keep: int = 1, idle_seconds: float = 86_400.0) -> list[str]:
        """Delete data folders that none of the last ``keep`` commits names; older commits go too.

        Folders changed within ``idle_seconds`` stay, since a run that has not ended may be writing them.
        """
        numbers = self.numbers()
        named = {
            "/".join(folder.split("/")[:2])
            for number in numbers[-keep:]
            for t in self.get(number).tables.values()
            for folders in t.parts.values()
            for folder in folders
        }
        for number in numbers[:-keep]:
            path, files = self._path(f"{LOG}/{number:010d}.json")
            files.delete(path, False)
        path, files = self._path(DATA)
        gone = []
        for status in files.listStatus(path) if files.exists(path) else []:
            folder = f"{DATA}/{status.getPath().getName()}"
            if folder not in named and status.getModificationTime() <= (time.time() - idle_seconds) * 1000:
                files.delete(status.getPath(), True)
                gone.append(folder)
        return sorted(gone)
