"""Report tables kept by date partition and published together as numbered versions.

A run writes only the partitions it changes, into folders of its own, and then a
small manifest of them. The manifest appears under its final name by one rename, so a reader sees a
version whole or not at all, and every table of it from the same run. Folders are
never written again: an old version stays readable, and storage grows with what runs change.

    root/data/<table>/v=<n>/<column>=<date>/...   rows that version n wrote
    root/versions/n=<n>/...                       what changed: table, partition, removed

The state at version n is, for each table and partition, the last change up to n.
Partition columns are DATEs; a NULL date is a partition like any other. One run writes at a time: of
two that publish the same number the second fails and changes nothing. The rename is atomic on HDFS and local
file systems; where a store has no atomic rename, readers should take the versions a run has returned.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from holdcast.functions.dates import DateLike, as_date

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"      # the folder name Spark gives to a NULL partition
CHANGES = "name string, column string, part date, removed boolean, schema string, as_of date, note string"

Part = dt.date | None


class Versions:
    """The versions kept under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, *names: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *names]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, *folder: str) -> list[str]:
        """Names in one folder (not below it)."""
        place, fs = self._path(*folder), self._fs()
        return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []

    def numbers(self) -> list[int]:
        return sorted(int(n[2:]) for n in self._names("versions") if n.startswith("n="))

    def current(self) -> int:
        """Number of the newest version; 0 if there is none."""
        return max(self.numbers(), default=0)

    def changes(self, version: int | None = None) -> list:
        """Changes of all versions up to ``version``, one row for each written or removed partition."""
        numbers = [n for n in self.numbers() if version is None or n <= version]
        if not numbers:
            return []
        paths = [f"{self.root}/versions/n={n}" for n in numbers]
        rows = self.spark.read.schema(f"{CHANGES}, n int").option("basePath", f"{self.root}/versions").parquet(*paths)
        return rows.orderBy("n").collect()                  # a row for each changed date of a table

    def version_at(self, as_of: DateLike) -> int:
        """The newest version published for a date up to ``as_of``; 0 if there is none."""
        return max((r["n"] for r in self.changes() if r["as_of"] is not None and r["as_of"] <= as_date(as_of)), default=0)

    def note(self, version: int | None = None) -> str | None:
        rows = self.changes(version)
        return rows[-1]["note"] if rows else None

    def read(self, name: str, version: int | None = None, parts: Iterable[Part] | None = None) -> DataFrame | None:
        """Table ``name`` as of a version, or only some of its partitions; None if no version has it."""
        return self._read([r.asDict() for r in self.changes(version) if r["name"] == name], name, parts)

    def _read(self, changes: list[dict], name: str, parts: Iterable[Part] | None) -> DataFrame | None:
        if not changes:
            return None
        state = {r["part"]: r for r in changes}
        wanted = None if parts is None else set(parts)
        schema = T.StructType.fromJson(json.loads(changes[-1]["schema"]))
        paths = [f"{self.root}/data/{name}/v={r['n']}/{r['column']}={NULL_FOLDER if p is None else p.isoformat()}"
                 for p, r in state.items() if not r["removed"] and (wanted is None or p in wanted)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("v", T.IntegerType())]))
        return rows.option("basePath", f"{self.root}/data/{name}").parquet(*paths).select(schema.names)

    def begin(self, as_of: DateLike | None = None, note: str | None = None) -> "Draft":
        return Draft(self, as_of, note)


class Draft:
    """The next version while it is written. Nothing is visible to readers before ``publish``."""

    def __init__(self, versions: Versions, as_of: DateLike | None, note: str | None):
        self.versions, self.spark = versions, versions.spark
        self.number = versions.current() + 1
        self.before = [r.asDict() for r in versions.changes()]
        self.made: list[dict] = []
        self.as_of, self.note = None if as_of is None else as_date(as_of), note

    def write(self, name: str, df: DataFrame, column: str, replaced: Iterable[Part] | None = None) -> DataFrame:
        """Replace the partitions ``replaced`` (None: all) of a table by the rows of ``df``; its new state.

        A replaced partition without a row in ``df`` is removed. Rows outside ``replaced`` are an error.
        """
        place = f"{self.versions.root}/data/{name}/v={self.number}"
        df.write.mode("overwrite").partitionBy(column).parquet(place)
        folders = [n.split("=", 1)[1] for n in self.versions._names("data", name, f"v={self.number}") if n.startswith(f"{column}=")]
        present = {None if f == NULL_FOLDER else dt.date.fromisoformat(f) for f in folders}
        known = {r["part"]: r["removed"] for r in self.before if r["name"] == name}
        asked = set(known) | present if replaced is None else set(replaced)
        if present - asked:
            raise ValueError(f"{name}: rows for {sorted(map(str, present - asked))}, which are not replaced")
        gone = {p for p in asked - present if known.get(p) is False}
        # The partition column comes last, as Spark reads it back.
        schema = T.StructType([f for f in df.schema.fields if f.name != column] + [df.schema[column]]).json()
        for part in present | gone:
            self.made.append({"name": name, "column": column, "part": part, "removed": part in gone, "schema": schema, "n": self.number})
        return self.read(name)

    def read(self, name: str, parts: Iterable[Part] | None = None) -> DataFrame | None:
        """Table ``name`` as it will be."""
        return self.versions._read([r for r in self.before + self.made if r["name"] == name], name, parts)

    def publish(self) -> int:
        """Make the version visible; its number, or the current one if nothing changed."""
        if not self.made:
            return self.number - 1
        rows = [(r["name"], r["column"], r["part"], r["removed"], r["schema"], self.as_of, self.note) for r in self.made]
        hidden = f"_n={self.number}"
        self.spark.createDataFrame(rows, CHANGES).coalesce(1).write.mode("overwrite").parquet(f"{self.versions.root}/versions/{hidden}")
        fs, target = self.versions._fs(), self.versions._path("versions", f"n={self.number}")
        if fs.exists(target) or not fs.rename(self.versions._path("versions", hidden), target):
            raise RuntimeError(f"version {self.number} of {self.versions.root} was published by another run")
        return self.number
