"""Versioned publication of a set of tables: generation folders and one pointer for all of them.

::

    base/generations/<unique>/<table>.parquet/...    written once, never changed
    base/versions/000000000007.json                  which folders make up every table of version 7

A :class:`Change` writes new generations beside the old ones; nothing refers to them until
:meth:`Change.commit` puts the next version's file in place by one rename that fails if another writer was
faster.  Readers take the version with the largest number and see all tables of that version, however
many changes are under way; a job that dies leaves the last version as it was.  A partitioned table is a
list of partition folders, so a version that replaces some partitions shares all others with its
predecessor.  Old versions stay readable until :meth:`Versions.release`.

On the driver are the names of partition folders only.  Works on any file system that Hadoop knows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .parquet import remove, write_table

#: a table: its partition columns, and per generation the partition folders taken from it (None: all)
Table = tuple[tuple[str, ...], dict[str, list[str] | None]]


@dataclass
class Version:
    """One published state of all tables."""
    versions: "Versions"
    number: int
    tables: dict[str, Table] = field(default_factory=dict)

    def read(self, name: str, schema: T.StructType, only: Iterable[str] | None = None) -> DataFrame:
        """A table with its declared schema (partition columns last); ``only`` some partition folders."""
        spark, base = self.versions.spark, self.versions.base
        parts, pieces = self.tables[name]
        fields = [f for f in schema.fields if f.name not in parts] + [schema[c] for c in parts]
        wanted = None if only is None else set(only)
        frames = []
        for root, folders in pieces.items():
            if folders is None:
                if wanted is not None:
                    raise ValueError(f"{name} has no partitions")
                frames.append(spark.read.schema(T.StructType(fields)).parquet(f"{base}/{root}"))
                continue
            paths = [f"{base}/{root}/{f}" for f in folders if wanted is None or f in wanted]
            if paths:
                frames.append(spark.read.schema(T.StructType(fields)).option("basePath", f"{base}/{root}")
                              .parquet(*paths))
        if not frames:
            return spark.createDataFrame([], T.StructType(fields))
        return reduce(DataFrame.unionByName, frames)


class Versions:
    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(self.base).getFileSystem(self._conf)

    def numbers(self) -> list[int]:
        folder = self._path(f"{self.base}/versions")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def version(self, number: int) -> Version:
        path = self._path(self._file(number))
        stream = self._fs.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(self, number, {n: (tuple(parts), pieces)
                                      for n, (parts, pieces) in json.loads(text).items()})

    def latest(self) -> Version | None:
        """The published version, None before the first."""
        numbers = self.numbers()
        return self.version(numbers[-1]) if numbers else None

    def change(self) -> "Change":
        """A change of the published version, to be committed as the next one."""
        return Change(self, self.latest())

    def release(self, keep: int = 1) -> list[str]:
        """Drop all but the newest ``keep`` versions, then the generations that none of these uses (also
        those of changes that never were committed: not to be called while one is under way)."""
        if keep < 1:
            raise ValueError("the published version cannot be released")
        numbers = self.numbers()
        for n in numbers[:-keep]:
            self._fs.delete(self._path(self._file(n)), False)
        used = {root.split("/")[1] for n in numbers[-keep:]
                for _, pieces in self.version(n).tables.values() for root in pieces}
        folder = self._path(f"{self.base}/generations")
        found = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        gone = [g for g in found if g not in used]
        for g in gone:
            remove(self.spark, f"{self.base}/generations/{g}")
        return gone

    def _file(self, number: int) -> str:
        return f"{self.base}/versions/{number:012d}.json"

    def _publish(self, number: int, tables: dict[str, Table]) -> None:
        """Write the version's file under another name, then rename it: there it is whole or not at all."""
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        waiting = self._path(f"{self.base}/versions/.{uuid.uuid4().hex}")
        stream = self._fs.create(waiting, True)
        stream.write(bytearray(json.dumps(tables, indent=1).encode()))
        stream.close()
        target = self._path(self._file(number))
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.makeQualified(target).toUri(), self._conf)
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            files.rename(self._fs.makeQualified(waiting), self._fs.makeQualified(target),
                         gateway.new_array(rename, 0))  # without OVERWRITE
        except Exception as e:
            self._fs.delete(waiting, False)
            raise RuntimeError(f"version {number} was published by another writer") from e


class Change:
    """Tables of the next version; nothing is visible before :meth:`commit`."""

    def __init__(self, versions: Versions, before: Version | None):
        self.versions, self.before = versions, before
        self.number = before.number + 1 if before else 1
        self.tables: dict[str, Table] = dict(before.tables) if before else {}
        self.generation = f"generations/{uuid.uuid4().hex[:16]}"
        self._n = 0

    def read(self, name: str, schema: T.StructType, only: Iterable[str] | None = None) -> DataFrame:
        """A table as this change would publish it."""
        return Version(self.versions, self.number, self.tables).read(name, schema, only)

    def write(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> str:
        """Write rows to this change's generation; returns the folder (below the base), used by nobody yet."""
        self._n += 1
        root = f"{self.generation}/{self._n}-{name}.parquet"
        write_table(df, f"{self.versions.base}/{root}", partition_by)
        return root

    def use(self, name: str, root: str, partition_by: Sequence[str] = (), keep_others: bool = False,
            drop: Iterable[str] = ()) -> None:
        """Make a folder from :meth:`write` the table; ``keep_others``: only the partitions met in it and
        those of ``drop``, all others stay as they are, unread."""
        fresh = self._folders(root, partition_by)
        pieces: dict[str, list[str] | None] = {root: fresh}
        if keep_others:
            gone = {*fresh, *drop}
            old = self.tables.get(name, ((), {}))[1]
            kept = {r: [f for f in folders if f not in gone] for r, folders in old.items()}
            pieces = {r: f for r, f in (kept | pieces).items() if f}
        self.tables[name] = (tuple(partition_by), pieces)

    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> str:
        """The table consists of these rows alone."""
        root = self.write(name, df, partition_by)
        self.use(name, root, partition_by)
        return root

    def replace_partitions(self, name: str, df: DataFrame, partition_by: Sequence[str],
                           drop: Iterable[str] = ()) -> str:
        """The partitions met in ``df`` consist of these rows alone; those of ``drop`` that are not met
        vanish; all others stay."""
        root = self.write(name, df, partition_by)
        self.use(name, root, partition_by, keep_others=True, drop=drop)
        return root

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> str:
        """These rows beside those that are there."""
        root = self.write(name, df, partition_by)
        _, pieces = self.tables.get(name, (tuple(partition_by), {}))
        self.tables[name] = (tuple(partition_by), {**pieces, root: self._folders(root, partition_by)})
        return root

    def commit(self) -> Version:
        self.versions._publish(self.number, self.tables)
        return self.versions.version(self.number)

    def _folders(self, root: str, partition_by: Sequence[str]) -> list[str] | None:
        """The partition folders written below ``root``."""
        if not partition_by:
            return None
        fs, path = self.versions._fs, self.versions._path
        names = [""]
        for _ in partition_by:
            names = [f"{n}/{s.getPath().getName()}".lstrip("/") for n in names
                     for s in fs.listStatus(path(f"{self.versions.base}/{root}/{n}"))
                     if s.isDirectory() and "=" in s.getPath().getName()]
        return sorted(names)


def partition_folder(spark: SparkSession, names: Sequence[str], values: Sequence) -> str:
    """The folder of a partition as Spark spells it (``year=1997/month=5``)."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(f"{utils.escapePathName(n)}=" + ("__HIVE_DEFAULT_PARTITION__" if v is None or v == ""
                                                    else utils.escapePathName(str(v)))
                    for n, v in zip(names, values, strict=True))

