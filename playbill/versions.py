"""Tables in versions: a refresh never takes rows away from readers, and is seen as a whole.

A store is a folder. Each load writes the table folders it changes under a name of its own,
``<table>/load=<n>-<id>/<partition>=<value>/...``, and then adds one line to the log: the file
``_log/<n>.json``, which lists for every table the folders that make it up from now on. Creating
that file, which fails where it exists, is the switch. Until then, and if a load ends half-way,
readers see the entry before; of two loads that began from the same entry, one fails. Folders that
a load does not touch stay in the list as they are, so their files keep their names.

Batches have names; the log tells which ones have been applied.
"""

import json
import uuid
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playbill.session import bounded_tasks

LOG = "_log"
LOAD = "load"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class LoadConflict(RuntimeError):
    """Another load was committed since this one began."""


@dataclass(frozen=True)
class Snapshot:
    """One entry of the log: the folders of each table, relative to the store."""

    version: int
    tables: dict[str, tuple[str, ...]] = field(default_factory=dict)
    batch: str | None = None


def partition_values(folder: str) -> tuple[str | None, ...]:
    """The partition values in a folder's name, as texts; None for null."""
    values = [unquote(part.split("=", 1)[1]) for part in folder.split("/") if "=" in part]
    return tuple(None if v == NO_VALUE else v for v in values[1:])


class Store:
    """A folder of versioned tables."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        if not self._files.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(path))

    def versions(self) -> list[int]:
        """The numbers of the log, falling; the newest may still be being written."""
        names = [n.removesuffix(".json") for n in self._names(LOG) if n.endswith(".json")]
        return sorted((int(n) for n in names if n.isdigit()), reverse=True)

    def _entry(self, version: int) -> Snapshot | None:
        path = f"{self.root}/{LOG}/{version:012d}.json"
        rows = self.spark.read.text(path, wholetext=True).collect()
        try:
            read = json.loads(rows[0][0]) if rows else {}
        except ValueError:
            read = {}
        if "tables" not in read:  # being written
            return None
        return Snapshot(version, {t: tuple(f) for t, f in read["tables"].items()}, read["batch"])

    def snapshot(self) -> Snapshot | None:
        """The newest whole entry of the log."""
        for version in self.versions():
            if found := self._entry(version):
                return found
        return None

    def applied(self, batch: str) -> bool:
        """Whether a load of this name is in the log."""
        if not self.versions():
            return False
        entries = self.spark.read.schema("batch string").json(f"{self.root}/{LOG}")
        return not entries.filter(F.col("batch") == batch).isEmpty()

    def stage(
        self, table: str, df: DataFrame, partitions: tuple[str, ...] = (), **options: str
    ) -> tuple[str, ...]:
        """Write rows to a folder that no entry names yet; returns the table folders written."""
        load = f"{table}/{LOAD}={len(self.versions())}-{uuid.uuid4().hex[:12]}"
        writer = df.write.option("compression", "snappy").options(**options)
        if partitions:
            writer = writer.partitionBy(*partitions)
        with bounded_tasks(self.spark):
            writer.parquet(f"{self.root}/{load}")
        folders = [load]
        for _ in partitions:
            folders = [f"{f}/{n}" for f in folders for n in self._names(f) if "=" in n]
        return tuple(folders)

    def commit(
        self, base: Snapshot | None, tables: dict[str, tuple[str, ...]], batch: str | None = None
    ) -> Snapshot:
        """Make these tables current, beside those of ``base``; fails if another load was first."""
        version = base.version + 1 if base else 0
        whole = {**(base.tables if base else {}), **tables}
        line = json.dumps({"version": version, "batch": batch, "tables": whole}) + "\n"
        path = self._path(f"{self.root}/{LOG}/{version:012d}.json")
        try:
            out = self._files.create(path, False)
        except Py4JJavaError as error:
            if self._files.exists(path):
                raise LoadConflict(f"version {version} of {self.root} is there already") from error
            raise
        try:
            out.write(bytearray(line.encode()))
        finally:
            out.close()
        return Snapshot(version, whole, batch)

    def read(
        self,
        table: str,
        schema: T.StructType,
        snapshot: Snapshot | None = None,
        folders: tuple[str, ...] | None = None,
    ) -> DataFrame:
        """A table as of a snapshot, by default the newest; or only some of its folders."""
        if folders is None:
            snapshot = snapshot or self.snapshot()
            if snapshot is None:
                raise FileNotFoundError(f"no load was committed to {self.root}")
            folders = snapshot.tables[table]
        if not folders:
            return self.spark.createDataFrame([], schema)
        typed = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
        reader = self.spark.read.schema(typed).option("basePath", f"{self.root}/{table}")
        return reader.parquet(*[f"{self.root}/{f}" for f in folders]).select(schema.fieldNames())

    def paths(self) -> list[str]:
        """The folders of the newest snapshot, of all tables."""
        found = self.snapshot()
        return [f"{self.root}/{f}" for own in found.tables.values() for f in own] if found else []

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove load folders that none of the newest ``keep`` entries names, and return them.

        Not to be called while a load runs, whose folders no entry names yet. The log stays, as it
        tells which batches were applied.
        """
        entries = [e for e in map(self._entry, self.versions()[:keep]) if e]
        used = {"/".join(f.split("/")[:2]) for e in entries for own in e.tables.values() for f in own}
        tables = {t for e in entries for t in e.tables}
        removed = []
        for table in sorted(tables):
            for name in self._names(table):
                folder = f"{table}/{name}"
                if name.startswith(f"{LOAD}=") and folder not in used:
                    self._files.delete(self._path(f"{self.root}/{folder}"), True)
                    removed.append(folder)
        return removed


def is_store(spark: SparkSession, path: str) -> bool:
    return bool(Store(spark, path)._names(LOG))


def table_rows(spark: SparkSession, path: str, table: str, schema: T.StructType) -> DataFrame:
    """A table by its schema, from a store or from a plain folder of Parquet files."""
    if is_store(spark, path):
        return Store(spark, path).read(table, schema)
    return spark.read.schema(schema).parquet(path)


def table_paths(spark: SparkSession, path: str) -> list[str]:
    """What is to be read of a store or a plain folder."""
    return Store(spark, path).paths() if is_store(spark, path) else [path]
