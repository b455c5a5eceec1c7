"""A catalog of Parquet tables whose versions are swapped by one pointer.

A table is a folder of version folders and a manifest that lists those in force. Overwriting puts a new version in force,
appending adds one; a reader sees the manifest of one moment and never half a write. publish() replaces the manifests of
many tables under one journal: either all staged versions come into force, or, if it breaks off, the next call completes it.
The manifest holds the schema of all versions together, so reading infers nothing and a version may lack columns of others.
Manifests are read and swapped through Spark's file systems, so a catalog can lie wherever its data can.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..streaming import shared_folder

CONTROL, CONTROL_ROWS, ALL, VERSION = "ledger_control", "number bigint, table_name string, version string", "__all", "_version"
BUCKET = "_bucket"


def merged(before: dict | None, after: StructType) -> dict:
    """The fields of both schemas by name, those of the first in front; a field of another type is an error."""
    fields = {f.name: f for f in (StructType.fromJson(before) if before else [])}
    for f in after:
        if f.name in fields and fields[f.name].dataType != f.dataType:
            raise TypeError(f"{f.name} is {f.dataType.simpleString()}, was {fields[f.name].dataType.simpleString()}")
        fields.setdefault(f.name, f)
    return json.loads(StructType(list(fields.values())).json())


class Files:
    """Small text files on any file system that Spark knows."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        at = self.jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.conf), at

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def read(self, path: str) -> str:
        fs, at = self._at(path)
        stream = fs.open(at)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def first_line(self, path: str) -> str:
        """The first line of a text file, without a byte order mark."""
        fs, at = self._at(path)
        reader = self.jvm.java.io.BufferedReader(self.jvm.java.io.InputStreamReader(fs.open(at), "UTF-8"))
        try:
            return (reader.readLine() or "").removeprefix("\ufeff")
        finally:
            reader.close()

    def matches(self, pattern: str) -> bool:
        fs, at = self._at(pattern)
        return bool(fs.globStatus(at))

    def folders(self, path: str) -> dict[str, float]:
        """The folders in a folder, and when each was last changed, in seconds."""
        fs, at = self._at(path)
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in fs.listStatus(at) if s.isDirectory()} if fs.exists(at) else {}

    def swap(self, path: str, text: str) -> None:
        """Puts the whole text in the place of what is there, at once."""
        fresh = f"{path}.{uuid.uuid4().hex}"
        fs, at = self._at(fresh)
        stream = fs.create(at, True)
        stream.write(bytearray(text.encode()))
        stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.conf)
        options = self.jvm.org.apache.hadoop.fs.Options
        rename = getattr(options, "Rename")
        how = self.jvm.java.lang.reflect.Array.newInstance(rename.OVERWRITE.getClass(), 1)
        how[0] = rename.OVERWRITE
        context.rename(at, self.jvm.org.apache.hadoop.fs.Path(path), how)

    def remove(self, path: str) -> None:
        fs, at = self._at(path)
        fs.delete(at, True)


class Catalog:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        """buckets: of tables that are written by a key; as many as the session's shuffle partitions if not given."""
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self._finish()

    def _path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def work(self) -> str:
        """Where checkpoints of landing lie."""
        return self._path("_landing")

    def _manifest(self, table: str) -> dict:
        """versions: folders in force, and the schema of all of them together."""
        return json.loads(self.files.read(self._path(table, "_CURRENT")))

    def _versions(self, table: str) -> list[str]:
        return self._manifest(table)["versions"]

    def exists(self, table: str) -> bool:
        return self.files.exists(self._path(table, "_CURRENT"))

    def tables(self) -> list[str]:
        """All tables in force, those that are only staged left out."""
        return sorted(n for n in self.files.folders(self.root) if not n.startswith(("stg_", "_")) and self.exists(n))

    def read(self, table: str) -> DataFrame:
        if not self.exists(table):
            raise FileNotFoundError(f"no table {table} in {self.root}")
        held = self._manifest(table)
        return self._by_key(table, held) if "by" in held else self._frame(table, self._folders(held), held["schema"])

    def _by_key(self, table: str, held: dict) -> DataFrame:
        """A version in buckets of its key, as Spark knows it: joins and groupings by the key need no exchange. The session's catalog gets
        a table over the files, which owns nothing."""
        at = self._path(table, held["versions"][0])
        name = f"ledger_{hashlib.md5(at.encode(), usedforsecurity=False).hexdigest()}"
        if not self.spark.catalog.tableExists(name):
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(held["schema"]))
            key, n = held["by"]
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {n} BUCKETS LOCATION '{at}'")
        return self.spark.table(name)

    @staticmethod
    def _folders(held: dict) -> list[str]:
        """The folders of the versions in force, or of a merged table those of its buckets."""
        return held["versions"] if "parts" not in held else [f"{v}/{BUCKET}={k}" for k, v in sorted(held["parts"].items())]

    def _frame(self, table: str, versions: Sequence[str], schema: dict) -> DataFrame:
        kind = StructType.fromJson(schema)
        return self.spark.read.schema(kind).parquet(*[self._path(table, v) for v in versions]) if versions else self.spark.createDataFrame([], kind)

    def read_version(self, table: str, version: str) -> DataFrame:
        """What append() added under this version."""
        return self._frame(table, [f"v={version}"], self._manifest(table)["schema"])

    def write(self, df: DataFrame, table: str, mode: str = "overwrite", counts: Mapping[str, Column] | None = None, by: str | None = None) -> dict:
        """Writes a version of its own and puts it in force, in the place of others or beside them. counts: aggregates that are taken
        of the rows on their way, and returned. by: a column by which the rows are laid into buckets, for a table of one version."""
        if by and mode == "append":
            raise ValueError("a table in buckets is written whole, or kept by merge()")
        return self._add(df, table, uuid.uuid4().hex, mode == "append", counts, by)

    def append(self, df: DataFrame, table: str, version: str) -> None:
        """Adds a version of this name, unless it is in force already."""
        if not (self.exists(table) and f"v={version}" in self._versions(table)):
            self._add(df, table, version, True)

    def _add(self, df: DataFrame, table: str, version: str, beside: bool, counts: Mapping[str, Column] | None = None, by: str | None = None) -> dict:
        seen = Observation() if counts else None
        rows = df.observe(seen, *[value.alias(name) for name, value in counts.items()]) if counts else df
        at, layout = self._path(table, f"v={version}"), {}
        if by:
            name, layout = f"ledger_{version}", {"by": [by, self.buckets]}
            rows.repartition(self.buckets, by).write.format("parquet").option("path", at).bucketBy(self.buckets, by).sortBy(by).saveAsTable(name)
            self.spark.sql(f"DROP TABLE {name}")  # the files stay
        else:
            rows.write.mode("overwrite").parquet(at)
        before = self._manifest(table) if beside and self.exists(table) else {"versions": [], "schema": None}
        self.files.swap(self._path(table, "_CURRENT"), json.dumps({"versions": [*before["versions"], f"v={version}"], "schema": merged(before["schema"], df.schema)} | layout))
        return seen.get if counts else {}

    def merge(self, rows: DataFrame, table: str, key: Sequence[str], settle: Callable[[DataFrame, DataFrame], DataFrame], buckets: int = 64, taken: Sequence[str] = ()) -> list[int]:
        """Brings rows into a table that is kept by buckets of its key; the buckets that were rewritten.

        settle(old, new) gives what a bucket holds afterwards; both are of the touched buckets alone, and equal keys are in the same
        bucket. Only these buckets are read and written anew, the others stay the files that they are. One swap of the manifest puts
        them in force together, and notes `taken`, names of what the rows came from, so that a caller that is run again can see it.
        Readers that began before keep their files until vacuum().
        """
        held = self._manifest(table) if self.exists(table) else {"versions": [], "parts": {}, "schema": None, "buckets": buckets, "key": list(key), "taken": []}
        if held.get("key") != list(key):
            raise ValueError(f"{table} is not kept by buckets of {list(key)}")
        number = F.pmod(F.xxhash64(*key), F.lit(held["buckets"])).cast("int")
        fresh = rows.withColumn(BUCKET, number)
        touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())  # at most the number of buckets
        if touched:
            old = [f"{held['parts'][str(k)]}/{BUCKET}={k}" for k in touched if str(k) in held["parts"]]
            schema = held["schema"] or json.loads(rows.schema.json())
            version = f"v={uuid.uuid4().hex}"
            after = settle(self._frame(table, old, schema), rows).withColumn(BUCKET, number)
            after.repartition(len(touched), BUCKET).write.partitionBy(BUCKET).parquet(self._path(table, version))
            written = {n.split("=")[1] for n in self.files.folders(self._path(table, version)) if n.startswith(f"{BUCKET}=")}
            parts = {k: v for k, v in held["parts"].items() if int(k) not in touched} | dict.fromkeys(written, version)
            held |= {"parts": parts, "versions": sorted(set(parts.values())), "schema": merged(held["schema"], after.drop(BUCKET).schema)}
        self.files.swap(self._path(table, "_CURRENT"), json.dumps(held | {"taken": [*held["taken"], *taken]}))
        return touched

    def taken(self, table: str) -> list[str]:
        """What merge() has noted."""
        return self._manifest(table).get("taken", []) if self.exists(table) else []

    def versions(self, table: str) -> list[str]:
        """Names of the versions that append() and write() have added, for read_version()."""
        return [v.removeprefix("v=") for v in self._versions(table)] if self.exists(table) else []

    def compact(self, table: str, files: int | None = None) -> None:
        """A table of many versions becomes one of a single version with the same rows. Readers that began before go on reading the old
        ones, which stay until vacuum()."""
        held = self._manifest(table)
        if len(held["versions"]) < 2 or "parts" in held:
            return
        rows, version = self._frame(table, held["versions"], held["schema"]), f"v={uuid.uuid4().hex}"
        (rows.coalesce(files) if files else rows).write.parquet(self._path(table, version))
        if self._manifest(table) != held:
            raise RuntimeError(f"{table} was written to while it was compacted")
        self.files.swap(self._path(table, "_CURRENT"), json.dumps(held | {"versions": [version]}))

    def vacuum(self, keep_hours: float = 168.0, now: float | None = None) -> list[str]:
        """Deletes versions that no manifest and no journal names and that have not changed for so long; what was deleted. The time has to
        be longer than any reader, and any writer that has not put its version in force yet, may take."""
        self._finish()
        folders = [n for n in self.files.folders(self.root) if not n.startswith("_")]
        named = set()
        for table in folders:
            if self.exists(table):
                named |= {self._real(table, v) for v in self._versions(table)}
        before = (time.time() if now is None else now) - keep_hours * 3600
        gone = []
        for table in folders:
            for version, changed in self.files.folders(self._path(table)).items():
                if version.startswith("v=") and changed < before and f"{table}/{version}" not in named:
                    self.files.remove(self._path(table, version))
                    gone.append(f"{table}/{version}")
        return gone

    @staticmethod
    def _real(table: str, version: str) -> str:
        """A version by the folder that it lies in: published ones stay in that of the staged table."""
        return version.removeprefix("../") if version.startswith("../") else f"{table}/{version}"

    def staged(self, names: Collection[str], prefix: str = "stg_") -> Callable[[str], DataFrame]:
        """A reader that takes the staged version of these tables and the live one of all others, each looked up once."""
        known: dict[str, DataFrame] = {}

        def read(name: str) -> DataFrame:
            if name not in known:
                known[name] = self.read(f"{prefix}{name}" if name in names else name)
            return known[name]

        return read

    def publish(self, tables: Sequence[str], staged: str = "stg_") -> None:
        """The staged versions of these tables come into force together."""
        ready = {t: self._manifest(staged + t) for t in tables}
        moves = {t: m | {"versions": [f"../{staged}{t}/{v}" for v in m["versions"]]} for t, m in ready.items()}
        self.files.swap(self._path("_PUBLISH"), json.dumps(moves))
        self._finish()

    def _finish(self) -> None:
        journal = self._path("_PUBLISH")
        if self.files.exists(journal):
            for table, held in json.loads(self.files.read(journal)).items():
                self.files.swap(self._path(table, "_CURRENT"), json.dumps(held))
            self.files.remove(journal)

    def register(self, names: Sequence[str] | None = None) -> list[str]:
        """Temporary views over the tables in force, so that they can be asked in SQL; their names."""
        names = list(names) if names is not None else self.tables()
        for name in names:
            self.read(name).createOrReplaceTempView(name)
        return names

    def sql(self, text: str) -> DataFrame:
        """A query over the tables in force as they are now."""
        self.register()
        return self.spark.sql(text)


class Metastore:
    """The same over tables of Spark's catalog, for clusters that have one.

    Every table is one table of versions, partitioned by VERSION, under a view. The view reads through the control table: of the
    rows that name its table it takes those with the largest number, and shows their versions. Writing adds a version and then one
    row of control; publishing adds the rows of all tables by one write of one file, so they come into force together or not.
    """

    def __init__(self, spark: SparkSession, database: str = "default", work: str | None = None):
        self.spark, self.database, self._work, self.files = spark, database, work, Files(spark)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        if not spark.catalog.tableExists(f"{database}.{CONTROL}"):
            spark.createDataFrame([], CONTROL_ROWS).write.saveAsTable(self._name(CONTROL), format="parquet")

    def work(self) -> str:
        return f"{self._work or shared_folder(self.spark)}/{self.database}_landing"

    def _name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def _current(self, table: str) -> list[str]:
        rows = self.spark.table(self._name(CONTROL)).where(F.col("table_name") == table)
        last = rows.groupBy("number").agg(F.collect_list("version").alias("v")).orderBy(F.col("number").desc()).first()
        return last["v"] if last else []

    def _enforce(self, versions: Mapping[str, Sequence[str]]) -> None:
        """One file of control rows: it is there whole or not at all."""
        number = self.spark.table(self._name(CONTROL)).agg(F.max("number")).first()[0] or 0
        rows = [(number + 1, t, v) for t, own in versions.items() for v in own]
        self.spark.createDataFrame(rows, CONTROL_ROWS).coalesce(1).write.insertInto(self._name(CONTROL))

    def exists(self, table: str) -> bool:
        return bool(self._current(table))

    def tables(self) -> list[str]:
        names = self.spark.table(self._name(CONTROL)).select("table_name").distinct().collect()
        return sorted(r[0] for r in names if not r[0].startswith("stg_"))

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self._name(table))

    def read_version(self, table: str, version: str) -> DataFrame:
        return self.spark.table(self._name(f"{table}{ALL}")).where(F.col(VERSION) == version).drop(VERSION)

    def write(self, df: DataFrame, table: str, mode: str = "overwrite", counts: Mapping[str, Column] | None = None, by: str | None = None) -> dict:
        """by is left to the tables' owner: their versions are partitions."""
        return self._add(df, table, uuid.uuid4().hex, mode == "append", counts)

    def append(self, df: DataFrame, table: str, version: str) -> None:
        if version not in self._current(table):
            self._add(df, table, version, True)

    def _add(self, df: DataFrame, table: str, version: str, beside: bool, counts: Mapping[str, Column] | None = None) -> dict:
        seen = Observation() if counts else None
        rows = df.observe(seen, *[value.alias(name) for name, value in counts.items()]) if counts else df
        rows, every = rows.withColumn(VERSION, F.lit(version)), f"{table}{ALL}"
        if self.spark.catalog.tableExists(f"{self.database}.{every}"):
            known = self.spark.table(self._name(every)).columns
            new = [f for f in df.schema if f.name not in known]
            if new:
                self.spark.sql(f"ALTER TABLE {self._name(every)} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
                known = self.spark.table(self._name(every)).columns
            rows.select(*[F.col(f"`{c}`") if c in rows.columns else F.lit(None).alias(c) for c in known]).write.insertInto(self._name(every))
            self._view(table)
        else:
            rows.write.partitionBy(VERSION).saveAsTable(self._name(every), format="parquet")
        self._enforce({table: [*(self._current(table) if beside else []), version]})
        self._view(table)
        return seen.get if counts else {}

    def _view(self, table: str, of: str | None = None) -> None:
        every = self._name(f"{of or table}{ALL}")
        columns = ", ".join(f"`{c}`" for c in self.spark.table(every).columns if c != VERSION)
        control = f"(SELECT version FROM (SELECT version, number, max(number) OVER () AS last FROM {self._name(CONTROL)} WHERE table_name = '{table}') WHERE number = last)"
        self.spark.sql(f"CREATE OR REPLACE VIEW {self._name(table)} AS SELECT {columns} FROM {every} WHERE {VERSION} IN {control}")

    staged = Catalog.staged

    def publish(self, tables: Sequence[str], staged: str = "stg_") -> None:
        """The views are made over the tables of versions beforehand; what they show changes with the rows of control."""
        for t in tables:
            self._view(t, staged + t)
        self._enforce({t: self._current(staged + t) for t in tables})

    def register(self, names: Sequence[str] | None = None) -> list[str]:
        self.spark.sql(f"USE `{self.database}`")
        return list(names) if names is not None else self.tables()

    def sql(self, text: str) -> DataFrame:
        self.register()
        return self.spark.sql(text)
