"""A set of tables in parts, with versions of all of them together, for loads that touch a little of a lot.

A table's rows are laid out by ``part``, a text that its key decides: a day, or a bucket of the key's hash. A version is a list of parts and the
folders in which they lie. ``Load.merge`` reads and writes the parts that its batch touches and takes the others over by name, so a load costs what
it touches and not what there is. ``Load.commit`` writes the list of all tables and names it in the log; until then, and if the load stops, readers
see the last version whole. The list, a row a part, is all that the driver holds. Loads of one store follow one another; there is one writer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetspark.operators import facts

PART = "_part"
_LIST = "name string, part string, folder string, columns string"


def bucket(*key: str, of: int = 64) -> Column:
    """A part by the hash of columns, for keys that no day follows from."""
    return F.concat(F.lit("b"), F.pmod(F.xxhash64(*key), F.lit(of)))


class Store:
    """Tables under a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[tuple[int, str]]:
        """Of each version the folder of its list, from the oldest on: one row a load."""
        try:
            rows = self.spark.read.schema("version long, list string").json(f"{self.path}/log").orderBy("version").collect()
        except Exception as missing:  # nothing was loaded yet
            if "PATH_NOT_FOUND" in str(missing):
                return []
            raise
        return [(r["version"], r["list"]) for r in rows]

    def begin(self, only: list[str] | None = None, version: int | None = None) -> Load:
        """A load on top of the last version, or of an older one; with ``only`` it starts from these tables and none else, for a rebuild."""
        versions = self.versions()
        last = versions[-1] if version is None and versions else next((v for v in versions if v[0] == version), None)
        rows = self.spark.read.schema(_LIST).parquet(last[1]).collect() if last else []
        tables: dict[str, dict[str, tuple[str, str]]] = {}
        for r in rows:
            tables.setdefault(r["name"], {})[r["part"]] = r["folder"], r["columns"]
        return Load(self, versions[-1][0] + 1 if versions else 0, {k: v for k, v in tables.items() if only is None or k in only})

    def read(self, name: str) -> DataFrame | None:
        return self.begin().read(name)


class Load:
    """Changes of tables that take effect together. ``tables`` has the folder and columns of each part by table."""

    def __init__(self, store: Store, version: int, tables: dict[str, dict[str, tuple[str, str]]]):
        self.store, self.spark, self.version, self.tables = store, store.spark, version, tables
        self.changed = False

    def read(self, name: str, parts: list[str] | None = None) -> DataFrame | None:
        """A table, or some parts of it; None if it isn't there or has none of them."""
        there = self.tables.get(name, {})
        found = [there[p] for p in (there if parts is None else parts) if p in there]
        return self.spark.read.schema(found[0][1]).parquet(*[folder for folder, _ in found]) if found else None

    def _write(self, name: str, df: DataFrame, part: Column, kept: dict[str, tuple[str, str]]) -> None:
        folder = f"{self.store.path}/{name}/v-{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        rows = df.withColumn(PART, F.coalesce(part.cast("string"), F.lit("none"))).hint("rebalance", PART)  # a large part is split among tasks
        rows.write.partitionBy(PART).parquet(folder)
        files = self.spark.read.schema(columns).parquet(folder).inputFiles()
        parts = {f.rpartition("/")[0].rpartition(f"{PART}=")[2] for f in files}
        self.tables[name] = kept | {p: (f"{folder}/{PART}={p}", columns) for p in sorted(parts)}
        self.changed = True

    def put(self, name: str, df: DataFrame, part: Column | None = None) -> None:
        """A table anew."""
        self._write(name, df, F.lit("all") if part is None else part, {})

    def put_parts(self, name: str, df: DataFrame, part: Column, parts: list[str]) -> None:
        """Some parts anew; ``df`` has their rows and no others."""
        self._write(name, df, part, {k: v for k, v in self.tables.get(name, {}).items() if k not in parts})

    def merge(self, name: str, batch: DataFrame, key: list[str], update: list[str], part: Column, order: list[str] | None = None) -> list[str]:
        """``facts.upsert`` of a batch into the parts it touches, whose names come back. Columns are the batch's, less ``order``."""
        columns = [c for c in batch.columns if c not in (order or [])]
        touched = [r["p"] for r in batch.select(F.coalesce(part.cast("string"), F.lit("none")).alias("p")).distinct().collect()]  # a row a part
        if not touched:
            return []
        old = self.read(name, touched)
        old = batch.select(columns).where("false") if old is None else old
        self.put_parts(name, facts.upsert(old, batch, key, update, order).select(columns), part, touched)
        return touched

    def commit(self) -> bool:
        """Make all changes the current version; without a change there is none."""
        if not self.changed:
            return False
        rows = [(name, part, *where) for name, parts in self.tables.items() for part, where in parts.items()]
        listed = f"{self.store.path}/lists/v-{uuid.uuid4().hex}"
        self.spark.createDataFrame(rows, _LIST).coalesce(1).write.parquet(listed)
        self.spark.createDataFrame([(self.version, listed)], "version long, list string").coalesce(1).write.mode("append").json(f"{self.store.path}/log")
        self.changed = False
        return True
