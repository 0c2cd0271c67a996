"""Sets of tables that advance together, with an atomic commit.

A version writes each of its tables to a fresh folder, ``<root>/<table>/version=N``. It becomes
visible by one rename of a small record to ``<root>/_commits/N.json``; readers follow the newest record. A
writer that dies between writing and committing leaves folders that no record names: nobody reads them, and
the next attempt at the same version writes over them. A record says, for every table, in which version's
folder it lies, so a table that didn't change is not written again.

One writer at a time, as a streaming query with its checkpoint is. Readers need no lock: the folders of a
committed version don't change until :meth:`Versions.vacuum` removes versions that are no longer kept.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.sources.sinks import upsert


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # the commit records; the driver handles one small file per version

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        fs, folder = self._fs(), self._path("_commits")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def current(self) -> int:
        """The newest committed version; -1 before the first."""
        return max(self.versions(), default=-1)

    def record(self, version: int | None = None) -> dict:
        """The commit record of a version (the newest by default): ``tables`` and what the writer noted."""
        version = self.current() if version is None else version
        if version < 0:
            return {"tables": {}}
        stream = self._fs().open(self._path("_commits", f"{version:012d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    # writing

    def folder(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/version={version}"

    def stage(self, version: int, table: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        """Write one table of a version that isn't committed yet, and return a reader of what was written."""
        path = self.folder(table, version)
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self, version: int, tables: list[str], **notes) -> None:
        """Make a version visible. ``tables`` are those it has written; the others stay where they are."""
        before = self.record()
        if version <= self.current():
            raise ValueError(f"version {version} is not newer than {self.current()}")
        record = {**before, **notes, "tables": before["tables"] | {t: version for t in tables}}
        fs, final = self._fs(), self._path("_commits", f"{version:012d}.json")
        draft = self._path("_commits", f".{version:012d}-{uuid.uuid4().hex[:8]}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(record).encode()))
        out.close()
        if not fs.rename(draft, final):
            raise RuntimeError(f"version {version} could not be committed")

    # reading

    def read(self, table: str, schema: str) -> DataFrame:
        """A table as of the newest commit; empty before its first."""
        at = self.record()["tables"].get(table)
        return self._empty(schema) if at is None else self.spark.read.schema(schema).parquet(self.folder(table, at))

    def read_all(self, table: str, schema: str, since: int = 0) -> DataFrame:
        """All committed rows of a table to which every version adds, with their ``version``. The folders of versions
        without a record are pruned; two listings tell which those are, however many versions there are."""
        known, fs = set(self.versions()), self._fs()
        written = [s.getPath().getName() for s in fs.listStatus(self._path(table))] if fs.exists(self._path(table)) else []
        written = {int(n.split("=")[1]) for n in written if n.startswith("version=")}
        there = sorted(v for v in written & known if v >= since)
        if not there:
            return self._empty(f"{schema}, version int")
        version = F.col("version")
        lost = sorted(v for v in written - known if there[0] <= v <= there[-1])
        rows = self.spark.read.schema(f"{schema}, version int").parquet(f"{self.root}/{table}")
        return rows.filter(version.between(there[0], there[-1]) & (~version.isin(lost) if lost else F.lit(True)))

    def _empty(self, schema: str) -> DataFrame:
        return self.spark.createDataFrame([], schema)

    def vacuum(self, tables: list[str], keep: int = 2) -> int:
        """Remove the folders of ``tables`` that none of the ``keep`` newest commits names, and those of versions
        older than them that were never committed. Returns how many."""
        committed, fs, gone = self.versions(), self._fs(), 0
        if not committed:
            return 0
        newest = committed[-keep:]
        named = [self.record(v)["tables"] for v in newest]
        for table in tables:
            if not fs.exists(self._path(table)):
                continue
            for s in fs.listStatus(self._path(table)):
                name = s.getPath().getName()
                v = int(name.split("=")[1]) if name.startswith("version=") else None
                if v is not None and v <= newest[-1] and all(r.get(table) != v for r in named):
                    fs.delete(s.getPath(), True)
                    gone += 1
        return gone


def upsert_version(versions: Versions, table: str, updates: DataFrame, keys: list[str], version: int | None = None) -> int:
    """Keyed upsert of a versioned table (S14): the rows of ``updates`` replace those of equal keys. A reader sees the
    table before or after it, never in between; applying a committed version again changes nothing."""
    now = versions.current()
    version = now + 1 if version is None else version
    if version <= now:
        return now
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in updates.schema.fields)
    versions.stage(version, table, upsert(versions.read(table, schema), updates, keys))
    versions.commit(version, [table])
    return version


def newest_rows(deltas: DataFrame, key: str) -> DataFrame:
    """Of the rows that versions have added for a key, the newest: (key, the row's other columns)."""
    others = [c for c in deltas.columns if c not in (key, "version")]
    return (deltas.groupBy(key).agg(F.max_by(F.struct(*others), "version").alias("_row"))
            .select(key, "_row.*"))
