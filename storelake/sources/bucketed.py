"""Bucketed tables (S7, J2, J3): written once by key, joined and grouped by that key without an exchange.

A bucketed table is dealt to ``buckets`` files by the hash of its key, each sorted by it. Tables of equal key and
number of buckets join bucket by bucket where they lie; a window or an aggregate by the key needs no exchange
either. The rows are dealt before they are written, so that each bucket is one file, not one file per
task that held some of its rows.

The layout is known to the session's catalog only. The folder is an ordinary Parquet table to other readers;
:func:`open_bucketed` makes a later session see the buckets again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET_BYTES = 16 << 20     # compressed; sorted in a task, the rows made of them take some 40 times that


def _input_bytes(df: DataFrame) -> int:
    """Bytes of the tables that a frame reads (the planner's guess for a join multiplies its sides)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(min(int(leaves.apply(k).stats().sizeInBytes()), 1 << 50) for k in range(leaves.size()))


def buckets_for(*frames: DataFrame) -> int:
    """Buckets of about ``BUCKET_BYTES`` of what the largest of the frames reads, and at least one per core of the
    cluster. Tables that are to join need the same number."""
    sc = frames[0].sparkSession.sparkContext
    most = int(frames[0].sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    return min(most, max(sc.defaultParallelism, max(map(_input_bytes, frames)) // BUCKET_BYTES))


def _name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, name: str = "bucketed") -> DataFrame:
    """Write ``df`` bucketed and sorted by ``key`` and return a reader that knows it. A very large key stays one
    bucket: bucket by keys that are small, as orders are."""
    table = _name(name)
    (df.repartition(buckets, F.col(key)).write.mode("overwrite").format("parquet").option("path", path)
       .bucketBy(buckets, key).sortBy(key).saveAsTable(table))
    return df.sparkSession.table(table)


def open_bucketed(spark: SparkSession, path: str, key: str, buckets: int, name: str = "bucketed") -> DataFrame:
    """A reader of a folder that :func:`write_bucketed` wrote, with its buckets."""
    table, columns = _name(name), spark.read.parquet(path).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
    spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)
