"""Helpers shared by the training-data operators: table access, scratch tables, word splitting."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.session import checkpoint_root, scratch_path

BATCH_CHARS = 2_000_000     # texts handled together in a task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back: a lineage cut
    that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*frames: DataFrame | None) -> None:
    """Remove tables that :func:`stored` wrote, when everything made of them is itself written."""
    for df in frames:
        if df is not None:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return checkpoint_root(spark)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def broadcast_within(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast a frame only after counting that it is within ``max_rows``; else leave the join
    to the planner."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def task_schema(df: DataFrame, **extra: str) -> str:
    """DDL of ``df`` plus extra columns, for ``mapInArrow`` results."""
    cols = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    return ", ".join(cols + [f"`{k}` {v}" for k, v in extra.items()])


@functools.cache
def _word_table() -> bytes:
    """ASCII letters to lower case, other ASCII but digits to a blank; other bytes stay."""
    t = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        t[b] = b + 32 if "A" <= c <= "Z" else b if c.isalnum() else 32
    return bytes(t)


def words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 bytes: runs of digits, letters (A-Z lower-cased) and non-ASCII."""
    return (text or "").encode("utf-8", "replace").translate(_word_table()).split()


def grouped(texts: list[str | None], most: int = BATCH_CHARS) -> Iterator[list[str]]:
    """Consecutive texts in lists of about ``most`` characters."""
    part, size = [], 0
    for t in texts:
        part.append(t or "")
        size += len(part[-1])
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def give_back() -> None:
    """Return a worker's free memory to the system: workers wait for further tasks, and other stages need the room."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):       # not every C library has it
        pass


def tidy(run):
    """A function of ``mapInArrow`` that gives its memory back when its task is done."""
    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped
