"""Exact line dedup over a corpus (operator 4), in Spark built-in functions only.

The index is a set of sorted runs of line-key hashes, each with the smallest document holding the
key. Batches of documents arrive in ascending ``doc_id``; a batch reduces its keys to one row each,
anti-joins the runs written so far and writes what is new as a run of level 0. ``FANOUT`` runs of a
level are merged into one of the next, so a batch meets a number of runs that grows with the
logarithm of the batches. A key is in one run only, with its smallest document.

A line is dropped when its key (stripped of white space, A-Z lower-cased) has at least
``MIN_KEY_CHARS`` code points and a smaller document holds it. Keys are told apart by 128 hash bits.

Null texts count as one empty line. A null ``doc_id`` counts as larger than any other. Rows with
equal ``doc_id`` count as one document: neither drops lines of the other, and each row is answered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.llm.common import text_or_empty
from storelake.session import scratch_path

MIN_KEY_CHARS = 10
BATCHES = 3
FANOUT = 2

_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_ID = (1 << 63) - 1
_KEY = ["_h1", "_h2"]


def line_key(line: Column) -> Column:
    """Stripped line with A-Z lower-cased; ``lower`` does the same for ASCII lines and is faster."""
    bare = F.btrim(line, F.lit(_SPACE))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)) \
            .otherwise(F.translate(bare, _UPPER, _LOWER))


def _identity() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("_doc"),
            F.xxhash64(F.col("text")).alias("_row")]


def line_hashes(docs: DataFrame) -> DataFrame:
    """One row per line whose key is long enough: document, row, position, key hash."""
    lines = docs.select(*_identity(), F.posexplode(F.split(text_or_empty(), "\n", -1)).alias("_pos", "_line"))
    keyed = lines.select("_doc", "_row", "_pos", line_key(F.col("_line")).alias("_k"))
    return keyed.filter(F.char_length("_k") >= MIN_KEY_CHARS).select(
        "_doc", "_row", "_pos", F.xxhash64("_k").alias("_h1"), F.xxhash64(F.lit("second"), "_k").alias("_h2"))


class RunIndex:
    """Levelled runs of (key hash, smallest document)."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = [[]]

    def _write(self, keys: DataFrame, level: int) -> None:
        path = scratch_path(self.spark, f"line-run-{level}")
        keys.repartition(*_KEY).sortWithinPartitions(*_KEY).write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def read(self) -> DataFrame | None:
        paths = [p for level in self.levels for p in level]
        return self.spark.read.schema("_h1 long, _h2 long, _owner long").parquet(*paths) if paths else None

    def add(self, batch: DataFrame) -> None:
        """Add the keys of a batch whose documents come after all earlier ones."""
        own = batch.groupBy(*_KEY).agg(F.min("_doc").alias("_owner"))
        seen = self.read()
        self._write(own if seen is None else own.join(seen, _KEY, "left_anti"), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            self._write(self.spark.read.parquet(*merged), level + 1)
            level += 1


def _bounds(docs: DataFrame, batches: int) -> list[int]:
    """Upper document ids of all batches but the last: a few numbers."""
    at = [i / batches for i in range(1, batches)]
    got = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), at, 1000).alias("q")).first()["q"]
    return sorted(set(got or []))


def dropped_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Sorted positions of the lines to drop, one row per document and row that loses any."""
    spark = docs.sparkSession
    cuts = _bounds(docs, batches)
    batch = reduce(lambda c, q: c + (F.col("_doc") > q).cast("int"), cuts, F.lit(0))
    path = scratch_path(spark, "line-hashes")
    line_hashes(docs).withColumn("_batch", batch).write.partitionBy("_batch").parquet(path)
    lines = spark.read.schema("_doc long, _row long, _pos int, _h1 long, _h2 long, _batch int").parquet(path)
    index = RunIndex(spark)
    for b in range(len(cuts) + 1):
        index.add(lines.filter(F.col("_batch") == b))
    late = lines.join(index.read(), _KEY).filter(F.col("_owner") < F.col("_doc"))
    return late.groupBy("_doc", "_row").agg(F.array_sort(F.collect_set("_pos")).alias("_drops"))


def _kept(text: Column, drops: Column) -> Column:
    """The lines between the dropped positions, joined; one-element arrays bind the split once."""
    def cut(s):
        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(s["p"])), lambda i: F.slice(
            s["l"], F.when(i == 0, 1).otherwise(F.get(s["p"], i - 1) + 2),
            F.coalesce(F.get(s["p"], i), F.size(s["l"])) - F.when(i == 0, 0).otherwise(F.get(s["p"], i - 1) + 1)))),
            "\n")
    bound = F.array(F.struct(F.split(text, "\n", -1).alias("l"), drops.alias("p")))
    return F.when(drops.isNull(), text).otherwise(F.transform(bound, cut)[0])


def _joined(docs: DataFrame, batches: int) -> DataFrame:
    """(all: the document's columns in one struct, beside which no name of ours can clash; _drops)."""
    return docs.select(F.struct("*").alias("all"), *_identity()) \
               .join(dropped_lines(docs, batches), ["_doc", "_row"], "left").select("all", "_drops")


def dedup_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``docs`` with repeated lines removed; columns as before (``n_chars`` follows the text)."""
    out = _joined(docs, batches).select("all", _kept(F.col("all.text"), F.col("_drops")).alias("kept"))
    follows = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        follows["n_chars"] = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
    return out.select(*[follows.get(c, F.col("all")[c]).alias(c) for c in docs.columns])


def line_report(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Per document: lines, dropped lines, digest of the kept text."""
    d = _joined(docs.select("doc_id", "text"), batches).select("all.*", "_drops")
    text = text_or_empty()
    return d.select("doc_id", F.size(F.split(text, "\n", -1)).cast("long").alias("n_lines"),
                    F.coalesce(F.size("_drops"), F.lit(0)).cast("long").alias("n_dropped"),
                    F.sha2(_kept(text, F.col("_drops")), 256).alias("kept_sha256"))
