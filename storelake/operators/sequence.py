"""Ordered per-key scans that stay balanced when one key is huge.

``lag`` or a running aggregate over ``Window.partitionBy(key)`` sends every row
of a key to one task; if one customer holds a third of the rows, that task
holds a third of the data. Here the rows are instead range-partitioned on
``(key, order...)`` -- the range bounds split a hot key's ordered run into
several contiguous *chunks* -- and each scan is done in two levels:

1. inside each ``(key, chunk)`` with an ordinary window (bounded by the chunk);
2. across chunks through a per-``(key, chunk)`` summary (at most one row per
   chunk for a key, so a hot key contributes at most ``num_chunks`` rows),
   whose carried values are joined back on ``(key, chunk)``.

Keys are wrapped in a struct so a null key is one group, like any other.
The chunked rows are written once as a Parquet table in the shared
folder named by ``spark.checkpoint.dir``: range bounds come from sampling,
and two executions of the same range exchange -- e.g. two branches of one
plan that Catalyst pruned differently -- may draw different bounds.
Materialising the chunk ids once makes every later step agree on them, and
cuts the lineage so a lost executor recomputes from that table, not from the
sources (one write, unlike ``Dataset.checkpoint``, which runs the reduce side
twice).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelake.session import scratch_path

K, CHUNK, RN = "_k", "_chunk", "_rn"


def _cols(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


CHUNK_BYTES = 256 << 20


def _chunks_for(df: DataFrame) -> int:
    """Chunks of about ``CHUNK_BYTES`` by the planner's size estimate, and at least
    one per core of the cluster, so that a hot key is split over many cores and
    no chunk outgrows a task."""
    sc = getattr(df.sparkSession, "_sc", None)
    if sc is None:      # Spark Connect has no view of the plan's size
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(sc.defaultParallelism, min(size, 1 << 50) // CHUNK_BYTES)


def chunk_rows(df: DataFrame, key: list[str], order: list[str],
               num_chunks: int | None = None) -> DataFrame:
    """Tag rows with ``_k`` (the key struct) and ``_chunk`` (its range chunk)."""
    spark = df.sparkSession
    path = scratch_path(spark, "chunks")
    keyed = df.withColumn(K, F.struct(*key))
    if num_chunks is None:
        num_chunks = _chunks_for(keyed)
    (keyed.repartitionByRange(num_chunks, F.col(K), *_cols(order))
          .withColumn(CHUNK, F.spark_partition_id()).write.parquet(path))
    return spark.read.parquet(path)


def _local(order) -> Window:
    return Window.partitionBy(K, CHUNK).orderBy(*_cols(order))


def _across() -> Window:
    return Window.partitionBy(K).orderBy(CHUNK)


def add_previous(c: DataFrame, order: list[str], cols: list[str],
                 prefix: str = "prev_") -> DataFrame:
    """Add ``prev_<col>`` (value on the key's previous row) and ``_rn`` (1-based
    position within the key) to a chunked frame."""
    wl = _local(order)
    local = c.withColumn("_rn_l", F.row_number().over(wl))
    local = local.withColumns({f"_pl_{x}": F.lag(x).over(wl) for x in cols})
    summary = (local.groupBy(K, CHUNK)
               .agg(F.count(F.lit(1)).alias("_cnt"),
                    F.max_by(F.struct(*cols), F.struct(*_cols(order))).alias("_last"))
               .withColumn("_offset", F.coalesce(
                   F.sum("_cnt").over(_across().rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
               .withColumn("_carry", F.lag("_last").over(_across()))
               .select(K, CHUNK, "_offset", "_carry"))
    first = F.col("_rn_l") == 1
    out = local.join(summary, on=[K, CHUNK], how="left").withColumns(
        {f"{prefix}{x}": F.when(first, F.col("_carry")[x]).otherwise(F.col(f"_pl_{x}"))
         for x in cols})
    out = out.withColumn(RN, F.col("_rn_l") + F.col("_offset"))
    return out.drop("_rn_l", "_offset", "_carry", *[f"_pl_{x}" for x in cols])


def add_running_max(c: DataFrame, order: list[str], col: Column | str, out: str) -> DataFrame:
    """Add ``out`` = running max of ``col`` (nulls ignored) up to and including
    the current row of the key, on a chunked frame."""
    v = F.col(col) if isinstance(col, str) else col
    tmp = c.withColumn("_v", v)
    local = tmp.withColumn(
        "_m_l", F.max("_v").over(_local(order).rowsBetween(Window.unboundedPreceding, 0)))
    summary = (local.groupBy(K, CHUNK).agg(F.max("_v").alias("_cm"))
               .withColumn("_carry_m", F.max("_cm").over(
                   _across().rowsBetween(Window.unboundedPreceding, -1)))
               .select(K, CHUNK, "_carry_m"))
    return (local.join(summary, on=[K, CHUNK], how="left")
            .withColumn(out, F.greatest("_m_l", "_carry_m"))
            .drop("_v", "_m_l", "_carry_m"))


def add_running_sums(c: DataFrame, order: list[str], cols: list[str]) -> DataFrame:
    """Add ``sum_<col>`` = running sum of ``col`` up to and including the current row of the key, on a chunked frame."""
    upto = _local(order).rowsBetween(Window.unboundedPreceding, 0)
    before = _across().rowsBetween(Window.unboundedPreceding, -1)
    summary = (c.groupBy(K, CHUNK).agg(*[F.sum(x).alias(f"_t_{x}") for x in cols])
               .select(K, CHUNK, *[F.sum(f"_t_{x}").over(before).alias(f"_b_{x}") for x in cols]))
    local = c.withColumns({f"_l_{x}": F.sum(x).over(upto) for x in cols})
    return (local.join(summary, on=[K, CHUNK], how="left")
            .withColumns({f"sum_{x}": F.coalesce(F.col(f"_b_{x}") + F.col(f"_l_{x}"), f"_l_{x}", f"_b_{x}") for x in cols})
            .drop(*[f"_{p}_{x}" for x in cols for p in "lb"]))


def first_per_key(df: DataFrame, key: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """The first row of each key by ``order`` (an aggregate: partial per task,
    so a hot key is reduced before it is shuffled)."""
    return (df.groupBy(F.struct(*key).alias(K))
            .agg(F.min_by(F.struct(*cols), F.struct(*_cols(order))).alias("_first"))
            .select(*[F.col(K)[k].alias(k) for k in key], "_first.*"))


def add_previous_and_sessions(c: DataFrame, order: list[str], cols: list[str], ts: str,
                              gap_seconds: int, prefix: str = "prev_") -> DataFrame:
    """One round (local window, chunk summary, across-chunk window, join) that
    adds ``prev_<col>``, ``_rn`` and ``session_count`` -- the 1-based position
    of the row in its key's session, a session restarting when the time since
    the key's previous row reaches ``gap_seconds``.

    The only cross-chunk dependency of the sessions is whether a chunk's first
    row starts one; that is decided in the summary from the previous chunk's
    last time, so no second round over the rows is needed.
    """
    from storelake.functions.dates import seconds_between
    wl = _local(order)
    local = (c.withColumn("_rn_l", F.row_number().over(wl))
              .withColumns({f"_pl_{x}": F.lag(x).over(wl) for x in cols if x != ts})
              .withColumn("_pl_ts", F.lag(ts).over(wl)))
    # rows after the first that start a session, judged inside the chunk
    local_start = F.when((F.col("_rn_l") > 1)
                         & (seconds_between(ts, "_pl_ts") >= gap_seconds), F.col("_rn_l"))
    local = local.withColumn("_ls", local_start).withColumn(
        "_ls_run", F.max("_ls").over(wl.rowsBetween(Window.unboundedPreceding, 0)))
    carry_cols = list(dict.fromkeys(cols + [ts]))
    summary = (local.groupBy(K, CHUNK)
               .agg(F.count(F.lit(1)).alias("_cnt"),
                    F.min_by(F.col(ts), F.struct(*_cols(order))).alias("_first_ts"),
                    F.max_by(F.struct(*carry_cols), F.struct(*_cols(order))).alias("_last"),
                    F.max("_ls").alias("_chunk_ls")))
    before = _across().rowsBetween(Window.unboundedPreceding, -1)
    summary = (summary
               .withColumn("_offset", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
               .withColumn("_carry", F.lag("_last").over(_across()))
               .withColumn("_first_starts",
                           F.col("_carry").isNull()
                           | (seconds_between(F.col("_first_ts"), F.col("_carry")[ts]) >= gap_seconds))
               .withColumn("_chunk_start_abs", F.greatest(
                   F.col("_chunk_ls") + F.col("_offset"),
                   F.when(F.col("_first_starts"), F.col("_offset") + 1)))
               .withColumn("_carry_start", F.max("_chunk_start_abs").over(before))
               .select(K, CHUNK, "_offset", "_carry", "_first_starts", "_carry_start"))
    first = F.col("_rn_l") == 1
    out = local.join(summary, on=[K, CHUNK], how="left")
    prev = {f"{prefix}{x}": F.when(first, F.col("_carry")[x]).otherwise(F.col(f"_pl_{x}"))
            for x in cols if x != ts}
    prev[f"{prefix}{ts}"] = F.when(first, F.col("_carry")[ts]).otherwise(F.col("_pl_ts"))
    out = out.withColumns(prev).withColumn(RN, F.col("_rn_l") + F.col("_offset"))
    start = F.greatest(F.col("_ls_run") + F.col("_offset"),
                       F.when(F.col("_first_starts"), F.col("_offset") + 1),
                       F.col("_carry_start"))
    out = out.withColumn("session_count", F.col(RN) - start + 1)
    return out.drop("_rn_l", "_offset", "_carry", "_first_starts", "_carry_start", "_ls", "_ls_run",
                    "_pl_ts", *[f"_pl_{x}" for x in cols if x != ts])
