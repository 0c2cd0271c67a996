"""Sinks and table maintenance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake.operators.joins import broadcast_if_small


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """Write Parquet (S7), optionally Hive-partitioned."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_partitioned(spark: SparkSession, path: str, column: str, values: list) -> DataFrame:
    """Read a Hive-partitioned table keeping only some partitions (pruned at listing)."""
    return spark.read.parquet(path).filter(F.col(column).isin(values))


def calendar_months(lines: DataFrame) -> DataFrame:
    """The months in which there are orders, with quarter and half year: at most twelve rows."""
    m = F.col("purchase_month")
    return lines.select("purchase_month").distinct().select(
        "purchase_month", F.ceil(m / 3).cast("int").alias("quarter"), F.ceil(m / 6).cast("int").alias("half_year"))


def read_months(spark: SparkSession, path: str, months: DataFrame, column: str = "purchase_month") -> DataFrame:
    """Rows of a table partitioned by month (S8) whose month is in ``months``, with its further columns.

    Which months those are is known only at run time: the join with them is a broadcast of a checked size, whose rows
    also prune the folders that the scan opens (dynamic partition pruning).
    """
    return spark.read.parquet(path).join(broadcast_if_small(months), on=column, how="inner")


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Idempotent per-batch append (S9): the batch's rows land in their own
    ``batch_id=N`` partition and a replay of the same batch overwrites only it."""
    (df.withColumn("batch_id", F.lit(int(batch_id)))
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy("batch_id").parquet(path))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per named table as one DataFrame (S18): one job, no driver loop."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def upsert(base: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Keyed upsert (S14): updated rows replace base rows with the same key,
    new keys are added. Idempotent: applying the same updates twice is a no-op.

    Write the result to a new path (a table version) and swap, never over the
    path being read.
    """
    return updates.unionByName(base.join(updates.select(keys), on=keys, how="left_anti"))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table under the shared checkpoint
    folder and return a reader of it: the hand-off between two layers (a
    gold table the next job reads), and a lineage cut."""
    from storelake.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
