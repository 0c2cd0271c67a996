"""Connected components of an edge table, in Spark joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``edges`` (a, b).

    Each round hooks every node to its smallest neighbour if that is smaller, follows the hooks
    twice, and contracts the edges. The number of rounds grows with the logarithm of the longest chain; a star whose
    hub is its largest node takes one round more. Every round is written to the shared folder, and the tables of the
    round before are removed.
    """
    spark = edges.sparkSession
    rest = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                       .filter("a < b").distinct(), "edges")
    labels = was = None
    while not rest.isEmpty():
        both = rest.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
            rest.select(F.col("b").alias("node"), F.col("a").alias("other")))
        hook = both.groupBy("node").agg(F.least("node", F.min("other")).alias("to"))
        hook = stored(_followed(_followed(hook)), "hooks")
        labels = hook.select("node", F.col("to").alias("component")) if labels is None else _relabelled(labels, hook)
        before, labels = was, stored(labels, "labels")
        ends = [hook.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in ("a", "b")]
        moved = rest.join(ends[0], "a").join(ends[1], "b")
        left = stored(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
                           .filter("a < b").distinct(), "edges")
        discard(rest, hook, before)
        rest, was = left, labels
    discard(rest)
    return labels if labels is not None else spark.createDataFrame([], "node long, component long")


def _followed(hook: DataFrame) -> DataFrame:
    """One step further: the hook of the node that a node hooks to."""
    onward = hook.select(F.col("node").alias("to"), F.col("to").alias("onward"))
    return hook.join(onward, "to").select("node", F.col("onward").alias("to"))


def _relabelled(labels: DataFrame, hook: DataFrame) -> DataFrame:
    onward = hook.select(F.col("node").alias("component"), F.col("to").alias("onward"))
    return labels.join(onward, "component", "left") \
                 .select("node", F.coalesce("onward", "component").alias("component"))
