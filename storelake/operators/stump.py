"""The best first split of a regression tree, exactly, from prefix sums (M5, M6): the check of the boosted trees.

MLlib looks at a bounded number of candidate thresholds per feature. Here every value is one: rows are reduced to
(feature, value, rows, label sum), sorted by value in chunks that split a feature over tasks
(:mod:`storelake.operators.sequence`), and running sums give what lies left of each value. A split's gain is the
drop in squared error, ``sl²/nl + sr²/nr - s²/n``; the largest wins, ties go to the earlier feature and the
smaller threshold. A threshold lies half way between two neighbouring values.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.operators import sequence
from storelake.sources.sinks import materialize

# the integer features of the delay model: few enough values for MLlib to try each
FEW_VALUES = ("estimated_delivery_days", "purchase_month", "purchase_day", "purchase_weekday", "purchase_hour", "is_weekend_order",
              "product_weight_g", "product_length_cm", "product_width_cm", "product_height_cm", "product_photos_qty",
              "is_same_state", "total_items_in_order", "max_installments")
MAX_BINS = 512


def split_gains(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """(feature, at, threshold, left_rows, right_rows, left_mean, right_mean, gain) of every possible split, over the rows
    that have the label and all features."""
    y = F.col(label).cast("decimal(38,9)")
    whole = df.select(F.floor(y).cast("long").alias("y"), ((y - F.floor(y)) * 10**9).cast("long").alias("y9"),
                      *[F.col(f).cast("double").alias(f"v{k}") for k, f in enumerate(features)]).na.drop()
    values = whole.unpivot(["y", "y9"], [f"v{k}" for k in range(len(features))], "at", "value")
    # billionths apart: two sums of longs, which cost a fraction of one of wide decimals
    sums = values.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"), F.sum("y9").alias("y9"))
    sums = sums.select(F.substr("at", F.lit(2)).cast("int").alias("at"), "value", "n",
                       (F.col("y").cast("decimal(20,0)") + F.col("y9").cast("decimal(20,0)") * F.lit(Decimal("1e-9"))).cast("decimal(38,9)").alias("s"))
    sums = materialize(sums, "split-sums")      # the number of chunks goes by its size, which the planner can't tell before
    order = ["value"]
    chunks = sequence.chunk_rows(sums, ["at"], order)
    seen = sequence.add_running_sums(sequence.add_previous(chunks, order, ["value"]), order, ["n", "s"])
    total = chunks.groupBy("at").agg(F.sum("n").alias("all_n"), F.sum("s").alias("all_s"))
    feature = F.get(F.array(*map(F.lit, features)), F.col("at"))
    left_n, left_s = F.col("sum_n") - F.col("n"), F.col("sum_s") - F.col("s")
    d = (seen.filter(F.col(sequence.RN) > 1).join(total, "at")
         .select(feature.alias("feature"), "at", ((F.col("prev_value") + F.col("value")) / 2).alias("threshold"), left_n.alias("left_rows"),
                 (F.col("all_n") - left_n).alias("right_rows"), left_s.cast("double").alias("sl"),
                 (F.col("all_s") - left_s).cast("double").alias("sr"), F.col("all_s").cast("double").alias("s"), "all_n"))
    return d.select("feature", "at", "threshold", "left_rows", "right_rows", (F.col("sl") / F.col("left_rows")).alias("left_mean"),
                    (F.col("sr") / F.col("right_rows")).alias("right_mean"),
                    (F.col("sl") * F.col("sl") / F.col("left_rows") + F.col("sr") * F.col("sr") / F.col("right_rows")
                     - F.col("s") * F.col("s") / F.col("all_n")).alias("gain"))


def best_split(df: DataFrame, label: str, features: list[str]) -> DataFrame:
    """The split of the largest gain, one row (none if no feature has two values)."""
    return split_gains(df, label, features).orderBy(F.desc(F.round("gain", 6)), "at", "threshold").limit(1).drop("at")


def first_split(model: PipelineModel, features: list[str], spark) -> DataFrame:
    """The root split of a fitted boosted pipeline's first tree: feature, threshold, and what both sides predict."""
    root = model.stages[-1].trees[0]._java_obj.rootNode()
    row = (features[root.split().featureIndex()], float(root.split().threshold()),
           float(root.leftChild().prediction()), float(root.rightChild().prediction()))
    return spark.createDataFrame([row], "feature string, threshold double, left_mean double, right_mean double")
