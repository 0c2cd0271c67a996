"""Basket rules: baskets, FP-growth, recommendations, quality (A3, P9, P10,
M11, M12, A7, O1).

FP-growth is MLlib's parallel FP-growth: item counting and the conditional
trees are distributed over ``numPartitions`` item groups; no basket pairs are
enumerated by us.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.config import FP_MIN_CONFIDENCE, FP_MIN_SUPPORT
from storelake.sources.sinks import materialize


def baskets(fact: DataFrame, item_col: str = "product_id") -> DataFrame:
    """Distinct items per order, orders with more than one item.

    Rows are first reduced to distinct (order, item) pairs -- a shuffle on
    both columns, so a very large order is spread before it is collected --
    and each basket holds each item once (FP-growth rejects repeats).
    """
    pairs = fact.select("order_id", item_col).filter(F.col(item_col).isNotNull()).distinct()
    return (pairs.groupBy("order_id").agg(F.collect_set(item_col).alias("items"))
            .filter(F.size("items") > 1))


def fit_rules(basket_df: DataFrame, min_support: float = FP_MIN_SUPPORT,
              min_confidence: float = FP_MIN_CONFIDENCE,
              num_partitions: int | None = None) -> DataFrame:
    """Association rules (antecedent, consequent, confidence, lift, support)."""
    fp = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence)
    if num_partitions:
        fp = fp.setNumPartitions(num_partitions)
    return fp.fit(basket_df).associationRules


def mined_rules(basket_df: DataFrame, min_support: float = FP_MIN_SUPPORT,
                min_confidence: float = FP_MIN_CONFIDENCE) -> DataFrame:
    """:func:`fit_rules` with the baskets and the rules written once: a fitted model's rules are lazy, and each use of
    them would build the baskets and the trees again."""
    return materialize(fit_rules(materialize(basket_df, "baskets"), min_support, min_confidence), "basket-rules")


def recommendations(rules: DataFrame, single_antecedent: bool = False) -> DataFrame:
    """Rule -> (product_id, recommended_product_id, confidence, lift, support).

    Only the *first* antecedent and consequent items are kept, as in the
    reproduced job; ``single_antecedent=True`` keeps only rules whose
    antecedent is one item, so the pair is the whole rule.
    """
    r = rules.filter(F.size("antecedent") == 1) if single_antecedent else rules
    return (r.select(F.try_element_at("antecedent", F.lit(1)).alias("product_id"),
                     F.try_element_at("consequent", F.lit(1)).alias("recommended_product_id"),
                     "confidence", "lift", "support")
            .filter(F.col("product_id").isNotNull() & F.col("recommended_product_id").isNotNull()))


def rule_quality(recs: DataFrame) -> DataFrame:
    """Average confidence, lift and support; max confidence and lift.

    Averages are reported to 9 decimals (partial aggregation sums in task
    order, which moves the last bits of a double)."""
    return recs.agg(
        F.round(F.avg("confidence"), 9).alias("avg_confidence"),
        F.round(F.avg("lift"), 9).alias("avg_lift"),
        F.round(F.avg("support"), 9).alias("avg_support"),
        F.max("confidence").alias("max_confidence"),
        F.max("lift").alias("max_lift"),
        F.count(F.lit(1)).alias("rules"))


def top_rules(recs: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` rules with the highest lift (O1), ties by confidence and ids."""
    return recs.orderBy(F.col("lift").desc(), F.col("confidence").desc(),
                        F.col("product_id"), F.col("recommended_product_id")).limit(k)
