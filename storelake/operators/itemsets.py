"""Frequent itemsets level by level, and the rules of all their antecedents.

FP-growth (:mod:`baskets`) keeps conditional trees in memory and answers at once; this joins tables, level by
level, and so leaves every count where it can be looked at: it is the check of the other, and it goes on
where a tree outgrows its task.

Items are numbered from the rarest to the most frequent. Two frequent sets of k items that differ in their last item only
give a candidate of k + 1; a candidate counts in the baskets that hold its first k items -- known from the level
before -- and its last. So a level joins the places of the level before with the candidates, and no basket's pairs are
enumerated beyond frequent prefixes. Equal baskets are one, with their number; a place carries its basket's items, and a few candidates
are broadcast, so that a level shuffles its partial counts only. The loop has one round per item of the largest frequent set.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storelake.config import FP_MIN_CONFIDENCE, FP_MIN_SUPPORT
from storelake.operators.joins import broadcast_if_small
from storelake.sources.sinks import materialize


def numbered_items(basket_items: DataFrame, min_count: int) -> DataFrame:
    """(item, freq, no): the frequent items of baskets that stand for ``n`` equal ones, numbered from the rarest. At most average
    basket size / support of them."""
    freq = basket_items.groupBy("item").agg(F.sum("n").alias("freq")).filter(F.col("freq") >= min_count)
    return freq.withColumn("no", F.row_number().over(Window.orderBy("freq", "item")))


def numbered_baskets(baskets: DataFrame, items: DataFrame) -> DataFrame:
    """(held, n): the baskets' frequent items by number, ascending, and for how many baskets they stand."""
    pairs = baskets.select("basket", "n", F.explode("items").alias("item")).join(broadcast_if_small(items.select("item", "no")), "item")
    held = pairs.groupBy("basket").agg(F.array_sort(F.collect_list("no")).alias("held"), F.first("n").alias("n"))
    return held.groupBy("held").agg(F.sum("n").alias("n"))


def candidates(frequent: DataFrame) -> DataFrame:
    """(prefix, last, items): sets of one item more, from two frequent ones of equal prefix; a candidate whose other
    subsets aren't all frequent is dropped."""
    k = F.size("items")
    split = frequent.select("items", F.slice("items", F.lit(1), k - 1).alias("head"), F.element_at("items", -1).alias("end"))
    a, b = split.alias("a"), split.alias("b")
    pairs = (a.join(b, (F.col("a.head") == F.col("b.head")) & (F.col("a.end") < F.col("b.end")))
             .select(F.col("a.items").alias("prefix"), F.col("b.end").alias("last")))
    made = pairs.withColumn("items", F.array_append("prefix", F.col("last")))
    # the subsets that lack one of the first items; those that lack one of the last two are the pair itself
    subsets = made.select("items", F.posexplode("prefix").alias("at", "left_out")).filter(F.col("at") < F.size("items") - 2)
    rare = (subsets.withColumn("subset", F.array_remove("items", F.col("left_out")))
            .join(frequent.select(F.col("items").alias("subset")), "subset", "left_anti").select("items").distinct())
    return made.join(rare, "items", "left_anti")


def frequent_itemsets(baskets: DataFrame, min_support: float = FP_MIN_SUPPORT, max_items: int | None = None) -> tuple[DataFrame, DataFrame, int]:
    """(sets, items, baskets): ``sets`` (items by number, freq), ``items`` (item, freq, no), and the number of baskets.

    ``baskets`` holds distinct ``items`` per ``order_id`` (:func:`baskets.baskets`).
    """
    equal = materialize(baskets.groupBy(F.array_sort("items").alias("items")).agg(F.count(F.lit(1)).alias("n"))
                        .withColumn("basket", F.monotonically_increasing_id()), "equal-baskets")
    n = equal.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    min_count = math.ceil(min_support * n)
    items = materialize(numbered_items(equal.select("n", F.explode("items").alias("item")), min_count), "frequent-items")
    places = materialize(numbered_baskets(equal, items), "numbered-baskets").select("held", "n", F.explode(F.transform("held", lambda x: F.array(x))).alias("prefix"))
    level = items.select(F.array("no").alias("items"), "freq")
    found, size = level, 1
    while max_items is None or size < max_items:
        more = materialize(candidates(level), f"candidates-{size + 1}")
        if more.isEmpty():
            break
        # a place carries its basket, so that the last item is looked up where it stands
        places = materialize(places.join(broadcast_if_small(more), "prefix").filter(F.array_contains("held", F.col("last")))
                             .select("held", "n", "items"), f"places-{size + 1}")
        level = places.groupBy("items").agg(F.sum("n").alias("freq")).filter(F.col("freq") >= min_count)
        level = materialize(level, f"sets-{size + 1}")
        if level.isEmpty():
            break
        places = places.join(broadcast_if_small(level.select("items")), "items", "left_semi").withColumnRenamed("items", "prefix")
        found, size = found.unionByName(level), size + 1
    return found, items, n


def rules(baskets: DataFrame, min_support: float = FP_MIN_SUPPORT, min_confidence: float = FP_MIN_CONFIDENCE,
          max_items: int | None = None) -> DataFrame:
    """Rules (antecedent, consequent, confidence, lift, support) with one consequent item, as FP-growth gives them; the
    antecedent's items stand from the rarest on, ties by name."""
    sets, items, n = frequent_itemsets(baskets, min_support, max_items)
    split = (sets.filter(F.size("items") > 1)
             .select(F.explode("items").alias("no"), "items", F.col("freq").cast("double").alias("both"))
             .withColumn("before", F.array_remove("items", F.col("no"))))
    known = sets.select(F.col("items").alias("before"), F.col("freq").cast("double").alias("ahead"))
    out = (split.join(known, "before").withColumn("confidence", F.col("both") / F.col("ahead"))
           .filter(F.col("confidence") >= min_confidence)
           .join(items.select("no", F.col("item").alias("to"), F.col("freq").cast("double").alias("single")), "no"))
    # item names, in the order of their numbers
    names = (out.select("before").distinct().select("before", F.posexplode("before").alias("at", "no"))
             .join(items.select("no", "item"), "no").groupBy("before")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "item"))), lambda x: x["item"]).alias("antecedent")))
    return out.join(names, "before").select(
        "antecedent", F.array("to").alias("consequent"), "confidence",
        (F.col("confidence") / (F.col("single") / F.lit(float(n)))).alias("lift"), (F.col("both") / F.lit(float(n))).alias("support"))
