"""Stream fact rows and running daily totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.functions.dates import parse_wire_ts
from storelake.functions.numeric import money
from storelake.functions.text import key_prefix, key_suffix
from storelake.sources.stream import valid_orders

def stream_fact_rows(parsed: DataFrame) -> DataFrame:
    """One row per item of each valid order (T8); orders with no items give none."""
    return valid_orders(parsed).select(
        "order_id", "customer_id", "customer_unique_id", "order_status",
        parse_wire_ts("order_purchase_timestamp").alias("order_purchase_timestamp"),
        F.explode("items").alias("item"),
    ).select(
        "order_id",
        F.col("item.order_item_id").alias("order_item_id"),
        F.col("item.product_id").alias("product_id"),
        F.col("item.seller_id").alias("seller_id"),
        "customer_id", "customer_unique_id", "order_status", "order_purchase_timestamp",
        F.col("item.price").alias("price"),
        F.col("item.freight_value").alias("freight_value"),
        F.col("item.product_category").alias("product_category_name"),
    )


def _revenue(price="price", freight="freight_value"):
    # a null addend makes the row contribute nothing, as in price + freight
    return F.sum(money(price) + money(freight))


def daily_metrics(fact_rows: DataFrame) -> DataFrame:
    """Per purchase day: item rows (``orders``, the served figure), distinct
    orders and revenue = sum(price + freight), summed exactly in cents and
    returned as double. Counts are long and sums DECIMAL(28,2), so no day is
    too large; a serving table may narrow them.

    Keyed by the order's own date (event time), so replays and late batches
    land on the right day.
    """
    return (fact_rows.groupBy(F.to_date("order_purchase_timestamp").alias("metric_date"))
            .agg(F.count(F.lit(1)).alias("orders"),
                 F.count_distinct("order_id").alias("distinct_orders"),
                 _revenue().cast("decimal(28,2)").cast("double").alias("revenue"))
            .filter(F.col("metric_date").isNotNull()))


def batch_increments(fact_rows: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """The key/value increments each micro-batch adds to the running totals
    (S12): ``orders:<day>`` (+item rows) and ``revenue:<day>`` (+revenue)."""
    per = (fact_rows.groupBy(batch_col, F.to_date("order_purchase_timestamp").alias("d"))
           .agg(F.count(F.lit(1)).cast("decimal(28,2)").alias("orders"),
                _revenue().cast("decimal(28,2)").alias("revenue"))
           .filter(F.col("d").isNotNull()))
    day = F.date_format("d", "yyyy-MM-dd")
    return per.select(batch_col, F.explode(F.array(
        F.struct(F.concat(F.lit("orders:"), day).alias("key"), F.col("orders").alias("value")),
        F.struct(F.concat(F.lit("revenue:"), day).alias("key"),
                 F.coalesce("revenue", F.lit(0)).cast("decimal(28,2)").alias("value")),
    )).alias("kv")).select(batch_col, "kv.*")


def accumulate(increments: DataFrame) -> DataFrame:
    """Running hash after all increments: one ``(key, value)`` per key."""
    return increments.groupBy("key").agg(F.sum("value").alias("value"))


def kv_to_daily(kv: DataFrame) -> DataFrame:
    """Key/value totals -> one row per date (S13); a missing side is 0."""
    wide = (kv.select(key_prefix("key").alias("metric"),
                      F.to_date(key_suffix("key")).alias("metric_date"), "value")
            .filter(F.col("metric_date").isNotNull())
            .groupBy("metric_date").pivot("metric", ["orders", "revenue"]).agg(F.sum("value")))
    return wide.select(
        "metric_date",
        F.coalesce(F.col("orders"), F.lit(0)).cast("long").alias("orders"),
        F.coalesce(F.col("revenue"), F.lit(0)).cast("decimal(28,2)").cast("double").alias("revenue"))


def all_fact_rows(batch_fact: DataFrame, stream_fact: DataFrame) -> DataFrame:
    """Batch and stream order-item rows in one view (the two tables are
    otherwise never merged): ids as strings, columns missing on one side
    null, and a ``source`` column."""
    ids = ["order_id", "product_id", "seller_id", "customer_id"]
    b = batch_fact.withColumns({c: F.col(c).cast("string") for c in ids if c in batch_fact.columns})
    s = stream_fact.withColumns({c: F.col(c).cast("string") for c in ids if c in stream_fact.columns})
    return (b.withColumn("source", F.lit("batch"))
            .unionByName(s.withColumn("source", F.lit("stream")), allowMissingColumns=True))
