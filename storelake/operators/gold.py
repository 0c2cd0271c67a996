"""Gold feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storelake.functions.dates import days_between
from storelake.functions.numeric import money, ratio


def customer_spending_profile(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, spend, average item price and freight per (customer, state, city).

    Equivalent to grouping ``fact ⟕ customers`` by the three columns, but the
    fact is reduced to one row per customer *before* the join: the join then
    moves customer-sized data instead of fact-sized data, and the partial
    aggregation makes a customer holding a large share of rows harmless. A
    customer listed ``m`` times with the same state and city is counted ``m``
    times, exactly as the row-level join would.
    """
    per_customer = fact.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum(money("price")).alias("_spent"),
        F.count("price").alias("_n_prices"),
        F.sum(money("freight_value")).alias("_freight"))
    # one shuffle of the dimension on customer_id serves both the copy count
    # (its grouping contains customer_id) and the join
    dims = (customers.select("customer_id", "customer_state", "customer_city")
            .repartition("customer_id")
            .groupBy("customer_id", "customer_state", "customer_city")
            .agg(F.count(F.lit(1)).alias("_copies")))
    m = F.coalesce(F.col("_copies"), F.lit(1))
    return per_customer.join(dims, on="customer_id", how="left").select(
        "customer_id", "customer_state", "customer_city", "total_orders",
        (F.col("_spent") * m).cast("double").alias("total_spent"),
        (F.col("_spent").cast("double") / F.col("_n_prices")).alias("avg_item_price"),
        (F.col("_freight") * m).cast("double").alias("total_freight_paid"))


# fixed values: the dimension columns that the pricing table reads, and its own
PRICING_DIMENSIONS = {
    "products": ["product_id", "product_weight_g", "product_length_cm", "product_width_cm", "product_height_cm"],
    "customers": ["customer_id", "customer_state"],
}
PRICING_COLUMNS = [
    "order_id", "product_id", "price", "freight_value", "freight_ratio",
    "delivery_days", "estimated_vs_actual_delivery",
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    "customer_state", "order_hour", "order_dayofweek",
]


def order_features_for_pricing(fact: DataFrame, products: DataFrame,
                               customers: DataFrame) -> DataFrame:
    """Delivered item rows with a positive price, with size and delivery features.

    ``estimated_vs_actual_delivery`` is estimated − delivered (positive = early).
    Both filters reach the scans or the join below them (Catalyst pushdown).
    """
    return pricing_features(fact
                            .join(products.select(PRICING_DIMENSIONS["products"]), on="product_id", how="left")
                            .join(customers.select(PRICING_DIMENSIONS["customers"]), on="customer_id", how="left"))


def pricing_features(base: DataFrame) -> DataFrame:
    """The pricing table from fact rows that hold the columns of ``PRICING_DIMENSIONS``."""
    return (base.withColumns({
                "delivery_days": days_between("order_delivered_customer_date", "order_purchase_date"),
                "estimated_vs_actual_delivery": days_between("order_estimated_delivery_date",
                                                             "order_delivered_customer_date"),
                "freight_ratio": ratio("freight_value", "price", 4),
            })
            .withColumnsRenamed({"purchase_hour": "order_hour",
                                 "purchase_weekday": "order_dayofweek"})
            .filter(F.col("delivery_days").isNotNull() & (F.col("price") > 0))
            .select(PRICING_COLUMNS))


# fixed values: the dimension columns that the model feature table reads, and its own
ML_DIMENSIONS = {
    "products": ["product_id", "product_weight_g", "product_length_cm", "product_width_cm", "product_height_cm",
                 "product_photos_qty", "product_name_lenght", "product_description_lenght"],
    "customers": ["customer_id", "customer_state", "customer_city"],
    "sellers": ["seller_id", "seller_state", "seller_city"],
}
ML_COLUMNS = [
    "delay_vs_estimate_days", "estimated_delivery_days",
    "purchase_month", "purchase_day", "purchase_weekday", "purchase_hour", "is_weekend_order",
    "product_weight_g", "product_length_cm", "product_width_cm", "product_height_cm", "product_volume",
    "product_photos_qty", "product_name_lenght", "product_description_lenght",
    "customer_state", "customer_city", "seller_state", "seller_city", "is_same_state",
    "price_per_item", "freight_per_item", "total_items_in_order",
    "max_installments", "total_payment", "total_order_value",
    "freight_price_ratio", "weight_per_item",
]


def order_totals() -> dict[str, Column]:
    """Per-order item count, value, max installments and payment sum (A2) as
    window columns. An order is a small key, so a window over it is safe."""
    w = Window.partitionBy("order_id")
    return {
        "total_items_in_order": F.count("product_id").over(w),
        "total_order_value": F.sum(money("price")).over(w).cast("double"),
        "max_installments": F.max("payment_installments").over(w),
        "total_payment": F.sum(money("payment_value")).over(w).cast("double"),
    }


def ml_feature_store(fact: DataFrame, products: DataFrame, customers: DataFrame,
                     sellers: DataFrame, keep_order_id: bool = False) -> DataFrame:
    """Shipment-delay features, one row per fact row with a delay and a weight.

    ``delay_vs_estimate_days`` is estimated − delivered, so a late delivery is
    negative. ``keep_order_id`` carries the order id so predictions can be
    joined back.

    The per-order totals are defined over the fact joined to the three
    dimensions (a key listed twice counts twice), so they are a window over
    those joined rows: one pass over the items, and no exchange for it when the
    dimensions are broadcast. The filter comes after the totals.
    """
    return ml_features(fact
                       .join(products.select(ML_DIMENSIONS["products"]), on="product_id", how="left")
                       .join(customers.select(ML_DIMENSIONS["customers"]), on="customer_id", how="left")
                       .join(sellers.select(ML_DIMENSIONS["sellers"]), on="seller_id", how="left"), keep_order_id)


def ml_features(base: DataFrame, keep_order_id: bool = False) -> DataFrame:
    """The model feature table from fact rows that hold the columns of ``ML_DIMENSIONS``."""
    feats = base.withColumns(order_totals()).withColumns({
        "delay_vs_estimate_days": days_between("order_estimated_delivery_date",
                                               "order_delivered_customer_date"),
        "estimated_delivery_days": days_between("order_estimated_delivery_date",
                                                "order_purchase_date"),
        "is_same_state": F.when(F.col("customer_state") == F.col("seller_state"), 1).otherwise(0),
        "price_per_item": F.col("price"),
        "freight_per_item": F.col("freight_value"),
        "freight_price_ratio": ratio("freight_value", "price", 4),
        "weight_per_item": F.col("product_weight_g"),
        "product_volume": F.col("product_length_cm") * F.col("product_width_cm")
                          * F.col("product_height_cm"),
    })
    cols = (["order_id"] if keep_order_id else []) + ML_COLUMNS
    return (feats
            .filter(F.col("delay_vs_estimate_days").isNotNull()
                    & F.col("product_weight_g").isNotNull())
            .select(cols))


def feature_totals_by_month(features: DataFrame) -> DataFrame:
    """Per month of the feature store: rows, value and late deliveries."""
    return features.groupBy("purchase_month", "quarter").agg(
        F.count(F.lit(1)).alias("feature_rows"), F.sum(money("price_per_item")).cast("double").alias("value"),
        F.count_if(F.col("delay_vs_estimate_days") < 0).alias("late_rows"))


def daily_sales_by_category(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct orders per purchase day and English category (A4), from the order
    lines (the fact works too; payments don't matter here).

    The source project reads this table but has no producer for it; we read
    ``num_orders`` as the number of distinct orders with an item in the
    category that day. Items whose category has no English name are kept
    under a null category.
    """
    return (lines.select("order_purchase_date", "order_id", "product_id")
            .join(products.select("product_id", "category_english"), on="product_id", how="left")
            .groupBy(F.col("order_purchase_date").alias("sale_date"), "category_english")
            .agg(F.count_distinct("order_id").alias("num_orders")))
