"""Silver layer: cleaned dimensions and the order-item fact table.

Payments are **not** made unique per order before the join, so an order with
``k`` payment rows yields ``k`` fact rows per item (``payments="fanout"``, the
reproduced behaviour). ``payments="aggregate"`` first reduces payments to one
row per order (installments max, value sum, sequence count).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.functions.dates import calendar_columns
from storelake.operators.joins import broadcast_if_small, grows
from storelake.sources.bucketed import buckets_for, write_bucketed

ORDER_KEYS = ["order_id", "customer_id", "order_purchase_timestamp"]
ITEM_KEYS = ["order_id", "product_id", "seller_id", "price"]

FACT_COLUMNS = [
    "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value",
    "customer_id", "order_status", "order_purchase_timestamp",
    "order_delivered_customer_date", "order_estimated_delivery_date",
    "payment_sequential", "payment_installments", "payment_value",
    "order_purchase_date", "purchase_year", "purchase_month", "purchase_day",
    "purchase_weekday", "purchase_hour", "is_weekend_order",
]


def clean_orders(orders: DataFrame) -> DataFrame:
    return orders.na.drop(subset=ORDER_KEYS)


def clean_items(items: DataFrame) -> DataFrame:
    return items.na.drop(subset=ITEM_KEYS)


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.na.drop(subset=["customer_id"])


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.na.drop(subset=["seller_id"])


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with their English category name (left join: misses stay, name null).

    The translation table has a row per category; it is broadcast once its size
    is checked, because a shuffle on a few categories would put the products of
    each in one task.
    """
    return products.na.drop(subset=["product_id"]).join(
        broadcast_if_small(translation), on="product_category_name", how="left")


def payments_per_order(payments: DataFrame) -> DataFrame:
    """One payment row per order (the ``aggregate`` mode)."""
    return payments.groupBy("order_id").agg(
        F.count(F.lit(1)).cast("int").alias("payment_sequential"),
        F.max("payment_installments").alias("payment_installments"),
        F.sum("payment_value").alias("payment_value"))


def order_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """items ⋈ orders on ``order_id`` plus purchase calendar columns: the fact
    without payments, for what doesn't need them."""
    joined = clean_items(items).join(clean_orders(orders), on="order_id", how="inner")
    return joined.withColumns(calendar_columns("order_purchase_timestamp"))


def fact_order_items(items: DataFrame, orders: DataFrame, payments: DataFrame,
                     payment_mode: str = "fanout") -> DataFrame:
    """items ⋈ orders ⟕ payments on ``order_id`` plus purchase calendar columns.

    All three inputs are hash-partitioned on ``order_id`` once; the second join
    reuses the first join's partitioning, so the fact costs one exchange per
    input and no re-shuffle of the joined rows.
    """
    return order_lines(items, orders).join(_payments(payments, payment_mode), on="order_id", how="left").select(FACT_COLUMNS)


def _payments(payments: DataFrame, payment_mode: str) -> DataFrame:
    if payment_mode == "aggregate":
        return payments_per_order(payments)
    if payment_mode != "fanout":
        raise ValueError(f"payment_mode must be 'fanout' or 'aggregate', not {payment_mode!r}")
    return payments


def fact_with_dimensions(items: DataFrame, orders: DataFrame, payments: DataFrame, products: DataFrame, customers: DataFrame,
                         sellers: DataFrame | None = None, payment_mode: str = "fanout") -> DataFrame:
    """The rows of fact ⟕ products ⟕ customers ⟕ sellers, each dimension joined to the table that holds its key.

    Items meet products and sellers, and orders meet customers, before items and orders meet: rows that payments
    multiply are never shuffled again, and they leave the join dealt by ``order_id``, as totals by order need
    them. Tables that grow with the orders are sort-merge joined: a broadcast would go whole through the driver.
    """
    lines = clean_items(items).join(grows(products), on="product_id", how="left")
    if sellers is not None:
        lines = lines.join(sellers, on="seller_id", how="left")
    bought = clean_orders(orders).join(grows(customers), on="customer_id", how="left")
    joined = lines.join(grows(bought), on="order_id", how="inner").join(grows(_payments(payments, payment_mode)), on="order_id", how="left")
    return joined.withColumns(calendar_columns("order_purchase_timestamp"))


def lines_with_products(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """The rows of :func:`order_lines` ⟕ products without the calendar, dealt by ``order_id``."""
    lines = clean_items(items).join(grows(products), on="product_id", how="left")
    return lines.join(grows(clean_orders(orders)), on="order_id", how="inner")


def bucketed_inputs(items: DataFrame, orders: DataFrame, payments: DataFrame, folder: str,
                    buckets: int | None = None) -> dict[str, DataFrame]:
    """The fact's three inputs, written bucketed by ``order_id``: one exchange each, once. The fact, and every later
    join or total by order over them, then needs none."""
    frames = {"order_items": clean_items(items), "orders": clean_orders(orders), "payments": payments}
    buckets = buckets or buckets_for(*frames.values())
    return {n: write_bucketed(df, f"{folder}/{n}", "order_id", buckets, n) for n, df in frames.items()}


@dataclass
class Silver:
    """The silver star schema built from the bronze bindings."""

    bronze: object
    payment_mode: str
    fact: DataFrame
    lines: DataFrame
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame

    @classmethod
    def from_bronze(cls, bronze, payment_mode: str = "fanout") -> "Silver":
        return cls(
            bronze=bronze,
            payment_mode=payment_mode,
            fact=fact_order_items(bronze.order_items, bronze.orders, bronze.payments, payment_mode),
            lines=order_lines(bronze.order_items, bronze.orders),
            customers=dim_customers(bronze.customers),
            products=dim_products(bronze.products, bronze.category_translation),
            sellers=dim_sellers(bronze.sellers),
        )

    def rows_with(self, products: list[str], customers: list[str], sellers: list[str] | None = None) -> DataFrame:
        """The fact with columns of its dimensions (:func:`fact_with_dimensions`)."""
        b = self.bronze
        return fact_with_dimensions(b.order_items, b.orders, b.payments, self.products.select(products), self.customers.select(customers),
                                    self.sellers.select(sellers) if sellers else None, self.payment_mode)
