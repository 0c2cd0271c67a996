"""Declared schemas (no inference anywhere)."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DateType, DoubleType,
                               FloatType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Bronze tables (the raw CSV extracts). Ids are numeric in our bindings and
# text in raw extracts (see sources.tables.read_bronze).
BRONZE = {
    "orders": _s(("order_id", LongType()), ("customer_id", LongType()),
                 ("order_status", StringType()),
                 ("order_purchase_timestamp", TimestampNTZType()),
                 ("order_delivered_customer_date", TimestampNTZType()),
                 ("order_estimated_delivery_date", TimestampNTZType())),
    "order_items": _s(("order_id", LongType()), ("order_item_id", IntegerType()),
                      ("product_id", LongType()), ("seller_id", LongType()),
                      ("price", DoubleType()), ("freight_value", DoubleType())),
    "payments": _s(("order_id", LongType()), ("payment_sequential", IntegerType()),
                   ("payment_installments", IntegerType()), ("payment_value", DoubleType())),
    "products": _s(("product_id", LongType()), ("product_category_name", StringType()),
                   ("product_weight_g", IntegerType()), ("product_length_cm", IntegerType()),
                   ("product_height_cm", IntegerType()), ("product_width_cm", IntegerType()),
                   ("product_photos_qty", IntegerType()), ("product_name_lenght", IntegerType()),
                   ("product_description_lenght", IntegerType())),
    "category_translation": _s(("product_category_name", StringType()),
                               ("category_english", StringType())),
    "customers": _s(("customer_id", LongType()), ("customer_state", StringType()),
                    ("customer_city", StringType())),
    "sellers": _s(("seller_id", LongType()), ("seller_state", StringType()),
                  ("seller_city", StringType())),
}

DAILY_SALES = _s(("sale_date", DateType()), ("category_english", StringType()),
                 ("num_orders", LongType()))

# Stream order message (JSON text on the wire; times are 'dd-MM-yyyy HH:mm'
# strings, a missing time is an empty string).
ITEM = _s(("order_item_id", IntegerType()), ("product_id", StringType()),
          ("seller_id", StringType()), ("price", DoubleType()),
          ("freight_value", DoubleType()), ("product_category", StringType()))
ORDER_MESSAGE = _s(
    ("order_id", StringType()), ("customer_id", StringType()),
    ("customer_unique_id", StringType()), ("customer_state", StringType()),
    ("customer_city", StringType()), ("order_status", StringType()),
    ("order_purchase_timestamp", StringType()), ("order_approved_at", StringType()),
    ("order_delivered_carrier_date", StringType()),
    ("order_delivered_customer_date", StringType()),
    ("order_estimated_delivery_date", StringType()),
    ("items", ArrayType(ITEM)),
    ("payment_type", StringType()), ("payment_installments", IntegerType()),
    ("total_payment_value", DoubleType()),
    ("injected_anomaly", _s(("amount_anomaly", StringType()), ("geo_anomaly", StringType()))),
)

# One alert: the record pushed by every rule.
ALERT = _s(("order_id", StringType()), ("type", StringType()), ("score", DoubleType()),
           ("details", StringType()), ("detected_at", TimestampNTZType()))
ALERT_JSON = _s(("order_id", StringType()), ("type", StringType()), ("score", DoubleType()),
                ("details", StringType()), ("detected_at", StringType()))

# Serving tables.
ANOMALIES = _s(("id", LongType()), ("order_id", StringType()), ("type", StringType()),
               ("score", FloatType()), ("details", StringType()),
               ("detected_at", TimestampNTZType()))

# Forecast outputs.
FORECAST = _s(("category_english", StringType()), ("ds", TimestampNTZType()),
              ("yhat", DoubleType()), ("yhat_lower", DoubleType()), ("yhat_upper", DoubleType()))
FORECAST_EVAL = _s(("category_english", StringType()), ("test_points", LongType()),
                   ("mae", DoubleType()), ("rmse", DoubleType()))
