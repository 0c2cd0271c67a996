"""Serving queries over the daily metrics and alert tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from storelake import schemas
from storelake.config import RECENT_ALERTS_KEPT


CORRUPT = "_corrupt_record"


def _check_limit(n: int, lo: int, hi: int) -> int:
    if not lo <= int(n) <= hi:
        raise ValueError(f"limit must be within [{lo}, {hi}], got {n}")
    return int(n)


def sales_by_day(daily: DataFrame) -> DataFrame:
    """L1: every day's orders and revenue, by date."""
    return daily.select("metric_date", "orders", "revenue").orderBy("metric_date")


def live_metrics(daily: DataFrame, as_of) -> DataFrame:
    """L2: one row for ``as_of`` -- orders, revenue and average order value;
    zeros when the day has no data. AOV is revenue / orders rounded half-up to
    cents, computed on integer cents."""
    spark: SparkSession = daily.sparkSession
    day = spark.range(1).select(F.lit(as_of).cast("date").alias("metric_date"))
    row = day.join(daily.select("metric_date", "orders", "revenue"), "metric_date", "left")
    orders = F.coalesce(F.col("orders"), F.lit(0)).cast("long")
    cents = F.round(F.coalesce(F.col("revenue"), F.lit(0.0)) * 100).cast("long")
    aov_cents = F.when(orders > 0, F.floor((2 * cents + orders) / (2 * orders)).cast("long")) \
                 .otherwise(F.lit(0).cast("long"))
    return row.select(
        F.col("metric_date").alias("date"),
        orders.alias("orders"),
        (cents / F.lit(100.0)).alias("revenue"),
        (aov_cents / F.lit(100.0)).alias("avg_order_value"))


def alert_order() -> list[Column]:
    """Newest first; ties broken by order id and type so top-k is stable."""
    return [F.col("detected_at").desc_nulls_last(), F.col("order_id").asc(), F.col("type").asc()]


def alert_summary(alerts: DataFrame) -> DataFrame:
    """L3: alerts per type, most frequent first. Give it all alerts for the whole
    picture (``alert_summary``), or the reloaded list for the served one, which
    holds at most the newest 200 (``served_alert_summary``)."""
    return (alerts.groupBy("type").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col("type")))


def recent_alerts(alerts: DataFrame, limit: int = 20) -> DataFrame:
    """L4: the ``limit`` newest alerts (1..200). A distributed top-k: each task
    keeps ``limit`` rows, the driver merges at most tasks × limit rows."""
    n = _check_limit(limit, 1, RECENT_ALERTS_KEPT)
    return alerts.orderBy(*alert_order()).limit(n)


def alerts_to_json(alerts: DataFrame) -> DataFrame:
    """The alert records as JSON texts, as they sit in the alert list."""
    return alerts.select(F.to_json(F.struct(
        "order_id", "type", "score", "details",
        F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss").alias("detected_at"))).alias("value"))


def reload_anomalies(alert_json: DataFrame) -> DataFrame:
    """Parse the kept alert texts into the serving table, skipping only
    texts that are no JSON object; a record that lacks fields is loaded with
    nulls. ``id`` numbers them newest first (the list head is loaded first). The list holds at most the newest 200 alerts (enforced
    here by a distributed top-k), so numbering them in one ordered window is
    bounded work."""
    record = schemas.StructType([*schemas.ALERT_JSON.fields, schemas.StructField(CORRUPT, schemas.StringType())])
    parsed = (alert_json
              .select(F.from_json("value", record, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("a"))
              .filter(F.col("a").isNotNull() & F.col(f"a.{CORRUPT}").isNull())
              .select("a.*"))
    typed = parsed.select(
        "order_id", "type", F.col("score").cast("float").alias("score"), "details",
        F.try_to_timestamp("detected_at", F.lit("yyyy-MM-dd HH:mm:ss"))
         .cast("timestamp_ntz").alias("detected_at"))
    kept = typed.orderBy(*alert_order()).limit(RECENT_ALERTS_KEPT)
    w = Window.orderBy(*alert_order())
    return kept.withColumn("id", F.row_number().over(w).cast("long")).select(
        [f.name for f in schemas.ANOMALIES.fields])


def alert_history(anomalies: DataFrame, limit: int = 50) -> DataFrame:
    """``ORDER BY detected_at DESC NULLS LAST LIMIT n`` (1..500)."""
    n = _check_limit(limit, 1, 500)
    return anomalies.orderBy(*alert_order()).limit(n)


def kept_alerts(alerts: DataFrame) -> DataFrame:
    """The alert list as the stream keeps it: the newest 200."""
    return recent_alerts(alerts, RECENT_ALERTS_KEPT)
