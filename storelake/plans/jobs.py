"""Layer jobs: bronze CSV -> silver -> gold -> models / baskets / forecasts.

Each job reads its inputs from storage, builds the lazy plans of the
operators and writes at the edge. Nothing is counted between stages; the
row-count report is one job over the written tables.

    python -m storelake.plans.jobs silver   --bronze DIR --out SILVER
    python -m storelake.plans.jobs gold     --silver SILVER --out GOLD
    python -m storelake.plans.jobs models   --gold GOLD --out GOLD --models MODELS
    python -m storelake.plans.jobs baskets  --silver SILVER --out GOLD
    python -m storelake.plans.jobs forecast --gold GOLD --out GOLD
    python -m storelake.plans.jobs stream   --messages DIR --out STREAM
    python -m storelake.plans.jobs serving  --stream STREAM --out SERVING
    python -m storelake.plans.jobs testdata --tables /root/testdata/sf0.01 --out BRONZE
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from storelake.operators import baskets, forecast, gold, models, silver
from storelake.sources.sinks import row_counts, write_table
from storelake.sources.tables import Tables, read_bronze, read_daily_sales, read_geolocation

BRONZE_TABLES = ("orders", "order_items", "payments", "products", "category_translation",
                 "customers", "sellers")


def export_test_bronze(spark: SparkSession, tables_dir: str, out: str) -> None:
    """Write the bindings of the driver's test tables as headered bronze CSVs."""
    b = Tables(spark, tables_dir).bronze
    for name in BRONZE_TABLES:
        getattr(b, name).write.mode("overwrite").option("header", True).csv(f"{out}/{name}")


def silver_job(spark: SparkSession, bronze_root: str, out: str, payment_mode: str = "fanout",
               ids: str = "string", geolocation: bool = False):
    """``ids``: see :func:`read_bronze`. ``geolocation`` also passes that extract through."""
    r = {n: read_bronze(spark, bronze_root, n, ids) for n in BRONZE_TABLES}
    fact = silver.fact_order_items(r["order_items"], r["orders"], r["payments"], payment_mode)
    outputs = {
        "fact_order_items": fact,
        "dim_customers": silver.dim_customers(r["customers"]),
        "dim_products": silver.dim_products(r["products"], r["category_translation"]),
        "dim_sellers": silver.dim_sellers(r["sellers"]),
    }
    for name, df in outputs.items():
        write_table(df, f"{out}/{name}")
    if geolocation:
        write_table(read_geolocation(spark, bronze_root), f"{out}/geolocation")
    return row_counts({n: spark.read.parquet(f"{out}/{n}") for n in outputs})


def gold_job(spark: SparkSession, silver_root: str, out: str):
    s = {n: spark.read.parquet(f"{silver_root}/{n}")
         for n in ("fact_order_items", "dim_customers", "dim_products", "dim_sellers")}
    fact = s["fact_order_items"]
    write_table(gold.order_features_for_pricing(fact, s["dim_products"], s["dim_customers"]),
                f"{out}/order_features_for_pricing")
    write_table(gold.ml_feature_store(fact, s["dim_products"], s["dim_customers"], s["dim_sellers"],
                                      keep_order_id=True),
                f"{out}/ml_feature_store_v2", partition_by=["purchase_month"])
    write_table(gold.customer_spending_profile(fact, s["dim_customers"]),
                f"{out}/customer_spending_profile")
    write_table(gold.daily_sales_by_category(fact, s["dim_products"]),
                f"{out}/daily_sales_by_category")


def models_job(spark: SparkSession, gold_root: str, out: str, model_root: str,
               max_iter: int | None = None):
    kw = {"max_iter": max_iter} if max_iter else {}
    results = {}
    for spec, table, name, shape in (
            (models.DELAY, "ml_feature_store_v2", "shipment_delay", models.delay_predictions),
            (models.PRICE, "order_features_for_pricing", "dynamic_pricing",
             models.pricing_recommendations)):
        data = models.spread(models.model_input(spark.read.parquet(f"{gold_root}/{table}"), spec))
        train, test = models.split(data, key="order_id")
        model = models.fit(train, spec, **kw)
        pred = model.transform(test).cache()
        try:
            results[name] = models.regression_metrics(pred, spec.label).first().asDict()
            out_name = "shipment_delay_predictions" if name == "shipment_delay" else "pricing_recommendations"
            write_table(shape(pred), f"{out}/{out_name}")
        finally:
            pred.unpersist()
        models.save_model(model, f"{model_root}/{name}_gbt_model")
    return results


def baskets_job(spark: SparkSession, silver_root: str, out: str, item_col: str = "product_id"):
    fact = spark.read.parquet(f"{silver_root}/fact_order_items")
    if item_col != "product_id":
        fact = fact.join(spark.read.parquet(f"{silver_root}/dim_products")
                         .select("product_id", item_col), "product_id", "left")
    recs = baskets.recommendations(baskets.fit_rules(baskets.baskets(fact, item_col)))
    write_table(recs, f"{out}/product_recommendations")
    rec = spark.read.parquet(f"{out}/product_recommendations")
    return baskets.rule_quality(rec), baskets.top_rules(rec)


def forecast_job(spark: SparkSession, gold_root: str, out: str):
    daily = read_daily_sales(spark, f"{gold_root}/daily_sales_by_category")
    write_table(forecast.forecast(daily), f"{out}/forecast_weekly_demand")
    write_table(forecast.backtest(daily), f"{out}/forecast_evaluation_metrics")
    ev = spark.read.parquet(f"{out}/forecast_evaluation_metrics")
    return forecast.evaluation_summary(ev), forecast.worst_categories(ev)


def stream_job(spark: SparkSession, source: str, out: str, trigger: str | None = "availableNow"):
    """The alert and fact streams over a folder of order messages, under ``out``."""
    from storelake.streaming.jobs import read_text_stream, start_alerts, start_facts
    runs = [start_alerts(read_text_stream(spark, source), f"{out}/alerts", f"{out}/_alerts", trigger),
            start_facts(read_text_stream(spark, source), f"{out}/facts", f"{out}/increments", f"{out}/_facts", trigger)]
    for q in runs:
        q.awaitTermination()


def serving_job(spark: SparkSession, stream_root: str, out: str):
    """Load the serving tables from what the streams wrote; returns the load summary."""
    from storelake.operators import serving
    from storelake.operators.stream_facts import accumulate, kv_to_daily
    alerts = spark.read.parquet(f"{stream_root}/alerts")
    write_table(kv_to_daily(accumulate(spark.read.parquet(f"{stream_root}/increments"))), f"{out}/daily_metrics")
    write_table(serving.reload_anomalies(serving.alerts_to_json(serving.kept_alerts(alerts))), f"{out}/anomalies")
    return row_counts({n: spark.read.parquet(f"{out}/{n}") for n in ("daily_metrics", "anomalies")})


def main(argv=None) -> None:
    from storelake.session import clear_scratch, get_session
    ap = argparse.ArgumentParser(prog="storelake.plans.jobs")
    ap.add_argument("job", choices=["testdata", "silver", "gold", "models", "baskets", "forecast", "stream", "serving"])
    ap.add_argument("--messages"), ap.add_argument("--stream"), ap.add_argument("--trigger", default="availableNow")
    ap.add_argument("--tables"), ap.add_argument("--bronze"), ap.add_argument("--silver")
    ap.add_argument("--gold"), ap.add_argument("--out", required=True), ap.add_argument("--models")
    ap.add_argument("--item", default="product_id")
    ap.add_argument("--master"), ap.add_argument("--partitions", type=int)
    ap.add_argument("--geolocation", action="store_true")
    ap.add_argument("--ids", choices=["string", "declared"], default="string")
    a = ap.parse_args(argv)
    spark = get_session(a.master, a.partitions, app_name=f"storelake-{a.job}")
    if a.job == "testdata":
        export_test_bronze(spark, a.tables, a.out)
    elif a.job == "silver":
        silver_job(spark, a.bronze, a.out, ids=a.ids, geolocation=a.geolocation).show()
    elif a.job == "gold":
        gold_job(spark, a.silver, a.out)
    elif a.job == "models":
        for k, v in models_job(spark, a.gold, a.out, a.models or f"{a.out}/models").items():
            print(k, v)
    elif a.job == "baskets":
        q, top = baskets_job(spark, a.silver, a.out, a.item)
        q.show(truncate=False), top.show(truncate=False)
    elif a.job == "forecast":
        s, w = forecast_job(spark, a.gold, a.out)
        s.show(truncate=False), w.show(truncate=False)
    elif a.job == "stream":
        stream_job(spark, a.messages, a.out, a.trigger)
    elif a.job == "serving":
        serving_job(spark, a.stream, a.out).show()
    clear_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
