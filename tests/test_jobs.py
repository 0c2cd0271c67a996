"""Layer jobs end to end on the smallest tables: CSV bronze -> silver -> gold."""

from conftest import SF_SMALL


def test_layers_roundtrip(spark, tmp_path):
    from storelake.plans import jobs
    from storelake.plans.registry import QUERIES
    bronze, silver, gold = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    jobs.export_test_bronze(spark, SF_SMALL, bronze)
    counts = {r.table_name: r.row_count for r in jobs.silver_job(spark, bronze, silver, ids="declared").collect()}
    assert counts["fact_order_items"] == QUERIES["fact_order_items"](spark, SF_SMALL).count()
    jobs.gold_job(spark, silver, gold)
    prof = spark.read.parquet(f"{gold}/customer_spending_profile")
    exp = QUERIES["customer_spending_profile"](spark, SF_SMALL)
    assert prof.exceptAll(exp).count() == 0 and exp.exceptAll(prof).count() == 0
    ml = spark.read.parquet(f"{gold}/ml_feature_store_v2")
    assert ml.count() == QUERIES["ml_feature_store_v2"](spark, SF_SMALL).count()
    june = ml.filter("purchase_month = 6")
    assert "PartitionFilters: [isnotnull(purchase_month" in june._jdf.queryExecution().executedPlan().toString()
    summary, worst = jobs.forecast_job(spark, gold, gold)
    assert summary.count() == 1
    quality, top = jobs.baskets_job(spark, silver, gold, item_col="product_category_name")
    assert quality.first().rules > 0


def test_models_job_is_repeatable(spark, tmp_path):
    from storelake.plans import jobs
    bronze, silver, gold = (str(tmp_path / n) for n in ("bronze", "silver", "gold"))
    jobs.export_test_bronze(spark, SF_SMALL, bronze)
    jobs.silver_job(spark, bronze, silver)          # ids as text
    jobs.gold_job(spark, silver, gold)
    runs = [jobs.models_job(spark, gold, f"{gold}/{k}", str(tmp_path / f"models{k}"), max_iter=1) for k in (1, 2)]
    assert runs[0].keys() == {"shipment_delay", "dynamic_pricing"}
    assert runs[0]["shipment_delay"]["test_rows"] == runs[1]["shipment_delay"]["test_rows"] > 0
    assert runs[0]["shipment_delay"]["mae"] == runs[1]["shipment_delay"]["mae"]
