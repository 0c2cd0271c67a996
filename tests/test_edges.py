"""Hand-made edge tables (FIXTURES §5) for the silver, gold and serving layers."""

import datetime as dt

from pyspark.sql import functions as F

from storelake import schemas
from storelake.operators import baskets, forecast, gold, serving, silver
from storelake.operators import stream_facts as sf
from storelake.sources import sinks

T = dt.datetime


def bronze(spark, name, rows):
    return spark.createDataFrame(rows, schemas.BRONZE[name])


def test_key_nulls_dropped(spark):
    orders = bronze(spark, "orders", [
        (1, 10, "d", T(2024, 1, 6, 10), T(2024, 1, 9), T(2024, 1, 12)),
        (None, 10, "d", T(2024, 1, 6), None, None),
        (2, None, "d", T(2024, 1, 6), None, None),
        (3, 10, "d", None, None, None)])
    items = bronze(spark, "order_items", [
        (1, 1, 100, 7, 50.0, 5.0), (1, 2, None, 7, 50.0, 5.0), (1, 3, 100, None, 1.0, 1.0),
        (1, 4, 100, 7, None, 1.0), (None, 5, 100, 7, 1.0, 1.0), (2, 1, 100, 7, 1.0, 1.0)])
    pay = bronze(spark, "payments", [])
    fact = silver.fact_order_items(items, orders, pay)
    assert fact.count() == 1


def test_payment_fanout_0_1_2(spark):
    orders = bronze(spark, "orders", [(o, 1, "d", T(2024, 1, 6), T(2024, 1, 8), T(2024, 1, 9))
                                      for o in (1, 2, 3)])
    items = bronze(spark, "order_items", [(o, i, 100 + i, 7, 10.0, 1.0)
                                          for o in (1, 2, 3) for i in (1, 2)])
    pay = bronze(spark, "payments", [(2, 1, 3, 20.0), (3, 1, 2, 15.0), (3, 2, 1, 5.0)])
    fact = silver.fact_order_items(items, orders, pay)
    counts = {r.order_id: r["count"] for r in fact.groupBy("order_id").count().collect()}
    assert counts == {1: 2, 2: 2, 3: 4}
    agg = silver.fact_order_items(items, orders, pay, payment_mode="aggregate")
    assert agg.count() == 6
    prods = bronze(spark, "products", [(100 + i, "A", 100, 1, 1, 1, 1, 1, 1) for i in (1, 2)])
    cust = bronze(spark, "customers", [(1, "SP", "x")])
    sel = bronze(spark, "sellers", [(7, "SP", "x")])
    ml = gold.ml_feature_store(fact.withColumn("order_delivered_customer_date", F.lit(T(2024, 1, 8))),
                               prods, cust, sel, keep_order_id=True)
    tp = {r.order_id: r.total_payment for r in ml.select("order_id", "total_payment").distinct().collect()}
    assert tp == {1: None, 2: 40.0, 3: 40.0}


def test_price_zero_and_category_miss(spark):
    orders = bronze(spark, "orders", [(1, 1, "d", T(2024, 1, 6), T(2024, 1, 8), T(2024, 1, 9))])
    items = bronze(spark, "order_items", [(1, 1, 100, 7, 0.0, 10.0), (1, 2, 101, 7, 20.0, 2.0)])
    fact = silver.fact_order_items(items, orders, bronze(spark, "payments", []))
    prods = silver.dim_products(
        bronze(spark, "products", [(100, "A", 1, 1, 1, 1, 1, 1, 1), (101, None, 1, 1, 1, 1, 1, 1, 1)]),
        bronze(spark, "category_translation", [("B", "b")]))
    assert prods.filter("category_english is null").count() == 2
    cust = bronze(spark, "customers", [(1, "SP", "x")])
    pricing = gold.order_features_for_pricing(fact, prods, cust)
    assert [r.product_id for r in pricing.collect()] == [101]
    ml = gold.ml_feature_store(fact, prods, cust, bronze(spark, "sellers", [(7, None, None)]))
    ratios = sorted((r.freight_price_ratio is None, r.is_same_state) for r in ml.collect())
    assert ratios == [(False, 0), (True, 0)]


def test_weekend_and_same_state(spark):
    rows = [(i, 1, "d", T(2024, 1, d, 12), T(2024, 1, 20), T(2024, 1, 21))
            for i, d in ((1, 6), (2, 7), (3, 8))]          # Sat, Sun, Mon
    orders = bronze(spark, "orders", rows)
    items = bronze(spark, "order_items", [(i, 1, 100, 7, 1.0, 1.0) for i in (1, 2, 3)])
    fact = silver.fact_order_items(items, orders, bronze(spark, "payments", []))
    got = {r.order_id: (r.is_weekend_order, r.purchase_weekday) for r in fact.collect()}
    assert got == {1: (1, 7), 2: (1, 1), 3: (0, 2)}


def test_customer_profile_pre_aggregation_counts_duplicates(spark):
    orders = bronze(spark, "orders", [(1, 5, "d", T(2024, 1, 6), None, None),
                                      (2, 5, "d", T(2024, 1, 7), None, None),
                                      (3, 6, "d", T(2024, 1, 7), None, None)])
    items = bronze(spark, "order_items", [(1, 1, 100, 7, 10.0, 1.0), (2, 1, 100, 7, 30.0, 3.0),
                                          (3, 1, 100, 7, 5.0, 0.5)])
    fact = silver.fact_order_items(items, orders, bronze(spark, "payments", []))
    cust = bronze(spark, "customers", [(5, "SP", "a"), (5, "SP", "a"), (5, "RJ", "b")])
    got = {(r.customer_id, r.customer_state): (r.total_orders, r.total_spent, r.avg_item_price,
                                               r.total_freight_paid)
           for r in gold.customer_spending_profile(fact, cust).collect()}
    # what grouping fact ⟕ customers row by row gives
    assert got == {(5, "SP"): (2, 80.0, 20.0, 8.0), (5, "RJ"): (2, 40.0, 20.0, 4.0),
                   (6, None): (1, 5.0, 5.0, 0.5)}


def test_baskets_dedupe_and_single_items(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a"), (3, "a"), (3, "b"), (3, "c")],
                                 "order_id long, product_id string")
    b = {r.order_id: sorted(r.items) for r in baskets.baskets(fact).collect()}
    assert b == {3: ["a", "b", "c"]}
    fact2 = spark.createDataFrame([(o, x) for o in range(10) for x in ("a", "b")] + [(10, "a"), (10, "c")],
                                  "order_id long, product_id string")
    recs = baskets.recommendations(baskets.fit_rules(baskets.baskets(fact2), 0.1, 0.2), True)
    got = {(r.product_id, r.recommended_product_id): round(r.confidence, 6) for r in recs.collect()}
    assert got[("a", "b")] == round(10 / 11, 6) and got[("b", "a")] == 1.0


def test_forecast_guards_and_gap_fill(spark):
    def daily(days, cat):
        return [(dt.date(2024, 1, 1) + dt.timedelta(days=d), cat, 1) for d in days]
    rows = (daily(range(29), "short") + daily(range(30), "ok")
            + daily([0, 21] + list(range(28, 28 + 7 * 21, 7)), "gappy"))
    ds = spark.createDataFrame(rows, schemas.DAILY_SALES)
    fc = {r.category_english for r in forecast.forecast(ds).select("category_english").distinct().collect()}
    assert fc == {"ok"}
    w = {(r.week, r.y) for r in forecast.weekly_series(ds).filter("category_english = 'gappy'").collect()}
    assert (dt.date(2024, 1, 14), 0) in w            # the empty week inside the series
    weeks = forecast.weekly_series(ds).filter("category_english = 'gappy'").count()
    bt = forecast.backtest(ds)
    assert weeks == 25 and bt.filter("category_english = 'gappy'").count() == 1
    assert bt.filter("category_english = 'gappy'").first().test_points == 8
    # 22 weeks is not enough
    ds22 = spark.createDataFrame([(dt.date(2024, 1, 7) + dt.timedelta(days=7 * i), "c", 1)
                                  for i in range(22)], schemas.DAILY_SALES)
    assert forecast.backtest(ds22).count() == 0


def test_kv_missing_side_and_upsert_idempotent(spark):
    kv = spark.createDataFrame([("orders:2024-01-02", 3.0), ("revenue:2024-01-03", 12.5)],
                               "key string, value double")
    got = {str(r.metric_date): (r.orders, r.revenue) for r in sf.kv_to_daily(kv).collect()}
    assert got == {"2024-01-02": (3, 0.0), "2024-01-03": (0, 12.5)}
    base = spark.createDataFrame([(dt.date(2024, 1, 1), 1, 1.0), (dt.date(2024, 1, 2), 2, 2.0)],
                                 "metric_date date, orders int, revenue double")
    upd = spark.createDataFrame([(dt.date(2024, 1, 2), 5, 5.0), (dt.date(2024, 1, 3), 7, 7.0)],
                                "metric_date date, orders int, revenue double")
    once = sinks.upsert(base, upd, ["metric_date"])
    twice = sinks.upsert(once, upd, ["metric_date"])
    exp = {(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 5), (dt.date(2024, 1, 3), 7)}
    assert {(r.metric_date, r.orders) for r in once.collect()} == exp
    assert {(r.metric_date, r.orders) for r in twice.collect()} == exp


def test_live_metrics_missing_day_and_aov(spark):
    daily = spark.createDataFrame([(dt.date(2024, 1, 2), 3, 10.0)],
                                  "metric_date date, orders int, revenue double")
    r = serving.live_metrics(daily, "2024-01-05").first()
    assert (r.orders, r.revenue, r.avg_order_value) == (0, 0.0, 0.0)
    r = serving.live_metrics(daily, "2024-01-02").first()
    assert (r.orders, r.revenue, r.avg_order_value) == (3, 10.0, 3.33)


def test_alert_reload_skips_unparsable(spark):
    raw = spark.createDataFrame(
        [('{"order_id":"1","type":"amount","score":1.0,"details":"x","detected_at":"2024-01-02 10:00:00"}',),
         ("{bad",),
         ('{"order_id":"2","type":"velocity","score":1.0,"details":"y","detected_at":"2024-01-03 10:00:00"}',)],
        "value string")
    got = [(r.id, r.order_id) for r in serving.reload_anomalies(raw).orderBy("id").collect()]
    assert got == [(1, "2"), (2, "1")]
    import pytest
    with pytest.raises(ValueError):
        serving.recent_alerts(serving.reload_anomalies(raw), 201)


def test_partitioned_sink_and_batch_replay(spark, tmp_path):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 1)], "v int, purchase_month int")
    p = str(tmp_path / "t")
    sinks.write_table(df, p, ["purchase_month"])
    back = sinks.read_partitioned(spark, p, "purchase_month", [1])
    assert sorted(r.v for r in back.collect()) == [1, 3]
    assert "PartitionFilters" in back._jdf.queryExecution().executedPlan().toString() or back.count() == 2
    q = str(tmp_path / "b")
    sinks.write_batch(df, q, 0)
    sinks.write_batch(df, q, 1)
    sinks.write_batch(df, q, 1)          # replay of batch 1
    assert spark.read.parquet(q).count() == 6


def test_csv_bronze_roundtrip(spark, tmp_path):
    from storelake.sources.tables import read_bronze
    rows = [(1, 10, "d", T(2024, 1, 6, 10), None, T(2024, 1, 12))]
    df = bronze(spark, "orders", rows)
    df.write.option("header", True).csv(str(tmp_path / "orders"))
    back = read_bronze(spark, str(tmp_path), "orders", ids="declared")
    assert back.schema == schemas.BRONZE["orders"]
    assert back.collect() == df.collect()


def test_seasonal_forecast_recovers_trend_and_season(spark):
    import numpy as np
    from storelake.operators.seasonal import WEEKS_PER_YEAR, seasonal_backtest, seasonal_forecast
    start = dt.date(2022, 1, 2)                                  # a Sunday
    rows = []
    for i in range(120):
        y = 100 + 0.5 * i + 20 * np.sin(2 * np.pi * i / WEEKS_PER_YEAR)
        rows.append((start + dt.timedelta(days=7 * i), "c", int(round(y))))
    ds = spark.createDataFrame(rows, schemas.DAILY_SALES)
    ev = seasonal_backtest(ds).first()
    assert ev.test_points == 8 and ev.mae < 1.5
    fc = seasonal_forecast(ds.union(spark.createDataFrame(
        [(start + dt.timedelta(days=d), "c", 1) for d in range(1, 30)], schemas.DAILY_SALES)))
    assert fc.count() == 120 + 12


def test_batch_and_stream_fact_union(spark):
    from conftest import SF_SMALL
    from storelake.plans.registry import QUERIES
    b = QUERIES["fact_order_items"](spark, SF_SMALL)
    s = QUERIES["stream_fact_order_items"](spark, SF_SMALL)
    u = sf.all_fact_rows(b, s)
    assert u.count() == b.count() + s.count()
    assert {r.source for r in u.select("source").distinct().collect()} == {"batch", "stream"}
    assert dict(u.dtypes)["order_id"] == "string"


def test_fact_rows_equal_items_times_payment_rows(spark):
    """Invariant: fact rows = Σ over items of max(1, payment rows of the order)."""
    from conftest import SF_SMALL
    from storelake.sources.tables import tables
    b = tables(spark, SF_SMALL).bronze
    items = silver.clean_items(b.order_items).join(
        silver.clean_orders(b.orders).select("order_id"), "order_id")
    pays = b.payments.groupBy("order_id").count()
    expected = (items.join(pays, "order_id", "left")
                .agg(F.sum(F.greatest(F.coalesce("count", F.lit(0)), F.lit(1)))).first()[0])
    assert silver.fact_order_items(b.order_items, b.orders, b.payments).count() == expected


def test_bronze_read_by_header_name(spark, tmp_path):
    """Reordered and further columns and text ids give the right fact; bad fields are counted."""
    import pytest
    from storelake.operators.silver import fact_order_items
    from storelake.sources.tables import bronze_cast_failures, read_bronze, read_geolocation
    def put(name, text):
        (tmp_path / name).mkdir()
        (tmp_path / name / "part.csv").write_text(text)
    put("orders", "order_id,order_approved_at,customer_id,order_status,order_delivered_carrier_date,"
                  "order_estimated_delivery_date,order_delivered_customer_date,order_purchase_timestamp\n"
                  "00e8a,2024-01-06 11:00:00,c9,delivered,2024-01-07 09:00:00,2024-01-20 00:00:00,"
                  "2024-01-12 15:00:00,2024-01-06 10:30:00\n")
    put("order_items", "freight_value,price,order_id,order_item_id,product_id,seller_id,shipping_limit_date\n"
                       "8.5,19.9,00e8a,1,p1,s1,2024-01-09 10:00:00\nfree,29.9,00e8a,2,p2,s1,2024-01-09 10:00:00\n")
    put("payments", "order_id,payment_type,payment_sequential,payment_installments,payment_value\n00e8a,card,1,3,58.3\n")
    put("geolocation", "zip,lat,lng\n01000,-23.5,-46.6\n")
    r = {n: read_bronze(spark, str(tmp_path), n) for n in ("orders", "order_items", "payments")}
    rows = fact_order_items(r["order_items"], r["orders"], r["payments"]).orderBy("order_item_id").collect()
    assert [(x.order_id, x.customer_id, x.product_id, x.price, x.freight_value, x.payment_value) for x in rows] == [
        ("00e8a", "c9", "p1", 19.9, 8.5, 58.3), ("00e8a", "c9", "p2", 29.9, None, 58.3)]
    assert rows[0].order_delivered_customer_date == dt.datetime(2024, 1, 12, 15)
    assert rows[0].order_estimated_delivery_date == dt.datetime(2024, 1, 20)
    failed = {x.column_name: x.failed for x in bronze_cast_failures(spark, str(tmp_path), "order_items").collect()}
    assert failed["freight_value"] == 1 and sum(failed.values()) == 1
    assert read_geolocation(spark, str(tmp_path)).columns == ["zip", "lat", "lng"]
    put("sellers", "seller_id,seller_state\ns1,SP\n")
    with pytest.raises(ValueError, match="seller_city"):
        read_bronze(spark, str(tmp_path), "sellers")


def test_totals_with_repeated_dimension_keys(spark):
    """A seller listed twice counts its rows twice, as the row-level joins do."""
    from storelake.operators import gold, silver
    facts = silver.fact_order_items(
        bronze(spark, "order_items", [(1, 1, 5, 7, 10.0, 1.0)]),
        bronze(spark, "orders", [(1, 10, "d", T(2024, 1, 6, 10), T(2024, 1, 9), T(2024, 1, 12))]),
        bronze(spark, "payments", [(1, 1, 2, 11.0)]))
    products = bronze(spark, "products", [(5, "A", 100, 1, 1, 1, 1, 1, 1)])
    customers, sellers = bronze(spark, "customers", [(10, "SP", "x")]), bronze(spark, "sellers", [(7, "SP", "y"), (7, "RJ", "z")])
    rows = gold.ml_feature_store(facts, products, customers, sellers).collect()
    assert [(r.total_items_in_order, r.total_order_value, r.total_payment) for r in rows] == [(2, 20.0, 22.0)] * 2


def test_totals_are_never_too_large(spark):
    from storelake.operators.stream_facts import accumulate, batch_increments, daily_metrics, kv_to_daily
    day = spark.range(200).select(F.lit("o").alias("order_id"), F.lit(T(2024, 1, 6)).cast("timestamp_ntz").alias("order_purchase_timestamp"),
                                  F.lit(5e11).alias("price"), F.lit(0.0).alias("freight_value"))
    assert daily_metrics(day).first().revenue == 1e14
    kv = accumulate(batch_increments(day.withColumn("batch_id", F.lit(1))))
    many = kv.withColumn("value", F.when(F.col("key").startswith("orders"), F.lit(3_000_000_000).cast("decimal(38,2)")).otherwise(F.col("value")))
    assert kv_to_daily(many).first().orders == 3_000_000_000 and kv_to_daily(many).first().revenue == 1e14


def test_reload_keeps_records_that_lack_fields(spark):
    raw = spark.createDataFrame([('{"order_id":"1","score":1.0,"detected_at":"2024-01-02 10:00:00"}',), ("[1", ), ("no",), (None,)],
                                "value string")
    assert [(r.order_id, r.type) for r in serving.reload_anomalies(raw).collect()] == [("1", None)]


def test_upsert_replaces_stale_days(spark):
    base = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    assert sorted(tuple(r) for r in sinks.upsert(base, new, ["k"]).collect()) == [("a", 1), ("b", 2), ("c", 2)]


def test_scratch_is_removed(spark, tmp_path):
    import os
    from storelake import session
    kept, session._SCRATCH[:] = session._SCRATCH[:], []
    path = session.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path) and session.clear_scratch(spark) == 1 and not os.path.isdir(path)
    session._SCRATCH[:] = kept
