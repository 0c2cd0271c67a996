"""The registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Each query reads the whole test tables of ``sf_dir`` through the bindings and
returns a lazy DataFrame. ``storelake.plans.oracle_sql.SQL`` holds the DuckDB
twin of every query that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from storelake.operators import gold, silver
from storelake.sources.tables import tables as Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _silver(spark: SparkSession, sf_dir: str, payment_mode: str = "fanout") -> silver.Silver:
    return silver.Silver.from_bronze(Tables(spark, sf_dir).bronze, payment_mode)


@register("fact_order_items")
def q_fact(spark, sf_dir):
    return _silver(spark, sf_dir).fact


@register("dim_products")
def q_dim_products(spark, sf_dir):
    return _silver(spark, sf_dir).products


@register("customer_spending_profile")
def q_profile(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return gold.customer_spending_profile(s.fact, s.customers)


@register("order_features_for_pricing")
def q_pricing(spark, sf_dir):
    return gold.pricing_features(_silver(spark, sf_dir).rows_with(**gold.PRICING_DIMENSIONS))


@register("ml_feature_store_v2")
def q_ml_features(spark, sf_dir):
    return gold.ml_features(_silver(spark, sf_dir).rows_with(**gold.ML_DIMENSIONS))


@register("fact_order_items_bucketed")
def q_fact_bucketed(spark, sf_dir):
    """The fact from inputs bucketed by order: joined where they lie."""
    from storelake.session import scratch_path
    b = Tables(spark, sf_dir).bronze
    t = silver.bucketed_inputs(b.order_items, b.orders, b.payments, scratch_path(spark, "silver"))
    return silver.fact_order_items(t["order_items"], t["orders"], t["payments"])


@register("ml_feature_store_bucketed")
def q_ml_features_bucketed(spark, sf_dir):
    """The feature store over a fact bucketed by order: its order totals need no exchange."""
    from storelake.session import scratch_path
    from storelake.sources.bucketed import buckets_for, write_bucketed
    s = _silver(spark, sf_dir)
    fact = write_bucketed(s.fact, scratch_path(spark, "fact"), "order_id", buckets_for(s.fact), "fact")
    return gold.ml_feature_store(fact, s.products, s.customers, s.sellers)


@register("order_features_by_quarter")
def q_features_by_quarter(spark, sf_dir):
    """Rows and value of the stored feature table in the months of one quarter: the calendar's filter decides at run
    time which month folders are read."""
    from storelake.session import scratch_path
    from storelake.sources.sinks import calendar_months, read_months, write_table
    path = scratch_path(spark, "ml-features")
    write_table(q_ml_features(spark, sf_dir), path, ["purchase_month"])
    s = _silver(spark, sf_dir)
    return gold.feature_totals_by_month(read_months(spark, path, calendar_months(s.lines).filter("quarter = 4")))


@register("daily_sales_by_category")
def q_daily_sales(spark, sf_dir):
    s = _silver(spark, sf_dir)
    return gold.daily_sales_by_category(s.lines, s.products)


@register("layer_row_counts")
def q_row_counts(spark, sf_dir):
    from storelake.sources.sinks import row_counts
    b = Tables(spark, sf_dir).bronze
    s = silver.Silver.from_bronze(b)
    return row_counts({
        "bronze.orders": b.orders, "bronze.order_items": b.order_items,
        "bronze.payments": b.payments, "bronze.products": b.products,
        "bronze.customers": b.customers, "bronze.sellers": b.sellers,
        "silver.fact_order_items": s.fact, "silver.dim_customers": s.customers,
        "silver.dim_products": s.products, "silver.dim_sellers": s.sellers,
    })


def _orders(spark, sf_dir, customer_buckets=None):
    from storelake.operators.rules import prepare_orders
    return prepare_orders(Tables(spark, sf_dir).bronze.order_stream(customer_buckets))


def _rule_query(fn_name, customer_buckets=None):
    def q(spark, sf_dir):
        from storelake.operators import rules
        return getattr(rules, fn_name)(_orders(spark, sf_dir, customer_buckets))
    return q


for _n, _f in [("alerts_amount", "amount_alerts"), ("alerts_off_hours", "off_hours_alerts"),
               ("alerts_freight_mismatch", "freight_alerts"),
               ("alerts_first_order_high_value", "first_order_alerts"),
               ("alerts_geo_velocity", "geo_alerts"), ("alerts_velocity", "velocity_alerts"),
               ("order_alerts", "all_alerts")]:
    register(_n)(_rule_query(_f))
register("alerts_velocity_10_customers")(_rule_query("velocity_alerts", customer_buckets=10))


@register("parsed_order_stream")
def q_parsed(spark, sf_dir):
    from storelake.sources.stream import parse_orders
    from pyspark.sql import functions as F
    p = parse_orders(Tables(spark, sf_dir).bronze.order_messages())
    it = F.get(F.col("items"), 0)
    return p.select("order_id", "customer_id", "customer_unique_id", "customer_state",
                    "order_purchase_timestamp", "total_payment_value",
                    F.size("items").alias("n_items"),
                    it["price"].alias("item_price"), it["freight_value"].alias("item_freight"),
                    it["product_id"].alias("item_product_id"))


# --- stream facts, daily metrics and serving --------------------------------
STREAM_BATCH_EVENTS = 1000   # orders per simulated micro-batch (arrival order)
LIVE_AS_OF = "2024-01-15"


def _stream_facts(spark, sf_dir):
    from storelake.operators.stream_facts import stream_fact_rows
    return stream_fact_rows(Tables(spark, sf_dir).bronze.order_stream())


def _daily(spark, sf_dir):
    from storelake.operators.stream_facts import daily_metrics
    return daily_metrics(_stream_facts(spark, sf_dir))


def _alerts(spark, sf_dir):
    from storelake.operators.rules import all_alerts
    return all_alerts(_orders(spark, sf_dir))


def _anomalies(spark, sf_dir):
    from storelake.operators import serving
    return serving.reload_anomalies(serving.alerts_to_json(serving.kept_alerts(_alerts(spark, sf_dir))))


@register("stream_fact_order_items")
def q_stream_facts(spark, sf_dir):
    return _stream_facts(spark, sf_dir)


@register("daily_metrics")
def q_daily_metrics(spark, sf_dir):
    return _daily(spark, sf_dir)


@register("daily_metrics_from_kv")
def q_daily_from_kv(spark, sf_dir):
    from pyspark.sql import functions as F
    from storelake.operators import stream_facts as sf
    facts = _stream_facts(spark, sf_dir).withColumn(
        "batch_id", F.floor(F.col("order_id").cast("long") / STREAM_BATCH_EVENTS))
    return sf.kv_to_daily(sf.accumulate(sf.batch_increments(facts)))


@register("sales_by_day")
def q_sales_by_day(spark, sf_dir):
    from storelake.operators.serving import sales_by_day
    return sales_by_day(_daily(spark, sf_dir))


@register("live_metrics")
def q_live_metrics(spark, sf_dir):
    from storelake.operators.serving import live_metrics
    return live_metrics(_daily(spark, sf_dir), LIVE_AS_OF)


@register("alert_summary")
def q_alert_summary(spark, sf_dir):
    from storelake.operators.serving import alert_summary
    return alert_summary(_alerts(spark, sf_dir))


@register("recent_alerts")
def q_recent_alerts(spark, sf_dir):
    from storelake.operators.serving import recent_alerts
    return recent_alerts(_alerts(spark, sf_dir), 20)


@register("anomalies_reload")
def q_anomalies(spark, sf_dir):
    return _anomalies(spark, sf_dir)


@register("alert_history")
def q_alert_history(spark, sf_dir):
    from storelake.operators.serving import alert_history
    return alert_history(_anomalies(spark, sf_dir), 50)


@register("daily_metrics_upsert")
def q_upsert(spark, sf_dir):
    """The serving table as loaded while the last two weeks were half in (their
    days hold stale totals), then upserted with the last three weeks recomputed
    from every order: stale days are replaced, and the result equals a full reload."""
    from pyspark.sql import functions as F
    from storelake.operators.stream_facts import daily_metrics
    from storelake.sources.sinks import upsert
    facts = _stream_facts(spark, sf_dir)
    day = F.to_date("order_purchase_timestamp")
    last_day = facts.select(F.max(day)).scalar()
    loaded = facts.filter((day < F.date_sub(last_day, 14)) | (F.col("order_id").cast("long") % 2 == 0))
    updates = daily_metrics(facts).filter(F.col("metric_date") >= F.date_sub(last_day, 21))
    return upsert(daily_metrics(loaded), updates, ["metric_date"])


@register("served_alert_summary")
def q_served_summary(spark, sf_dir):
    """L3 over the reloaded alert list (at most the newest 200), as it is served."""
    from storelake.operators.serving import alert_summary
    return alert_summary(_anomalies(spark, sf_dir))


@register("serving_load_summary")
def q_load_summary(spark, sf_dir):
    from storelake.sources.sinks import row_counts
    return row_counts({"daily_metrics": _daily(spark, sf_dir), "anomalies": _anomalies(spark, sf_dir)})


def _positions(ordered):
    """The rows of a sorted frame with the place at which it returns them."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    at = ordered.withColumn("_at", F.monotonically_increasing_id())
    return at.withColumn("position", F.row_number().over(Window.orderBy("_at"))).drop("_at")


@register("sales_by_day_positions")
def q_sales_positions(spark, sf_dir):
    from storelake.operators.serving import sales_by_day
    return _positions(sales_by_day(_daily(spark, sf_dir)))


@register("alert_summary_positions")
def q_summary_positions(spark, sf_dir):
    from storelake.operators.serving import alert_summary
    return _positions(alert_summary(_alerts(spark, sf_dir)))


# --- bad rows in the stream: unreadable times, no state, no items, several items ---
BAD_ROWS_AS_OF = "2030-01-01 00:00:00"


def _bad_messages(spark, sf_dir):
    return Tables(spark, sf_dir).bronze.order_messages(bad_rows=True)


def _bad_orders(spark, sf_dir):
    from storelake.sources.stream import parse_orders
    return parse_orders(_bad_messages(spark, sf_dir))


def _bad_alerts(spark, sf_dir):
    from pyspark.sql import functions as F
    from storelake.operators.rules import alerts_of_messages
    return alerts_of_messages(_bad_messages(spark, sf_dir), F.lit(BAD_ROWS_AS_OF).cast("timestamp_ntz"))


@register("order_message_rejects")
def q_message_rejects(spark, sf_dir):
    """The reject table of a stream in which messages are cut short, lack a customer, or hold text for a number."""
    from pyspark.sql import functions as F
    from storelake.sources.stream import decode_orders, rejected_messages
    raw = Tables(spark, sf_dir).bronze.order_messages(bad_rows=True, malformed=True)
    return rejected_messages(decode_orders(raw)).select(
        F.regexp_extract("value", '"order_id":"([0-9]+)"', 1).alias("order_key"), "reject_reason", "used")


@register("order_messages_used")
def q_messages_used(spark, sf_dir):
    """What the same stream leaves: usable orders with their totals, decoded in the same single pass."""
    from storelake.sources.stream import decode_orders, valid_orders
    raw = Tables(spark, sf_dir).bronze.order_messages(bad_rows=True, malformed=True)
    return valid_orders(decode_orders(raw)).select("order_id", "customer_id", "total_payment_value", "reject_reason")


@register("stream_facts_bad_rows")
def q_bad_facts(spark, sf_dir):
    from storelake.operators.stream_facts import stream_fact_rows
    return stream_fact_rows(_bad_orders(spark, sf_dir))


@register("order_alerts_bad_rows")
def q_bad_alerts(spark, sf_dir):
    return _bad_alerts(spark, sf_dir)


@register("anomalies_reload_bad_rows")
def q_bad_anomalies(spark, sf_dir):
    from storelake.operators import serving
    return serving.reload_anomalies(serving.alerts_to_json(serving.kept_alerts(_bad_alerts(spark, sf_dir))))


@register("bronze_csv_roundtrip")
def q_bronze_csv(spark, sf_dir):
    """Orders written as a headered extract with further columns and another
    column order, and read back by name."""
    from pyspark.sql import functions as F
    from storelake.session import scratch_path
    from storelake.sources.tables import read_bronze
    root = scratch_path(spark, "bronze-csv")
    o = Tables(spark, sf_dir).bronze.orders
    extra = o.select(F.lit("x").alias("order_approved_at"), *reversed(o.columns), F.lit(1).alias("carrier"))
    extra.write.option("header", True).csv(f"{root}/orders")
    return read_bronze(spark, root, "orders")


@register("bronze_csv_rejects")
def q_bronze_rejects(spark, sf_dir):
    """Fields of an orders extract that don't fit their type, with the row they stood in."""
    from pyspark.sql import functions as F
    from storelake.session import scratch_path
    from storelake.sources.tables import bronze_rejects
    root = scratch_path(spark, "bronze-csv")
    o = Tables(spark, sf_dir).bronze.orders
    late = F.col("order_id") % 83 == 0
    odd = o.withColumns({
        "order_purchase_timestamp": F.when(late, F.date_format("order_purchase_timestamp", "dd/MM/yyyy"))
                                     .otherwise(F.col("order_purchase_timestamp").cast("string")),
        "order_estimated_delivery_date": F.when(F.col("order_id") % 59 == 0, F.lit("soon"))
                                          .otherwise(F.col("order_estimated_delivery_date").cast("string"))})
    odd.write.option("header", True).csv(f"{root}/orders")
    r = bronze_rejects(spark, root, "orders")
    return r.select("column_name", "value", F.get_json_object("record", "$.order_id").alias("order_id"))


# --- forecasting -------------------------------------------------------------
def _daily_sales(spark, sf_dir):
    """The gold daily-sales table the forecasts read: written once to the
    shared folder and read back, as the layer jobs hand it over."""
    from storelake.sources.sinks import materialize
    s = _silver(spark, sf_dir)
    return materialize(gold.daily_sales_by_category(s.lines, s.products), "daily-sales")


@register("weekly_category_demand")
def q_weekly(spark, sf_dir):
    from storelake.operators.forecast import weekly_series
    return weekly_series(_daily_sales(spark, sf_dir)).select("category_english", "week", "x", "y")


@register("forecast_evaluation_metrics")
def q_backtest(spark, sf_dir):
    from storelake.operators.forecast import backtest
    return backtest(_daily_sales(spark, sf_dir))


@register("forecast_weekly_demand")
def q_forecast(spark, sf_dir):
    from storelake.operators.forecast import forecast
    return forecast(_daily_sales(spark, sf_dir))


@register("forecast_accuracy_summary")
def q_forecast_summary(spark, sf_dir):
    from storelake.operators.forecast import backtest, evaluation_summary
    return evaluation_summary(backtest(_daily_sales(spark, sf_dir)))


@register("forecast_worst_categories")
def q_forecast_worst(spark, sf_dir):
    from storelake.operators.forecast import backtest, worst_categories
    return worst_categories(backtest(_daily_sales(spark, sf_dir)))


# --- baskets -----------------------------------------------------------------
def _basket_fact(spark, sf_dir, item: str):
    """Order lines with the basket item: the product id, or its category. Payments would only repeat rows, of which a
    basket holds each item once; products are joined to the items, which then meet their orders dealt as baskets are."""
    s = _silver(spark, sf_dir)
    if item == "product_id":
        return s.lines
    return silver.lines_with_products(s.bronze.order_items, s.bronze.orders, s.products.select("product_id", item))


def _recs(spark, sf_dir, item="product_category_name", single=True):
    from storelake.operators import baskets as b
    bk = b.baskets(_basket_fact(spark, sf_dir, item), item)
    return b.recommendations(b.mined_rules(bk), single_antecedent=single)


@register("multi_item_baskets")
def q_baskets(spark, sf_dir):
    from pyspark.sql import functions as F
    from storelake.operators.baskets import baskets
    bk = baskets(_basket_fact(spark, sf_dir, "product_category_name"), "product_category_name")
    return bk.select("order_id", F.size("items").alias("n_items"),
                     F.array_join(F.array_sort("items"), ",").alias("items_key"))


@register("basket_rules")
def q_basket_rules(spark, sf_dir):
    return _recs(spark, sf_dir)


@register("basket_rules_by_product")
def q_basket_rules_product(spark, sf_dir):
    return _recs(spark, sf_dir, item="product_id")


PRODUCT_PAIR_SUPPORT, PRODUCT_PAIR_CONFIDENCE = 0.0002, 0.05


@register("basket_rules_by_product_pairs")
def q_basket_product_pairs(spark, sf_dir):
    """Product rules at thresholds that product baskets reach."""
    from storelake.operators import baskets as b
    bk = b.baskets(_basket_fact(spark, sf_dir, "product_id"), "product_id")
    return b.recommendations(b.mined_rules(bk, PRODUCT_PAIR_SUPPORT, PRODUCT_PAIR_CONFIDENCE), single_antecedent=True)


@register("basket_rules_all_antecedents")
def q_basket_rules_all(spark, sf_dir):
    return _recs(spark, sf_dir, single=False)


@register("basket_rules_levelwise")
def q_basket_rules_levelwise(spark, sf_dir):
    """Rules of all antecedents by joins, level by level; the first antecedent item is the rarest."""
    from storelake.operators import baskets as b
    from storelake.operators import itemsets
    bk = b.baskets(_basket_fact(spark, sf_dir, "product_category_name"), "product_category_name")
    return b.recommendations(itemsets.rules(bk))


@register("basket_itemsets")
def q_basket_itemsets(spark, sf_dir):
    """Frequent sets of categories with the number of baskets that hold them."""
    from pyspark.sql import functions as F
    from storelake.operators import baskets as b
    from storelake.operators import itemsets
    bk = b.baskets(_basket_fact(spark, sf_dir, "product_category_name"), "product_category_name")
    sets, items, _ = itemsets.frequent_itemsets(bk)
    named = sets.select("items", "freq", F.explode("items").alias("no")).join(items.select("no", "item"), "no")
    return named.groupBy("items", "freq").agg(F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items_key")).drop("items")


@register("basket_rule_quality")
def q_rule_quality(spark, sf_dir):
    from storelake.operators.baskets import rule_quality
    return rule_quality(_recs(spark, sf_dir))


@register("top_basket_rules")
def q_top_rules(spark, sf_dir):
    from storelake.operators.baskets import top_rules
    return top_rules(_recs(spark, sf_dir))


# --- models --------------------------------------------------------------------
def _delay_table(spark, sf_dir):
    return gold.ml_features(_silver(spark, sf_dir).rows_with(**gold.ML_DIMENSIONS), keep_order_id=True)


def _price_table(spark, sf_dir):
    return gold.pricing_features(_silver(spark, sf_dir).rows_with(**gold.PRICING_DIMENSIONS))


def _fit_predict(df, spec):
    """Fit on the train side and return the test predictions (lazy).

    The model input is written once to the shared folder: the indexer pass, GBT's own passes and the predictions read it
    instead of building the feature joins again, and it takes no memory from the trees."""
    from storelake.operators import models as m
    from storelake.sources.sinks import materialize
    data = m.spread(materialize(m.with_split_number(m.model_input(df, spec), "order_id"), "model-input"))
    train, test = m.split(data, key="order_id")
    return m.fit(train, spec).transform(test)


@register("shipment_delay_predictions")
def q_delay_predictions(spark, sf_dir):
    from storelake.operators import models as m
    return m.delay_predictions(_fit_predict(_delay_table(spark, sf_dir), m.DELAY))


@register("pricing_recommendations")
def q_pricing_recs(spark, sf_dir):
    from storelake.operators import models as m
    return m.pricing_recommendations(_fit_predict(_price_table(spark, sf_dir), m.PRICE))


@register("delay_best_split")
def q_best_split(spark, sf_dir):
    """The best first split of the delay model's table over all its numeric features and all their values."""
    from storelake.operators import models as m
    from storelake.operators import stump
    data = m.model_input(_delay_table(spark, sf_dir), m.DELAY)
    return _rounded6(stump.best_split(data, m.DELAY.label, list(m.DELAY.numeric)))


@register("delay_first_tree")
def q_first_tree(spark, sf_dir):
    """The split that the boosted trees make first (one tree, depth 1), over the features of few values."""
    from dataclasses import replace

    from storelake.operators import models as m
    from storelake.operators import stump
    from storelake.sources.sinks import materialize
    spec = replace(m.DELAY, numeric=stump.FEW_VALUES, categorical=())
    columns = dict.fromkeys([spec.label, *spec.required, *spec.numeric])
    data = materialize(m.model_input(_delay_table(spark, sf_dir), spec).select(*columns), "model-input")
    model = m.fit(m.spread(data), spec, max_iter=1, max_depth=1, max_bins=stump.MAX_BINS)
    return _rounded6(stump.first_split(model, list(spec.numeric), spark))


def _rounded6(df):
    from storelake.operators.seasonal_fit import rounded
    return rounded(df)


@register("model_split_counts")
def q_split_counts(spark, sf_dir):
    """Both sides of the model split: rows, orders and the sum of their ids."""
    from functools import reduce
    from pyspark.sql import DataFrame
    from pyspark.sql import functions as F
    from storelake.operators import models as m
    sides = zip(("train", "test"), m.split(m.model_input(_price_table(spark, sf_dir), m.PRICE), key="order_id"))
    return reduce(DataFrame.unionAll, [
        df.agg(F.lit(n).alias("side"), F.count(F.lit(1)).alias("row_count"),
               F.count_distinct("order_id").alias("orders"), F.sum("order_id").alias("id_sum")) for n, df in sides])


def _plain_predictions(spark, sf_dir):
    """The pricing input with an arithmetic stand-in for the model's prediction."""
    from pyspark.sql import functions as F
    from storelake.operators import models as m
    return m.model_input(_price_table(spark, sf_dir), m.PRICE).withColumn(
        "prediction", F.floor("price") + F.col("delivery_days") * 0.5)


@register("model_metrics")
def q_model_metrics(spark, sf_dir):
    from pyspark.sql import functions as F
    from storelake.operators import models as m
    r = m.regression_metrics(_plain_predictions(spark, sf_dir), "price")
    return r.select(*[F.round(c, 6).alias(c) for c in ("mae", "rmse", "r2")], "test_rows")


@register("pricing_adjustments")
def q_adjustments(spark, sf_dir):
    from storelake.operators import models as m
    return m.pricing_recommendations(_plain_predictions(spark, sf_dir))


@register("customer_state_index")
def q_state_index(spark, sf_dir):
    """StringIndexer labels of the delay model's customer_state (frequency
    descending, ties alphabetical), fitted on all rows that the model may read."""
    from pyspark.ml.feature import StringIndexer
    from storelake.operators import models as m
    data = m.model_input(_delay_table(spark, sf_dir), m.DELAY)
    idx = StringIndexer(inputCol="customer_state", outputCol="customer_state_idx",
                        handleInvalid="keep").fit(data)
    return idx.transform(data.select("customer_state")).distinct()


@register("model_input_counts")
def q_model_input_counts(spark, sf_dir):
    """Rows loaded, with the required columns, and surviving the assembler,
    for both model tables: one conditional-count pass per table."""
    from functools import reduce
    from pyspark.sql import DataFrame
    from pyspark.sql import functions as F
    from storelake.operators import models as m

    def counts(df, spec, prefix):
        req = reduce(lambda a, c: a & F.col(c).isNotNull(), spec.required, F.lit(True))
        asm = reduce(lambda a, c: a & F.col(c).isNotNull(), spec.numeric, req)
        row = df.agg(F.count(F.lit(1)).alias("loaded"), F.count(F.when(req, 1)).alias("required"),
                     F.count(F.when(asm, 1)).alias("assembled"))
        return row.select(F.explode(F.array(*[
            F.struct(F.lit(f"{prefix}.{k}").alias("table_name"), F.col(k).alias("row_count"))
            for k in ("loaded", "required", "assembled")])).alias("c")).select("c.*")

    return reduce(DataFrame.unionByName, [counts(_delay_table(spark, sf_dir), m.DELAY, "delay"),
                                          counts(_price_table(spark, sf_dir), m.PRICE, "price")])


# --- streaming runs (availableNow over the staged order files) -------------------
@register("stream_order_alerts")
def q_stream_alerts(spark, sf_dir):
    """The six rules run as a stream (4 arrivals, state carried across)."""
    from storelake.session import scratch_path
    from storelake.streaming.jobs import replay, start_alerts
    inp, out, ck = (scratch_path(spark, n) for n in ("orders-in", "alerts", "alerts-ck"))
    replay(spark, Tables(spark, sf_dir).events, inp,
           lambda raw: start_alerts(raw, out, ck, trigger="availableNow"))
    return spark.read.parquet(out)


@register("stream_alerts_late_hot_customers")
def q_stream_alert_tables(spark, sf_dir):
    """The six rules over ten customers, kept in versioned tables by a stream in which every 7th order
    arrives a week late: the same alerts as over all orders at once."""
    from datetime import timedelta

    from storelake.session import scratch_path
    from storelake.sources.versions import Versions
    from storelake.streaming.jobs import replay
    from storelake.streaming.state_table import alerts, start_alert_tables
    inp, root, ck = (scratch_path(spark, n) for n in ("orders-in", "alert-tables", "alert-tables-ck"))
    replay(spark, Tables(spark, sf_dir).events, inp,
           lambda raw: start_alert_tables(raw, root, ck, "availableNow", late_within=timedelta(days=16), compact_every=2),
           customer_buckets=10, late_every=7)
    return alerts(Versions(spark, root))


@register("stream_daily_metrics")
def q_stream_daily(spark, sf_dir):
    """Stream fact rows and per-batch day increments, then the served totals."""
    from storelake.operators.stream_facts import accumulate, kv_to_daily
    from storelake.session import scratch_path
    from storelake.streaming.jobs import replay, start_facts
    inp, facts, inc, ck = (scratch_path(spark, n) for n in ("orders-in", "facts", "increments", "facts-ck"))
    replay(spark, Tables(spark, sf_dir).events, inp,
           lambda raw: start_facts(raw, facts, inc, ck, trigger="availableNow"))
    return kv_to_daily(accumulate(spark.read.parquet(inc)))


class _Lost(RuntimeError):
    """A driver that is lost, as far as a running query can tell."""


def _fails_once(points):
    """A callback that raises the first time it sees each of ``points``."""
    left = set(points)

    def seen(*point):
        if point in left:
            left.remove(point)
            raise _Lost(str(point))
    return seen


@register("stream_daily_metrics_restarted")
def q_stream_daily_restarted(spark, sf_dir):
    """The daily totals of a stream that is lost three times between writing a table and finishing its batch, and is started
    again from its checkpoint: the same totals as of a stream that runs through."""
    from storelake.operators.stream_facts import accumulate, kv_to_daily
    from storelake.session import scratch_path
    from storelake.streaming.jobs import replay, start_facts
    inp, facts, inc, ck = (scratch_path(spark, n) for n in ("orders-in", "facts", "increments", "facts-ck"))
    lost = _fails_once([("facts", 1), ("increments", 1), ("increments", 3)])
    replay(spark, Tables(spark, sf_dir).events, inp,
           lambda raw: start_facts(raw, facts, inc, ck, trigger="availableNow", written=lost), attempts=3)
    return kv_to_daily(accumulate(spark.read.parquet(inc)))


def _alert_list(spark, sf_dir):
    """The alert list after four arrivals; the query is lost before one of its commits and started again."""
    from storelake.session import scratch_path
    from storelake.sources.versions import Versions
    from storelake.streaming.alert_list import start_alert_list
    from storelake.streaming.jobs import replay
    lost = _fails_once([(2,)])

    class Unsteady(Versions):
        def commit(self, version, tables, **notes):
            lost(version)
            super().commit(version, tables, **notes)

    inp, root, ck = (scratch_path(spark, n) for n in ("orders-in", "alert-list", "alert-list-ck"))
    state = Unsteady(spark, root)
    replay(spark, Tables(spark, sf_dir).events, inp,
           lambda raw: start_alert_list(raw, root, ck, "availableNow", state=state), attempts=2)
    return state


@register("stream_newest_alerts")
def q_stream_newest(spark, sf_dir):
    """The newest 200 alerts as the stream keeps them, through a restart."""
    from storelake.streaming.alert_list import newest_alerts
    return newest_alerts(_alert_list(spark, sf_dir))


@register("stream_alert_counts")
def q_stream_alert_counts(spark, sf_dir):
    """Alerts by rule in each micro-batch, through a restart."""
    from storelake.streaming.alert_list import batch_counts
    return batch_counts(_alert_list(spark, sf_dir))


# the seasonal model twice: grouped pandas, and sums solved in Spark; both reported to 6 decimals
def _seasonal_query(module: str, fn: str):
    def q(spark, sf_dir):
        import importlib

        from storelake.operators.seasonal_fit import rounded
        return rounded(getattr(importlib.import_module(f"storelake.operators.{module}"), fn)(_daily_sales(spark, sf_dir)))
    return q


for _n, _m, _f in [("forecast_weekly_demand_seasonal", "seasonal", "seasonal_forecast"),
                   ("forecast_evaluation_seasonal", "seasonal", "seasonal_backtest"),
                   ("forecast_weekly_demand_seasonal_native", "seasonal_fit", "seasonal_forecast"),
                   ("forecast_evaluation_seasonal_native", "seasonal_fit", "seasonal_backtest")]:
    register(_n)(_seasonal_query(_m, _f))
