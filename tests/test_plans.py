"""Plan properties: pushdown, pruning, outer->inner, no driver work."""

import pytest

from conftest import SF_SMALL
from storelake.plans.registry import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_price_filter_reaches_scan(spark):
    p = plan(QUERIES["order_features_for_pricing"](spark, SF_SMALL))
    assert "GreaterThan(l_extendedprice,0.0)" in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(QUERIES["customer_spending_profile"](spark, SF_SMALL))
    line = [ln for ln in p.splitlines() if "lineitem" in ln][0]
    assert "l_shipdate" not in line and "l_returnflag" not in line and "l_tax" not in line


def test_weight_filter_turns_product_join_inner(spark):
    o = optimized(QUERIES["ml_feature_store_v2"](spark, SF_SMALL))
    # the product join becomes an inner join once the weight must be non-null
    assert "Join Inner" in o


def test_profile_aggregates_before_customer_join(spark):
    o = optimized(QUERIES["customer_spending_profile"](spark, SF_SMALL))
    j = o.index("Join LeftOuter")
    assert "Aggregate" in o[j:]          # an aggregate sits below the customer join


def test_sequence_rules_use_no_customer_wide_window(spark):
    from storelake.operators import rules
    from storelake.plans.registry import _orders
    seq = rules.customer_sequence(_orders(spark, SF_SMALL))
    p = plan(seq)
    # every window is partitioned by the chunk key or by the chunk summary,
    # never by the customer column alone
    for ln in p.splitlines():
        if "Window [" in ln and "_chunk" not in ln:
            assert "partitionBy" not in ln or "_k" in ln


def test_model_save_load_parity(spark, tmp_path):
    from storelake.operators import models as m
    df = QUERIES["order_features_for_pricing"](spark, SF_SMALL)
    data = m.model_input(df, m.PRICE)
    train, test = m.split(data, key="order_id")
    model = m.fit(train, m.PRICE, max_iter=3, max_depth=3)
    m.save_model(model, str(tmp_path / "model"))
    again = m.load_model(str(tmp_path / "model"))
    a = model.transform(test).select("order_id", "product_id", "prediction")
    b = again.transform(test).select("order_id", "product_id", "prediction")
    assert a.exceptAll(b).count() == 0 and a.count() == b.count() > 0
    met = m.regression_metrics(model.transform(test), "price").first()
    assert met.test_rows == a.count() and met.rmse >= 0


def test_broadcast_only_after_size_check(spark):
    from storelake.operators.joins import broadcast_if_small
    small = broadcast_if_small(spark.range(25), max_rows=100)
    big = broadcast_if_small(spark.range(1000), max_rows=100)
    assert "broadcast" in small._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in big._jdf.queryExecution().analyzed().toString().lower()



def test_one_item_scan_and_no_payments_where_not_needed(spark):
    ml = optimized(QUERIES["ml_feature_store_v2"](spark, SF_SMALL))
    assert ml.count("l_orderkey") > 0 and ml.count("Relation [l_orderkey") == 1
    from storelake.operators import gold
    from storelake.plans.registry import _silver
    s = _silver(spark, SF_SMALL)
    sales = optimized(gold.daily_sales_by_category(s.lines, s.products))
    assert "payment" not in sales and "o_totalprice" not in sales.split("Relation")[0]


def test_scans_are_left_as_they_are(spark):
    from storelake.sources.tables import Tables
    assert "Repartition" not in optimized(Tables(spark, SF_SMALL).lineitem)


def test_messages_are_decoded_once(spark):
    for name in ("parsed_order_stream", "stream_facts_bad_rows", "order_message_rejects", "order_messages_used"):
        assert optimized(QUERIES[name](spark, SF_SMALL)).count("from_json(") == 1, name
    from storelake.operators import rules
    from storelake.sources.stream import parse_orders
    from storelake.sources.tables import Tables
    orders = rules.prepare_orders(parse_orders(Tables(spark, SF_SMALL).bronze.order_messages(bad_rows=True)))
    for df in (rules.stateless_alerts(orders), rules.first_order_alerts(orders)):
        assert optimized(df).count("from_json(") == 1
    # the alerts read a table of decoded orders
    assert "from_json(" not in optimized(QUERIES["order_alerts_bad_rows"](spark, SF_SMALL))


def test_bronze_rejects_read_the_extract_once(spark):
    assert optimized(QUERIES["bronze_csv_rejects"](spark, SF_SMALL)).count("Relation [") == 1


def executed(df) -> str:
    """The final plan, after it has run."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_bucketed_fact_and_totals_need_no_exchange(spark, no_broadcast):
    from pyspark.sql import functions as F

    from storelake.operators import gold
    fact = QUERIES["fact_order_items_bucketed"](spark, SF_SMALL)
    p = plan(fact)
    assert "Exchange" not in p and p.count("SortMergeJoin") == 2 and p.count("Bucketed: true") == 3
    totals = plan(fact.withColumns(gold.order_totals()))
    assert "Exchange" not in totals and "Window" in totals
    assert "Exchange" not in plan(fact.groupBy("order_id").agg(F.sum("price")))
    assert plan(QUERIES["fact_order_items"](spark, SF_SMALL)).count("Exchange hashpartitioning") == 3


def test_feature_store_over_a_bucketed_fact_has_no_exchange_for_its_totals(spark):
    p = plan(QUERIES["ml_feature_store_bucketed"](spark, SF_SMALL))
    assert "Window" in p and "hashpartitioning(order_id" not in p and "Bucketed: true" in p


def test_a_bucketed_folder_can_be_opened_again(spark, tmp_path, no_broadcast):
    from storelake.sources.bucketed import open_bucketed, write_bucketed
    df = spark.range(1000).selectExpr("id % 97 AS order_id", "id AS v")
    write_bucketed(df, str(tmp_path / "t"), "order_id", 4)
    again = open_bucketed(spark, str(tmp_path / "t"), "order_id", 4)
    assert again.exceptAll(df).count() == 0 and again.count() == 1000
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 4
    assert "Exchange" not in plan(again.join(again.groupBy("order_id").count(), "order_id"))


def test_month_filter_prunes_at_run_time(spark):
    p = plan(QUERIES["order_features_by_quarter"](spark, SF_SMALL))
    scan = [x for x in p.splitlines() if "dynamicpruning" in x]
    assert scan and "purchase_month" in scan[0]


def test_pruned_months_are_not_read(spark, tmp_path):
    from storelake.sources.sinks import read_months, write_table
    write_table(spark.range(1200).selectExpr("id", "CAST(id % 12 + 1 AS INT) AS purchase_month"), str(tmp_path / "t"), ["purchase_month"])
    months = spark.createDataFrame([(m, (m + 2) // 3) for m in range(1, 13)], "purchase_month int, quarter int")
    df = read_months(spark, str(tmp_path / "t"), months.filter("quarter = 2"))
    assert {r.purchase_month for r in df.collect()} == {4, 5, 6} and df.count() == 300
    assert "dynamicpruning" in plan(df)


def test_a_bucket_stays_small_as_its_table_grows(spark, monkeypatch):
    from storelake.sources import bucketed
    monkeypatch.setattr(bucketed, "_input_bytes", lambda df: 4 << 30)
    assert bucketed.buckets_for(spark.range(1)) >= 200
