"""The fact with its dimensions: each joined to the table that holds its key."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from storelake.operators import gold, silver
from storelake.plans.registry import QUERIES, _silver


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def doubled(df, key):
    """Every 7th key listed twice, every 11th not at all."""
    df = df.filter(F.col(key) % 11 != 0)
    return df.unionByName(df.filter(F.col(key) % 7 == 0))


@pytest.mark.parametrize("mode", ["fanout", "aggregate"])
def test_rows_equal_the_fact_joined_to_the_dimensions(spark, mode):
    s = _silver(spark, SF_SMALL, mode)
    p, c, v = doubled(s.products, "product_id"), doubled(s.customers, "customer_id"), doubled(s.sellers, "seller_id")
    b = s.bronze
    rows = silver.fact_with_dimensions(b.order_items, b.orders, b.payments, p.select(gold.ML_DIMENSIONS["products"]),
                                       c.select(gold.ML_DIMENSIONS["customers"]), v.select(gold.ML_DIMENSIONS["sellers"]), mode)
    priced = silver.fact_with_dimensions(b.order_items, b.orders, b.payments, p.select(gold.PRICING_DIMENSIONS["products"]),
                                         c.select(gold.PRICING_DIMENSIONS["customers"]), payment_mode=mode)
    for got, want in [(gold.ml_features(rows, True), gold.ml_feature_store(s.fact, p, c, v, True)),
                      (gold.pricing_features(priced), gold.order_features_for_pricing(s.fact, p, c))]:
        got, want = (Counter(map(tuple, x.collect())) for x in (got, want))
        assert got == want and len(want) > 100


def test_growing_tables_stay_out_of_the_driver(spark):
    for name in ("ml_feature_store_v2", "order_features_for_pricing", "model_input_counts"):
        p = plan(QUERIES[name](spark, SF_SMALL))
        joins = [x for x in p.splitlines() if "BroadcastHashJoin" in x]
        assert not any(k in x for x in joins for k in ("order_id#", "product_id#", "customer_id#")), name


def test_totals_by_order_need_no_exchange_of_their_own(spark):
    p = plan(QUERIES["ml_feature_store_v2"](spark, SF_SMALL))
    # items and orders and payments, each dealt by order once
    assert "Window" in p and p.count("Exchange hashpartitioning(order_id") == 3


def test_model_input_is_built_once(spark, monkeypatch):
    from storelake.operators import models as m
    from storelake.plans import registry
    from storelake.sources import sinks
    made, real = [], sinks.materialize
    monkeypatch.setattr(sinks, "materialize", lambda df, name: made.append(name) or real(df, name))
    fit = m.fit
    monkeypatch.setattr(m, "fit", lambda train, spec, **kw: fit(train, spec, **{**kw, "max_iter": 1, "max_depth": 1}))
    for fn in (registry.q_pricing_recs, registry.q_delay_predictions, registry.q_first_tree):
        made.clear()
        out = fn(spark, SF_SMALL)
        assert made == ["model-input"]
        assert "lineitem" not in plan(out) and out.count() > 0
