"""One decode per message, and nothing lost: every message is usable, rejected with a reason, or both."""

import json

from pyspark.sql import functions as F

from storelake import schemas
from storelake.sources import stream as S
from storelake.sources.tables import bronze_rejects, read_bronze

GOOD = {"order_id": "1", "customer_id": "c", "total_payment_value": 5.5, "items": [{"order_item_id": 1, "price": 2.0}]}
CASES = [
    (json.dumps(GOOD), None),
    (json.dumps(GOOD)[:-10], "malformed"),
    ("", "malformed"), ("   ", "malformed"), ("no json", "malformed"), ("[1, 2]", "malformed"), (None, "malformed"),
    ("{}", "no_order_id"), (json.dumps(GOOD | {"order_id": None}), "no_order_id"),
    (json.dumps(GOOD | {"customer_id": None}), "no_customer_id"),
    (json.dumps(GOOD | {"total_payment_value": "n/a"}), "bad_field"),
    (json.dumps(GOOD | {"items": "none"}), "bad_field"),
    (json.dumps(GOOD | {"unknown": {"x": 1}}), None),
]


def decoded(spark):
    return S.decode_orders(spark.createDataFrame([(v, k) for k, (v, _) in enumerate(CASES)], "value string, k int"))


def test_reasons(spark):
    got = decoded(spark).groupBy("value", "reject_reason").count().collect()
    assert {(r["value"], r["reject_reason"]) for r in got} == set(CASES)


def test_every_message_is_used_or_rejected(spark):
    d = decoded(spark)
    used = {r["value"] for r in S.valid_orders(d).collect()}
    rejected = {r["value"]: r["used"] for r in S.rejected_messages(d).collect()}
    assert used | set(rejected) == {v for v, _ in CASES}
    assert {v for v, kept in rejected.items() if kept} == used & set(rejected)


def test_a_bad_field_is_null_and_the_others_stay(spark):
    row = S.valid_orders(decoded(spark)).filter(F.col("value").contains("n/a")).first()
    assert row.total_payment_value is None and row["items"][0].price == 2.0


def test_parsed_columns_are_the_declared_ones(spark):
    assert S.parse_orders(spark.createDataFrame([("{}",)], "value string")).schema.names == schemas.ORDER_MESSAGE.names
    assert S.parse_orders(spark.createDataFrame([], "value string")).count() == 0


def test_bronze_rejects_hold_field_and_row(spark, tmp_path):
    folder = tmp_path / "order_items"
    folder.mkdir()
    (folder / "x.csv").write_text("extra,order_id,order_item_id,product_id,seller_id,price,freight_value\n"
                                  "e,1,1,2,3,9.5,1.0\ne,2,one,2,3,cheap,\ne,3,1,2,3,,2.0\n")
    rows = bronze_rejects(spark, str(tmp_path), "order_items").collect()
    assert {(r.column_name, r.value, json.loads(r.record)["order_id"]) for r in rows} == {("order_item_id", "one", "2"), ("price", "cheap", "2")}
    assert all(json.loads(r.record)["extra"] == "e" for r in rows)
    assert read_bronze(spark, str(tmp_path), "order_items").count() == 3


def test_the_alert_stream_keeps_its_rejects(spark, tmp_path):
    from storelake.sources.versions import Versions
    from storelake.streaming.jobs import read_text_stream
    from storelake.streaming.state_table import alerts, rejects, start_alert_tables
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text("\n".join([json.dumps(GOOD | {"total_payment_value": 4000}), "{bad", json.dumps(GOOD | {"customer_id": None})]))
    start_alert_tables(read_text_stream(spark, str(src)), str(tmp_path / "t"), str(tmp_path / "c"), "availableNow").awaitTermination()
    state = Versions(spark, str(tmp_path / "t"))
    assert sorted(r.reject_reason for r in rejects(state).collect()) == ["malformed", "no_customer_id"]
    assert [(r.order_id, r.type) for r in alerts(state).collect()] == [("1", "amount")]
