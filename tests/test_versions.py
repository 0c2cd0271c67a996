"""Versioned tables and the alert stream kept in them."""

import json
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from storelake.operators import rules
from storelake.session import scratch_path
from storelake.sources import versions as V
from storelake.streaming import state_table as S

T0 = datetime(2024, 1, 1)
PREPARED = ("order_id string, customer_unique_id string, customer_state string, ts timestamp_ntz, detected_at timestamp_ntz, "
            "total double, first_freight double, purchase_hour int, ts_ok boolean")


def prepared(spark, rows):
    """(order, customer, state, minutes after T0 or None, total) as prepared orders."""
    out = []
    for o, c, s, m, total in rows:
        t = None if m is None else T0 + timedelta(minutes=m)
        out.append((o, c, s, t, t or T0, float(total), 0.0, None if t is None else t.hour, t is not None))
    return spark.createDataFrame(out, PREPARED)


def bag(df):
    return Counter((r.order_id, r.type, r.details) for r in df.collect())


def batches_of(rows, n, late_every):
    """Rows in time order dealt to ``n`` batches; every ``late_every``-th comes one batch later."""
    rows = sorted(rows, key=lambda r: (r[3] is None, r[3] or 0, r[0]))
    out = [[] for _ in range(n)]
    for k, r in enumerate(rows):
        step = k * n // len(rows) + (1 if late_every and k % late_every == 0 else 0)
        out[min(step, n - 1)].append(r)
    return out


def orders(seed, n, customers):
    import random
    g = random.Random(seed)
    rows = []
    for k in range(n):
        c = customers[0] if g.random() < 0.4 else g.choice(customers)
        rows.append((f"o{k:04d}", c, g.choice(["SP", "AM", "RJ", "RR", "", None]), g.randint(0, n * 4), g.choice([100, 600, 3500])))
    return rows + [("bad1", customers[0], "SP", None, 9000), ("bad2", None, "SP", None, 10)]


@pytest.mark.parametrize("late_every, within, compact", [(None, None, 16), (5, None, 16), (5, timedelta(minutes=1300), 16), (3, timedelta(minutes=1300), 2)])
def test_alert_tables_equal_the_batch_rules(spark, late_every, within, compact):
    rows = orders(1, 600, ["hot", "b", "c", None])
    state = V.Versions(spark, scratch_path(spark, "state"))
    for v, part in enumerate(batches_of(rows, 4, late_every)):
        S.advance(state, prepared(spark, part), v, late_within=within, compact_every=compact)
    want = bag(rules.all_alerts(prepared(spark, rows)))
    assert bag(S.alerts(state)) == want and {t for _, t, _ in want} >= {"geo_velocity", "velocity", "first_order_high_value", "amount"}
    assert S.late_orders(state).count() == 0


def test_every_version_equals_the_batch_rules_over_what_has_come(spark):
    rows = orders(2, 240, ["hot", "b"])
    state, seen = V.Versions(spark, scratch_path(spark, "state")), []
    for v, part in enumerate(batches_of(rows, 3, 4)):
        S.advance(state, prepared(spark, part), v, late_within=timedelta(minutes=700))
        seen += part
        assert bag(S.alerts(state)) == bag(rules.all_alerts(prepared(spark, seen)))


def test_orders_too_late_are_kept_and_raise_the_stateless_rules_only(spark):
    state = V.Versions(spark, scratch_path(spark, "state"))
    first = [("a", "x", "SP", 0, 10), ("b", "x", "SP", 5000, 10)]
    S.advance(state, prepared(spark, first), 0, late_within=timedelta(minutes=60))
    S.advance(state, prepared(spark, [("c", "x", "AM", 10, 4000), ("d", "y", "SP", 20, 700), ("e", "x", "SP", 4990, 10)]), 1,
              late_within=timedelta(minutes=60))
    assert {r.order_id for r in S.late_orders(state).collect()} == {"c", "d"}
    assert bag(S.alerts(state)) == Counter({("c", "amount", "Value 4000 exceeds 3000"): 1})


def test_a_batch_that_fails_before_its_commit_is_invisible_and_can_be_repeated(spark, monkeypatch):
    rows = orders(3, 200, ["hot", "b"])
    parts = batches_of(rows, 2, 6)
    state = V.Versions(spark, scratch_path(spark, "state"))
    S.advance(state, prepared(spark, parts[0]), 0, late_within=timedelta(minutes=500))
    before = bag(S.alerts(state))

    def fails(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(V.Versions, "commit", fails)
        with pytest.raises(RuntimeError):
            S.advance(state, prepared(spark, parts[1]), 1, late_within=timedelta(minutes=500))
    assert state.current() == 0 and bag(S.alerts(state)) == before
    S.advance(state, prepared(spark, parts[1]), 1, late_within=timedelta(minutes=500))
    after = bag(S.alerts(state))
    assert after == bag(rules.all_alerts(prepared(spark, rows)))
    S.advance(state, prepared(spark, parts[1]), 1, late_within=timedelta(minutes=500))        # replayed after its commit
    assert bag(S.alerts(state)) == after


def test_a_hot_customer_is_split_over_chunks(spark):
    from storelake.operators import sequence
    rows = prepared(spark, [(f"{k:04d}", "hot", "SP", k, 10) for k in range(800)])
    c = sequence.chunk_rows(rows.select(*S.ORDER_COLUMNS), rules.CUSTOMER, rules.ORDER)
    assert c.groupBy(sequence.CHUNK).count().count() > 1


# keyed upsert

ROWS = "metric_date string, orders bigint"


def table(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def test_upsert_is_all_or_nothing(spark, monkeypatch):
    t = V.Versions(spark, scratch_path(spark, "daily"))
    assert V.upsert_version(t, "daily", table(spark, [("d1", 1), ("d2", 2)]), ["metric_date"]) == 0
    with monkeypatch.context() as m:
        m.setattr(V.Versions, "commit", lambda *_, **__: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            V.upsert_version(t, "daily", table(spark, [("d2", 20), ("d3", 30)]), ["metric_date"])
    assert sorted(map(tuple, t.read("daily", ROWS).collect())) == [("d1", 1), ("d2", 2)]
    assert V.upsert_version(t, "daily", table(spark, [("d2", 21), ("d3", 31)]), ["metric_date"]) == 1
    assert sorted(map(tuple, t.read("daily", ROWS).collect())) == [("d1", 1), ("d2", 21), ("d3", 31)]
    assert V.upsert_version(t, "daily", table(spark, [("d1", 99)]), ["metric_date"], version=1) == 1
    assert sorted(map(tuple, t.read("daily", ROWS).collect())) == [("d1", 1), ("d2", 21), ("d3", 31)]


def test_readers_of_a_version_survive_the_next_commits_and_vacuum(spark):
    t = V.Versions(spark, scratch_path(spark, "daily"))
    V.upsert_version(t, "daily", table(spark, [("d1", 1)]), ["metric_date"])
    held = t.read("daily", ROWS)
    V.upsert_version(t, "daily", table(spark, [("d1", 2)]), ["metric_date"])
    assert held.collect()[0].orders == 1
    for k in range(3):
        V.upsert_version(t, "daily", table(spark, [("d1", 3 + k)]), ["metric_date"])
    assert t.vacuum(["daily"], keep=2) == 3 and t.versions() == [0, 1, 2, 3, 4]
    assert t.read("daily", ROWS).collect()[0].orders == 5


def test_a_table_that_did_not_change_stays_in_its_folder(spark):
    t = V.Versions(spark, scratch_path(spark, "two"))
    for name in ("a", "b"):
        t.stage(0, name, table(spark, [(name, 0)]))
    t.commit(0, ["a", "b"], note=7)
    t.stage(1, "a", table(spark, [("a", 1)]))
    t.commit(1, ["a"])
    assert t.record()["tables"] == {"a": 1, "b": 0} and t.record()["note"] == 7
    assert t.read("b", ROWS).collect()[0].orders == 0 and t.read("c", ROWS).count() == 0
    with pytest.raises(ValueError):
        t.commit(1, ["a"])


def test_rows_of_uncommitted_versions_are_not_read(spark):
    t = V.Versions(spark, scratch_path(spark, "log"))
    t.stage(0, "log", table(spark, [("x", 1)]))
    t.commit(0, ["log"])
    t.stage(1, "log", table(spark, [("y", 2)]))
    assert [(r.metric_date, r.version) for r in t.read_all("log", ROWS).collect()] == [("x", 0)]
    t.commit(1, ["log"])
    assert {(r.metric_date, r.version) for r in t.read_all("log", ROWS).collect()} == {("x", 0), ("y", 1)}
    newest = V.newest_rows(t.read_all("log", ROWS).withColumn("metric_date", F.lit("k")), "metric_date").collect()
    assert [tuple(r) for r in newest] == [("k", 2)] and json.dumps(t.record())
