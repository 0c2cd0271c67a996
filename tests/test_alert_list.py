"""The newest-alerts list and the batch counts, batch by batch; streams that are lost and started again."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest

from conftest import SF_SMALL
from storelake.operators.serving import kept_alerts
from storelake.plans.registry import QUERIES, _fails_once, _Lost
from storelake.session import scratch_path
from storelake.sources.versions import Versions
from storelake.streaming import alert_list as L

ALERT = "order_id string, type string, score double, details string, detected_at timestamp_ntz"


def alerts(spark, seed, n):
    g = random.Random(seed)
    rows = [(f"o{g.randint(0, 999)}", g.choice(["amount", "velocity"]), 1.0, "d", datetime(2024, 1, 1) + timedelta(minutes=g.randint(0, 90)))
            for _ in range(n)] + [(f"n{seed}", "amount", 1.0, "no time", None)]
    return rows, spark.createDataFrame(rows, ALERT)


def test_list_and_counts_equal_the_batch_view_after_each_batch(spark):
    state, seen = Versions(spark, scratch_path(spark, "list")), []
    for v in range(4):
        rows, df = alerts(spark, v, 150 if v != 2 else 0)
        L.advance_list(state, df, v, keep=60)
        L.advance_list(state, df, v, keep=60)                   # delivered twice
        seen += rows
        want = [tuple(r) for r in kept_alerts(spark.createDataFrame(seen, ALERT)).limit(60).collect()]
        assert [tuple(r) for r in L.newest_alerts(state).collect()] == want
        assert Counter({r.type: r.alerts for r in L.batch_counts(state).filter(f"batch = {v}").collect()}) == Counter(r[1] for r in rows)
    assert L.batch_counts(state).agg({"alerts": "sum"}).first()[0] == len(seen)


def test_a_lost_batch_leaves_list_and_counts_as_they_were(spark, monkeypatch):
    state = Versions(spark, scratch_path(spark, "list"))
    _, first = alerts(spark, 1, 20)
    L.advance_list(state, first, 0, keep=10)
    before = L.newest_alerts(state).collect(), sorted(L.batch_counts(state).collect())
    lost = _fails_once([(1,)])
    real = Versions.commit

    def commit(self, version, tables, **notes):
        lost(version)
        real(self, version, tables, **notes)

    monkeypatch.setattr(Versions, "commit", commit)
    _, second = alerts(spark, 2, 20)
    with pytest.raises(_Lost):
        L.advance_list(state, second, 1, keep=10)
    assert (L.newest_alerts(state).collect(), sorted(L.batch_counts(state).collect())) == before
    L.advance_list(state, second, 1, keep=10)
    assert L.newest_alerts(state).count() == 10 and L.batch_counts(state).agg({"alerts": "sum"}).first()[0] == 42


def test_a_restarted_stream_gives_what_an_uninterrupted_one_gives(spark):
    a = {tuple(r) for r in QUERIES["stream_daily_metrics_restarted"](spark, SF_SMALL).collect()}
    b = {tuple(r) for r in QUERIES["daily_metrics_from_kv"](spark, SF_SMALL).collect()}
    assert a == b and a


def test_a_query_that_keeps_failing_is_given_up(spark, tmp_path):
    from pyspark.errors import StreamingQueryException

    from storelake.streaming.jobs import read_text_stream, start_facts, until_done
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"order_id": "1", "customer_id": "c", "items": [{"price": 1.0, "freight_value": 1.0}]}')
    tries = []

    def fail(*_):
        tries.append(1)
        raise RuntimeError("always")

    def start():
        return start_facts(read_text_stream(spark, str(tmp_path / "in")), str(tmp_path / "f"), str(tmp_path / "i"),
                           str(tmp_path / "c"), "availableNow", written=fail)
    with pytest.raises(StreamingQueryException):
        until_done(start, 2)
    assert len(tries) == 2
