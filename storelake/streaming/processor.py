"""Per-customer state for the three stateful rules (T2-T4) as one
``transformWithState`` processor.

State (one value per customer, in the RocksDB state store on the executors):
last state and purchase time (geo_velocity), whether the customer was seen
(first_order_high_value) and the order count of the current session with its
last time (velocity). A customer's rows in a micro-batch are processed in
(purchase time, order id) order, row by row: a customer has few, and a data frame a
customer costs more than all its rules. The state carries the sequence into the next micro-batch.

Late rows (older than what an earlier micro-batch brought) never move the state
back. Velocity: a row within the window before the session's last time counts in
that session; an older one neither extends nor restarts it and raises nothing.
geo_velocity: a late row is compared with the stored last order, and the rows
after it with the newer of their predecessor and that order.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal
from typing import Iterator

import pandas as pd
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import (BooleanType, IntegerType, LongType, StringType,
                               StructField, StructType)

from storelake import schemas
from storelake.config import ALERT_SCORE, DEFAULT_RULES, RuleConfig

STATE = StructType([
    StructField("last_state", StringType()), StructField("last_ts", LongType()),
    StructField("seen", BooleanType()), StructField("count", IntegerType()),
    StructField("count_ts", LongType()),
])
EPOCH, SECOND = datetime(1970, 1, 1), timedelta(seconds=1)
INPUT_COLUMNS = ["order_id", "customer_unique_id", "customer_state", "ts", "total"]


def _whole(x: float) -> str:
    return str(int(Decimal(repr(float(x))).quantize(Decimal(1), rounding=ROUND_HALF_UP)))


def _tenths(seconds: int) -> str:
    t = (abs(int(seconds)) + 180) // 360
    return f"{t // 10}.{t % 10}"


class CustomerRowsProcessor(StatefulProcessor):
    """Emits geo_velocity, first_order_high_value and velocity alerts."""

    def __init__(self, cfg: RuleConfig = DEFAULT_RULES):
        self.cfg = cfg
        self.far = set(cfg.far_pair_keys())

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("customer", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        for order_id, typ, details, ts in self.alerts([(r["ts"], r["order_id"], r["customer_state"], r["total"]) for r in rows]):
            yield Row(order_id=order_id, type=typ, score=ALERT_SCORE, details=details, detected_at=ts)

    def alerts(self, rows: list[tuple]) -> list[tuple]:
        """(order_id, type, details, time) of a customer's (time, order_id, state, total); moves the state on."""
        rows = sorted((r for r in rows if r[0] is not None), key=lambda r: r[:2])
        if not rows:
            return []
        cfg = self.cfg
        stored = self.state.get() or (None, None, False, 0, None)       # one call to the state server, not two
        last_state, last_ts, seen, count, count_ts = stored
        before_state, before_ts, velocity_ts = last_state, last_ts, count_ts
        out = []
        for time, order_id, state, total in rows:
            ts = (time - EPOCH) // SECOND

            # geo_velocity: against the predecessor, or the stored order where that is newer
            if last_ts is not None and before_ts < last_ts:
                before_state, before_ts = last_state, last_ts
            if before_ts is not None and before_state and state is not None and state != before_state:
                gap = ts - before_ts
                if abs(gap) < cfg.geo_time_hours * 3600 and "|".join(sorted((state, before_state))) in self.far:
                    out.append((order_id, "geo_velocity", f"State jump {before_state}->{state} in {_tenths(gap)}h", time))
            before_state, before_ts = state, ts

            # first_order_high_value: only the customer's first order ever
            if not seen:
                seen, total = True, total or 0.0
                if total > cfg.first_order_high_value:
                    out.append((order_id, "first_order_high_value", f"First order {_whole(total)} exceeds {cfg.first_order_high_value:g}", time))

            # velocity: a session ends where the gap reaches the window; rows too old for the stored one stay out
            if count_ts is None or ts > count_ts - cfg.velocity_window_seconds:
                since = velocity_ts if count_ts is None else max(velocity_ts, count_ts)
                count = 1 if since is None or ts - since >= cfg.velocity_window_seconds else count + 1
                velocity_ts = ts
                if count > cfg.velocity_limit:
                    out.append((order_id, "velocity", f"{count} orders in 1 hour", time))

        if last_ts is None or before_ts >= last_ts:
            last_state, last_ts = before_state, before_ts
        if count_ts is not None:
            velocity_ts = max(velocity_ts, count_ts)
        self.state.update((last_state, last_ts, True, count, velocity_ts))
        return out

    def close(self) -> None:
        pass


class CustomerRulesProcessor(CustomerRowsProcessor):
    """The same over data frames, as ``transformWithStateInPandas`` hands them over."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        given = [r for df in rows for r in zip(*(df[c].astype(object).where(df[c].notna(), None)
                                                 for c in ("ts", "order_id", "customer_state", "total")))]
        out = self.alerts(given)
        if out:
            res = pd.DataFrame(out, columns=["order_id", "type", "details", "detected_at"])
            res.insert(2, "score", ALERT_SCORE)
            yield res


def customer_alerts(orders, cfg: RuleConfig = DEFAULT_RULES):
    """Stateful alerts of a (streaming or batch) prepared-orders DataFrame."""
    return (orders.filter("ts_ok").select(*INPUT_COLUMNS)
            .groupBy("customer_unique_id")
            .transformWithState(
                statefulProcessor=CustomerRowsProcessor(cfg),
                outputStructType=schemas.ALERT,
                outputMode="Append",
                timeMode="None"))
