"""The six order-anomaly rules in batch form.

Input is the parsed order stream (:func:`storelake.sources.stream.parse_orders`).
The per-customer rules follow the order of (purchase time, order id) inside each
customer -- the stream processes a customer's orders in that order too
(:mod:`storelake.streaming.processor`), so stream and batch agree on
time-ordered input.

* amount            total > 3000
* off_hours         1 <= hour < 5 and total > 1000
* freight_mismatch  first item's freight > 100
* first_order_high_value  the customer's first order has total > 500
* geo_velocity      previous order of the customer < 4 h earlier, from a
                    different state, and the two states are a far pair
* velocity          more than 5 orders in a session whose gaps are < 1 h

Orders whose purchase time cannot be parsed take part in ``amount`` only
(``off_hours`` needs the hour) and are invisible to the customer state.
Each alert is ``(order_id, type, score, details, detected_at)``. ``detected_at``
is the order's purchase time, so reruns give the same rows; an order whose time
can't be parsed is stamped with ``as_of``, the time at which it was looked at, so
that its alerts are among the newest instead of last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.config import ALERT_SCORE, DEFAULT_RULES, RuleConfig
from storelake.functions import text
from storelake.functions.dates import parse_wire_ts, seconds_between
from storelake.functions.numeric import zero_if_null
from storelake.operators import sequence
from storelake.sources.sinks import materialize
from storelake.sources.stream import parse_orders, valid_orders

CUSTOMER = ["customer_unique_id"]
ORDER = ["ts", "order_id"]
ALERT_COLUMNS = ["order_id", "type", "score", "details", "detected_at"]
RULE_TYPES = ("geo_velocity", "first_order_high_value", "velocity", "freight_mismatch",
              "amount", "off_hours")


def prepare_orders(parsed: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Valid orders with the columns the rules read (T7 gate included).

    ``as_of`` is the detection time of orders without a readable time: the
    present time unless given.
    """
    if as_of is None:
        as_of = F.current_timestamp()
    ts = parse_wire_ts("order_purchase_timestamp")
    return valid_orders(parsed).select(
        "order_id", "customer_unique_id", "customer_state",
        ts.alias("ts"), F.coalesce(ts, as_of.cast("timestamp_ntz")).alias("detected_at"),
        F.col("total_payment_value").alias("total"),
        zero_if_null(F.get(F.col("items"), 0)["freight_value"]).alias("first_freight"),
    ).withColumns({"purchase_hour": F.hour("ts"), "ts_ok": F.col("ts").isNotNull()})


def _alert(df: DataFrame, typ: str, details: Column) -> DataFrame:
    return df.select(
        F.col("order_id"), F.lit(typ).alias("type"), F.lit(ALERT_SCORE).alias("score"),
        details.alias("details"), "detected_at")


def _alerts_in_one_pass(df: DataFrame, checks: list[tuple[str, Column, Column]]) -> DataFrame:
    """Several rules over the same rows in one pass: each row yields the
    alerts whose condition holds (an array of structs, exploded)."""
    hits = F.array(*[F.when(cond, F.struct(F.lit(t).alias("type"), det.alias("details")))
                     for t, cond, det in checks])
    return (df.select("order_id", "detected_at", F.explode(F.filter(hits, lambda a: a.isNotNull())).alias("a"))
            .select("order_id", F.col("a.type").alias("type"), F.lit(ALERT_SCORE).alias("score"),
                    F.col("a.details").alias("details"), "detected_at"))


def _amount(cfg):
    return ("amount", F.col("total") > cfg.amount_high_value,
            text.amount_detail("total", cfg.amount_high_value))


def _off_hours(cfg):
    return ("off_hours", (F.col("purchase_hour") >= cfg.off_hours_start)
            & (F.col("purchase_hour") < cfg.off_hours_end) & (F.col("total") > cfg.off_hours_high_value),
            text.off_hours_detail("purchase_hour", "total"))


def _freight(cfg):
    return ("freight_mismatch", F.col("ts_ok") & (F.col("first_freight") > cfg.freight_limit),
            text.freight_detail("first_freight"))


def amount_alerts(orders: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    typ, cond, det = _amount(cfg)
    return _alert(orders.filter(cond), typ, det)


def off_hours_alerts(orders: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    typ, cond, det = _off_hours(cfg)
    return _alert(orders.filter(cond), typ, det)


def freight_alerts(orders: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    typ, cond, det = _freight(cfg)
    return _alert(orders.filter(cond), typ, det)


def stateless_alerts(orders: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """amount, off_hours and freight_mismatch in one pass over the orders."""
    return _alerts_in_one_pass(orders, [_freight(cfg), _amount(cfg), _off_hours(cfg)])


def first_order_alerts(orders: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """A customer's first (parsable) order above the limit; later orders never alert."""
    first = sequence.first_per_key(orders.filter("ts_ok"), CUSTOMER, ORDER,
                                   ["order_id", "detected_at", "total"])
    hit = first.filter(F.coalesce(F.col("total"), F.lit(0.0)) > cfg.first_order_high_value)
    return _alert(hit, "first_order_high_value",
                  text.first_order_detail("total", cfg.first_order_high_value))


def customer_sequence(orders: DataFrame, cfg: RuleConfig = DEFAULT_RULES,
                      num_chunks: int | None = None) -> DataFrame:
    """Parsable orders with the customer's previous state/time, the gap in
    seconds and the position inside the current velocity session."""
    narrow = orders.filter("ts_ok").select("order_id", "customer_unique_id", "customer_state", "ts", "detected_at")
    c = sequence.chunk_rows(narrow, CUSTOMER, ORDER, num_chunks)
    c = sequence.add_previous_and_sessions(c, ORDER, ["customer_state", "ts"], "ts",
                                           cfg.velocity_window_seconds)
    return c.withColumn("gap_s", gap_seconds())


def gap_seconds() -> Column:
    """Seconds since the customer's previous order."""
    return seconds_between("ts", "prev_ts")


def _pair_key(a: Column, b: Column) -> Column:
    return F.concat(F.least(a, b), F.lit("|"), F.greatest(a, b))


def _geo(cfg):
    far = F.array(*[F.lit(k) for k in cfg.far_pair_keys()])
    st, prev = F.col("customer_state"), F.col("prev_customer_state")
    cond = (prev.isNotNull() & (prev != F.lit("")) & F.col("prev_ts").isNotNull()
            & (F.abs(F.col("gap_s")) < cfg.geo_time_hours * 3600)
            & (st != prev)
            & F.array_contains(far, _pair_key(st, prev)))
    return "geo_velocity", cond, text.geo_detail(prev, st, "gap_s")


def _velocity(cfg):
    return ("velocity", F.col("session_count") > cfg.velocity_limit,
            text.velocity_detail("session_count"))


def _first_order(cfg):
    return ("first_order_high_value", (F.col(sequence.RN) == 1) & (F.coalesce(F.col("total"), F.lit(0.0)) > cfg.first_order_high_value),
            text.first_order_detail("total", cfg.first_order_high_value))


def sequence_alerts(seq: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """geo_velocity, first_order_high_value and velocity in one pass over customer sequences that carry
    the order's ``total``."""
    return _alerts_in_one_pass(seq, [_geo(cfg), _first_order(cfg), _velocity(cfg)])


def geo_alerts_from(seq: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    typ, cond, det = _geo(cfg)
    return _alert(seq.filter(cond), typ, det)


def velocity_alerts_from(seq: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    typ, cond, det = _velocity(cfg)
    return _alert(seq.filter(cond), typ, det)


def geo_alerts(orders: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    return geo_alerts_from(customer_sequence(orders, cfg), cfg)


def velocity_alerts(orders: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    return velocity_alerts_from(customer_sequence(orders, cfg), cfg)


def all_alerts(orders: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """Every alert of the six rules; an order may raise several (one row per type).

    Three passes: the stateless rules over the orders, geo_velocity and
    velocity over the one customer sequence, and the first-order aggregate.
    """
    seq = _alerts_in_one_pass(customer_sequence(orders, cfg), [_geo(cfg), _velocity(cfg)])
    parts = [seq, first_order_alerts(orders, cfg), stateless_alerts(orders, cfg)]
    return reduce(DataFrame.unionByName, parts)


def alerts_of_messages(raw: DataFrame, as_of: Column | None = None, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """Every alert of raw order messages. They are decoded once, into a narrow table in the shared folder, from
    which the three passes of :func:`all_alerts` read."""
    return all_alerts(materialize(prepare_orders(parse_orders(raw), as_of), "prepared-orders"), cfg)
