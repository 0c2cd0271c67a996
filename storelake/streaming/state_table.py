"""The order rules over a stream with a versioned state table.

``processor.py`` hands all rows of a customer in a micro-batch to one state call and never looks back.
Here a micro-batch joins a table instead, so that a customer with a third of the rows is split over tasks, and an
order that comes late still gets, and gives to its successors, the alerts that the batch rules give.

The state after version N (a micro-batch):

* ``orders``  the orders whose alerts may still change: those not older than ``cut``, the newest purchase time seen
  less ``late_within``. Each holds its previous order and its place in its session.
* ``last``  per customer the last order before ``cut``, with its place in its session: what the orders after it need
  to know. Every version adds the customers whose last order moved; every ``compact_every`` versions these
  are merged to one row a customer.
* ``alerts``  the alerts of orders older than ``cut``. They are final; every version adds its own.
* ``late``  orders that came when their time was already before ``cut``. They raise the stateless alerts only, and
  are kept here rather than lost.
* ``rejects``  messages that could not be decoded or used, with the reason; every version adds its own.

A micro-batch unites its orders with ``orders``, puts each customer's ``last`` before them, and makes the
chunked scan of :mod:`storelake.operators.sequence` once. All writes are one version (:mod:`storelake.sources.versions`):
a replayed micro-batch that had been committed does nothing, one that had not writes its folders again.

With ``late_within=None`` no order is ever late and ``orders`` grows with the stream.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from storelake.config import DEFAULT_RULES, RuleConfig
from storelake.operators import rules, sequence
from storelake.operators.sequence import RN
from storelake.sources.stream import decode_orders, rejected_messages
from storelake.sources.versions import Versions, newest_rows

ORDER = "order_id string, customer_unique_id string, customer_state string, ts timestamp_ntz, total double, detected_at timestamp_ntz"
SCANNED = f"{ORDER}, prev_customer_state string, prev_ts timestamp_ntz, gap_s bigint, {RN} bigint, session_count bigint, final boolean"
LAST = "customer_unique_id string, customer_state string, ts timestamp_ntz, order_id string, session_count bigint"
ALERT = "order_id string, type string, score double, details string, detected_at timestamp_ntz"
REJECT = "value string, reject_reason string, used boolean"
ORDER_COLUMNS = [c.split()[0] for c in ORDER.split(", ")]
LAST_COLUMNS = [c.split()[0] for c in LAST.split(", ")]
KEEP_VERSIONS = 3
CHUNK_ROWS = 2_000_000
COMPACT_EVERY = 16


def _scan(orders: DataFrame, last: DataFrame | None, cfg: RuleConfig) -> DataFrame:
    """Orders with their previous order, place and session, where ``last`` holds what went before them.

    The number of chunks goes by the rows counted: the planner can't tell the size of a micro-batch or of a join with it."""
    chunks = max(orders.sparkSession.sparkContext.defaultParallelism, -(-orders.count() // CHUNK_ROWS))
    rows = orders.withColumn("_before", F.lit(None).cast("bigint"))
    if last is not None:
        ahead = last.select(*[F.col(c) if c in LAST_COLUMNS else F.lit(None).cast("double" if c == "total" else "timestamp_ntz").alias(c)
                              for c in ORDER_COLUMNS], F.col("session_count").alias("_before"))
        rows = rows.unionByName(ahead)
    chunked = sequence.chunk_rows(rows, rules.CUSTOMER, rules.ORDER, chunks)
    seq = sequence.add_previous_and_sessions(chunked, rules.ORDER, ["customer_state", "ts"], "ts", cfg.velocity_window_seconds)
    if last is not None:
        # the first session of a customer goes on where its last order stood
        before = last.select(F.struct("customer_unique_id").alias(sequence.K), F.col("session_count").alias("_count"))
        seq = seq.join(before, on=sequence.K, how="left").withColumn("session_count", F.when(
            F.col("_count").isNotNull() & (F.col("session_count") == F.col(RN)),
            F.col("session_count") - 1 + F.col("_count")).otherwise(F.col("session_count")))
        seq = seq.filter(F.col("_before").isNull())
    return seq.withColumn("gap_s", rules.gap_seconds())


def advance(state: Versions, batch: DataFrame, version: int, cfg: RuleConfig = DEFAULT_RULES,
            late_within: timedelta | None = None, compact_every: int = COMPACT_EVERY,
            rejects: DataFrame | None = None) -> None:
    """Take a micro-batch of prepared orders (:func:`rules.prepare_orders`) into the state as ``version``, with the
    messages of the batch that were rejected."""
    if version <= state.current():
        return
    record = state.record()
    cut = record.get("cut")
    orders = batch.filter("ts_ok").select(*ORDER_COLUMNS)
    tables = ["orders", "alerts", "alerts_alone"]
    state.stage(version, "alerts_alone", rules.stateless_alerts(batch, cfg))
    if rejects is not None:
        state.stage(version, "rejects", rejects)
        tables.append("rejects")
    last = None
    waiting = state.read("orders", SCANNED).filter(~F.col("final")).select(*ORDER_COLUMNS)
    if cut is not None:
        too_late = F.col("ts") < F.lit(cut).cast("timestamp_ntz")
        state.stage(version, "late", orders.filter(too_late))
        tables.append("late")
        rows = waiting.unionByName(orders.filter(~too_late))
        known = newest_rows(state.read_all("last", LAST, since=record.get("last_since", 0)), "customer_unique_id")
        last = _of_customers(known, rows)
    else:
        rows = waiting.unionByName(orders)

    scanned = _scan(rows, last, cfg)
    if late_within is not None:
        newest = orders.agg(F.max("ts")).first()[0]
        if newest is not None:
            moved = (newest - late_within).isoformat(sep=" ")
            cut = moved if cut is None else max(cut, moved, key=datetime.fromisoformat)
    final = F.lit(False) if cut is None else F.col("ts") < F.lit(cut).cast("timestamp_ntz")
    names = [c.split()[0] for c in SCANNED.split(", ")]
    written = state.stage(version, "orders", scanned.withColumn("final", final).select(*names), ("final",))
    closed = written.filter("final")
    state.stage(version, "alerts", rules.sequence_alerts(closed, cfg))
    notes = {}
    if cut is not None:
        moved = closed.groupBy("customer_unique_id").agg(F.max_by(F.struct(*LAST_COLUMNS[1:]), F.struct("ts", "order_id")).alias("r")) \
            .select("customer_unique_id", "r.*")
        if version - record.get("last_since", 0) >= compact_every:
            older = state.read_all("last", LAST, since=record.get("last_since", 0))
            moved = newest_rows(older.unionByName(moved.withColumn("version", F.lit(version))), "customer_unique_id")
            notes["last_since"] = version
        state.stage(version, "last", moved)
        tables.append("last")
        notes["cut"] = cut
    state.commit(version, tables, **notes)
    state.vacuum(["orders"], KEEP_VERSIONS)


def _of_customers(known: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows of ``known`` whose customer is among those of ``rows``; a null customer is one, like any other."""
    asked = rows.select(F.struct("customer_unique_id").alias(sequence.K)).distinct()
    return known.withColumn(sequence.K, F.struct("customer_unique_id")).join(asked, sequence.K, "left_semi").drop(sequence.K)


def alerts(state: Versions, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """All alerts as of the newest version: the final ones, those of the orders that may still change, and the
    stateless ones."""
    open_ = rules.sequence_alerts(state.read("orders", SCANNED).filter(~F.col("final")), cfg)
    done = [state.read_all(t, ALERT).drop("version") for t in ("alerts", "alerts_alone")]
    return open_.unionByName(done[0]).unionByName(done[1])


def late_orders(state: Versions) -> DataFrame:
    """Orders that came too late for the stateful rules."""
    return state.read_all("late", ORDER)


def rejects(state: Versions) -> DataFrame:
    """Messages that could not be decoded or used."""
    return state.read_all("rejects", REJECT)


def start_alert_tables(raw: DataFrame, root: str, checkpoint: str, trigger: str | None = "10 seconds",
                       cfg: RuleConfig = DEFAULT_RULES, late_within: timedelta | None = timedelta(days=2),
                       compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Keep the alert tables under ``root`` up to date with a stream of raw order messages; read them with
    :func:`alerts`. Every micro-batch is decoded once."""
    from storelake.streaming.jobs import _trigger
    state = Versions(raw.sparkSession, root)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_orders(batch).persist()
        try:
            advance(state, rules.prepare_orders(decoded), batch_id, cfg, late_within, compact_every, rejected_messages(decoded))
        finally:
            decoded.unpersist()

    w = raw.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()
