"""The list of the newest alerts and the alert counts, kept up to date by a stream.

The list after a micro-batch is the newest ``keep`` of the list before it and the batch's alerts: a top-k that merges, so a
batch costs what it brings and never the alerts of all days. Each task keeps ``keep`` rows of its part, and those
are merged. List and counts of a batch are one version (:mod:`storelake.sources.versions`), so a repeated
micro-batch neither doubles a count nor loses an alert.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from storelake.config import DEFAULT_RULES, RECENT_ALERTS_KEPT, RuleConfig
from storelake.operators.serving import alert_order
from storelake.sources.versions import Versions
from storelake.streaming.state_table import ALERT

COUNTS = "type string, alerts bigint"


def advance_list(state: Versions, alerts: DataFrame, version: int, keep: int = RECENT_ALERTS_KEPT) -> None:
    """Take a micro-batch of alerts into the list as ``version``."""
    if version <= state.current():
        return
    columns = [c.split()[0] for c in ALERT.split(", ")]
    alerts = alerts.select(columns).persist()
    try:
        merged = state.read("newest", ALERT).unionByName(alerts.orderBy(*alert_order()).limit(keep))
        state.stage(version, "newest", merged.orderBy(*alert_order()).limit(keep))
        state.stage(version, "counts", alerts.groupBy("type").agg(F.count(F.lit(1)).alias("alerts")))
        state.commit(version, ["newest", "counts"])
        state.vacuum(["newest"])
    finally:
        alerts.unpersist()


def newest_alerts(state: Versions) -> DataFrame:
    return state.read("newest", ALERT).orderBy(*alert_order())


def batch_counts(state: Versions) -> DataFrame:
    """(batch, type, alerts): what every micro-batch raised; a rule that raised nothing has no row."""
    return state.read_all("counts", COUNTS).select(F.col("version").alias("batch"), "type", "alerts")


def start_alert_list(raw: DataFrame, root: str, checkpoint: str, trigger: str | None = "10 seconds",
                     cfg: RuleConfig = DEFAULT_RULES, keep: int = RECENT_ALERTS_KEPT,
                     state: Versions | None = None) -> StreamingQuery:
    """Run the six rules over a stream of order messages and keep list and counts under ``root``."""
    from storelake.streaming.jobs import _trigger, alert_stream, ensure_rocksdb_state
    ensure_rocksdb_state(raw.sparkSession)
    state = state or Versions(raw.sparkSession, root)
    per_batch: Callable[[DataFrame, int], None] = lambda batch, batch_id: advance_list(state, batch, batch_id, keep)
    w = (alert_stream(raw, cfg).writeStream.outputMode("append").foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()
