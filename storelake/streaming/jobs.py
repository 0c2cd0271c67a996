"""Streaming queries.

``source -> parse -> rule columns -> (a) stateless alerts; (b) per-customer
stateful alerts -> union -> sink``; fact rows and running daily totals go
through ``foreachBatch`` into batch-keyed (replay-safe) tables. The driver
never sees rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from storelake.config import DEFAULT_RULES, RuleConfig
from storelake.operators import rules
from storelake.operators.stream_facts import batch_increments, stream_fact_rows
from storelake.sources.sinks import write_batch
from storelake.sources.stream import parse_orders
from storelake.streaming.processor import customer_alerts


def alert_stream(raw: DataFrame, cfg: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """All six rules over a stream of raw order messages (``value`` column)."""
    orders = rules.prepare_orders(parse_orders(raw))
    return rules.stateless_alerts(orders, cfg).unionByName(customer_alerts(orders, cfg))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ensure_rocksdb_state(spark: SparkSession) -> None:
    """transformWithState keeps its state in several column families, which
    only the RocksDB state store supports; select it unless a session already
    did (the provider is fixed in a query's checkpoint at its first start)."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, "") != ROCKSDB:
        spark.conf.set(key, ROCKSDB)


def _trigger(writer, trigger: str | None):
    if trigger in (None, "availableNow"):
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def start_alerts(raw: DataFrame, out_path: str, checkpoint: str,
                 trigger: str | None = "10 seconds", cfg: RuleConfig = DEFAULT_RULES) -> StreamingQuery:
    """Append alerts to a Parquet table.

    A micro-batch holds all its rows of a customer in one state call, so bound
    it at the source after a backlog: ``maxOffsetsPerTrigger`` for a topic,
    ``maxFilesPerTrigger`` for files.

    Each micro-batch reports its alert count per rule type as observed
    metrics (A13): ``query.lastProgress["observedMetrics"]["batch_alerts"]``.
    """
    from pyspark.sql import functions as F
    ensure_rocksdb_state(raw.sparkSession)
    counts = [F.count(F.when(F.col("type") == t, 1)).alias(t) for t in rules.RULE_TYPES]
    alerts = alert_stream(raw, cfg).observe("batch_alerts", F.count(F.lit(1)).alias("alerts"), *counts)
    w = (alerts.writeStream.format("parquet").outputMode("append")
         .option("path", out_path).option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def start_facts(raw: DataFrame, fact_path: str, increments_path: str, checkpoint: str,
                trigger: str | None = "10 seconds", written=None) -> StreamingQuery:
    """Fact rows (T8) and the day totals each batch adds (T9) via foreachBatch.

    Both writes are keyed by the batch id, so a replayed batch replaces its
    own output instead of appending it again (at-least-once made idempotent).
    ``written(table, batch_id)`` is called after each write, when the batch isn't
    yet marked as done in the checkpoint.
    """
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        facts = stream_fact_rows(parse_orders(batch)).persist()
        try:
            write_batch(facts, fact_path, batch_id)
            written and written("facts", batch_id)
            inc = batch_increments(facts.withColumn("batch_id", _lit(batch_id)))
            write_batch(inc.drop("batch_id"), increments_path, batch_id)
            written and written("increments", batch_id)
        finally:
            facts.unpersist()

    w = raw.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def _lit(v):
    from pyspark.sql import functions as F
    return F.lit(int(v))


def read_text_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """File-based order stream (one JSON message per line) for tests and replays."""
    from storelake.sources.stream import read_order_stream
    opts = {"maxFilesPerTrigger": files_per_trigger} if files_per_trigger else {}
    return read_order_stream(spark, "text", path=path, **opts)


def replay(spark: SparkSession, events: DataFrame, path: str, start, steps: int = 4,
           customer_buckets: int | None = None, late_every: int | None = None, attempts: int = 1) -> None:
    """Feed ``events`` to a streaming query in ``steps`` arrivals, in event id order; of every ``late_every``
    events one arrives a step later.

    Each step writes its messages to ``path`` (range-partitioned, one file a task) and
    runs ``start(stream)`` until it has taken them, starting a failed query again up to
    ``attempts`` times; the query's checkpoint carries the
    state from step to step. Every event is written exactly once."""
    from pyspark.sql import functions as F
    from storelake.sources.bindings import order_struct
    lo, hi = events.agg(F.min("event_id"), F.max("event_id")).first()
    if lo is None:
        return
    span = hi - lo + 1
    for i in range(steps):
        a, b = lo + span * i // steps, lo + span * (i + 1) // steps
        due = (F.col("event_id") >= a) & (F.col("event_id") < b)
        if late_every:
            late = F.col("event_id") % late_every == 0
            before = lo + span * max(i - 1, 0) // steps
            due = due & (~late | F.lit(i == steps - 1)) | late & (F.col("event_id") >= before) & (F.col("event_id") < a)
        part = events.filter(due).repartitionByRange("event_id")
        (part.select(F.to_json(order_struct(part, customer_buckets)).alias("value"))
             .write.mode("append").text(path))
        until_done(lambda: start(read_text_stream(spark, path)), attempts)


def until_done(start, attempts: int = 3) -> int:
    """Start a query again, from its checkpoint, when it fails; returns how many attempts it took."""
    from pyspark.errors import StreamingQueryException
    for k in range(1, attempts + 1):
        try:
            start().awaitTermination()
            return k
        except StreamingQueryException:
            if k == attempts:
                raise
    return attempts


def daily_totals_stream(raw: DataFrame, dedupe_within: str | None = None) -> DataFrame:
    """Running day totals as a streaming aggregate (T9), in update mode.

    Keyed by the order's own date; the state is one row per day, so it needs no
    watermark, and an order counts however late it comes.

    ``dedupe_within`` drops redelivered order items that come within that time
    of the first delivery. This needs a watermark, by which Spark forgets old
    items: orders later than it are then not counted.
    """
    from pyspark.sql import functions as F
    from storelake.functions.numeric import money
    facts = stream_fact_rows(parse_orders(raw)).filter(F.col("order_purchase_timestamp").isNotNull())
    if dedupe_within:
        facts = (facts.withColumn("event_ts", F.col("order_purchase_timestamp").cast("timestamp"))
                 .withWatermark("event_ts", dedupe_within)
                 .dropDuplicatesWithinWatermark(["order_id", "order_item_id"]))
    return (facts.groupBy(F.to_date("order_purchase_timestamp").alias("metric_date"))
            .agg(F.count(F.lit(1)).alias("orders"),
                 F.sum(money("price") + money("freight_value")).cast("decimal(28,2)").cast("double").alias("revenue")))


def start_daily_totals(raw: DataFrame, table_path: str, checkpoint: str,
                       trigger: str | None = "10 seconds",
                       dedupe_within: str | None = None) -> StreamingQuery:
    """Upsert the changed days into a table partitioned by ``metric_date``:
    each micro-batch overwrites exactly the partitions of the days it updated
    (a keyed upsert; replaying a batch writes the same rows again)."""
    def per_batch(batch: DataFrame, batch_id: int) -> None:
        (batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy("metric_date").parquet(table_path))

    w = (daily_totals_stream(raw, dedupe_within).writeStream.outputMode("update")
         .foreachBatch(per_batch).option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()
