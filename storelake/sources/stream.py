"""Order stream source and message parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from storelake import schemas


def read_order_stream(spark: SparkSession, fmt: str = "kafka", **options) -> DataFrame:
    """Streaming source of raw order messages with a ``value`` column.

    ``fmt="kafka"`` needs the Kafka connector on the classpath (for Spark 4.1
    the Scala 2.13 artifact); e.g. ``kafka_bootstrap_servers``, ``subscribe``,
    ``startingOffsets="latest"``. ``fmt="text"`` reads JSON lines from a
    folder (``path=...``), which is what the tests use.
    """
    r = spark.readStream.format(fmt)
    path = options.pop("path", None)
    for k, v in options.items():
        # Python keywords cannot hold dots: kafka_bootstrap_servers -> kafka.bootstrap.servers
        r = r.option(k.replace("_", ".") if k.startswith("kafka_") else k, v)
    df = r.load(path) if path else r.load()
    return df.select(F.col("value").cast("string").alias("value"))


CORRUPT = "_corrupt"


def decode_orders(raw: DataFrame) -> DataFrame:
    """Every message decoded once: the declared order columns, the message (``value``), and ``reject_reason``.

    The decoded struct comes out of a generator, which the optimizer evaluates once a row; as a plain projection it would
    be copied into every column and filter that reads a field. A message that is no JSON object gives nulls.

    ``reject_reason`` is null for a sound message; else ``malformed`` (no JSON object, or cut short), ``no_order_id``,
    ``no_customer_id`` (the rules and facts leave these out), or ``bad_field`` (a field doesn't fit its type and is null;
    the order is used all the same).
    """
    record = StructType([*schemas.ORDER_MESSAGE.fields, StructField(CORRUPT, StringType())])
    value = F.col("value").cast("string")
    decoded = F.from_json(value, record, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    d = raw.select(value.alias("value"), F.inline(F.array(decoded)))
    reason = (F.when(F.col("order_id").isNull() & (F.col(CORRUPT).isNotNull() | F.col("value").isNull() | (F.trim("value") == "")),
                     F.lit("malformed"))
              .when(F.col("order_id").isNull(), F.lit("no_order_id"))
              .when(F.col("customer_id").isNull(), F.lit("no_customer_id"))
              .when(F.col(CORRUPT).isNotNull(), F.lit("bad_field")))
    return d.withColumn("reject_reason", reason).drop(CORRUPT)


def parse_orders(raw: DataFrame) -> DataFrame:
    """Decode message text to the declared order columns.

    Malformed JSON yields a row of nulls; it is removed with the other
    invalid rows by :func:`valid_orders`, and :func:`rejected_messages` gives it back.
    """
    return decode_orders(raw).select(schemas.ORDER_MESSAGE.names)


def rejected_messages(decoded: DataFrame) -> DataFrame:
    """The reject table: messages that can't be used as they are, with the reason; ``used`` tells those of which
    only a field was lost."""
    return decoded.filter(F.col("reject_reason").isNotNull()).select(
        "value", "reject_reason", (F.col("reject_reason") == "bad_field").alias("used"))


def valid_orders(parsed: DataFrame) -> DataFrame:
    """Orders with an id and a customer."""
    return parsed.filter(F.col("order_id").isNotNull() & F.col("customer_id").isNotNull())
