"""Bindings of the driver's test tables to the retail schema.

The retail jobs read order, item, payment, product, customer and seller
extracts. The test data is a TPC-H-like star schema, so each bronze table is
*derived* from it by a fixed rule (documented in FIXTURES.md). Every binding
is a lazy projection/join over the whole source table, so all downstream work
grows with the data.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake import schemas
from storelake.operators.joins import broadcast_if_small

# Fixed values of the stream binding: the state codes an event is mapped to,
# indexed by (event_id * 7 + user_id) mod 13.
STREAM_STATES = ("SP", "RJ", "MG", "RS", "PR", "BA", "PE", "CE", "AM", "PA", "AC", "RR", "AP")


def _conform(df: DataFrame, name: str) -> DataFrame:
    """Cast to the declared bronze schema, in declared column order."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name)
                      for f in schemas.BRONZE[name].fields])


def _add_hours(ts: Column, n: Column) -> Column:
    return F.timestamp_add("HOUR", n, ts)


def _add_days(ts: Column, n: Column) -> Column:
    return F.timestamp_add("DAY", n, ts)


class Bronze:
    """Bronze-shaped DataFrames over a :class:`~storelake.sources.tables.Tables`."""

    def __init__(self, tables):
        self.t = tables

    @cached_property
    def orders(self) -> DataFrame:
        o = self.t.orders
        return _conform(o.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            _add_hours(F.col("o_orderdate"), F.col("o_orderkey") % 24).alias("order_purchase_timestamp"),
            F.when(F.col("o_orderstatus") == "O", F.lit(None))
             .otherwise(_add_days(F.col("o_orderdate"), F.col("o_orderkey") % 20 + 2))
             .alias("order_delivered_customer_date"),
            _add_days(F.col("o_orderdate"), F.col("o_custkey") % 25 + 7).alias("order_estimated_delivery_date"),
        ), "orders")

    @cached_property
    def order_items(self) -> DataFrame:
        li = self.t.lineitem
        return _conform(li.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("seller_id"),
            F.col("l_extendedprice").alias("price"),
            (F.col("l_quantity") * F.lit(1.5)).alias("freight_value"),
        ), "order_items")

    @cached_property
    def payments(self) -> DataFrame:
        """Some orders have no payment row and every fifth paying order two."""
        o = self.t.orders.select("o_orderkey", "o_totalprice")
        paying = o.filter(F.col("o_orderkey") % 17 != 0)
        first = paying.select(
            F.col("o_orderkey").alias("order_id"), F.lit(1).alias("payment_sequential"),
            (F.col("o_orderkey") % 12 + 1).alias("payment_installments"),
            F.col("o_totalprice").alias("payment_value"))
        second = paying.filter(F.col("o_orderkey") % 5 == 0).select(
            F.col("o_orderkey").alias("order_id"), F.lit(2).alias("payment_sequential"),
            F.lit(1).alias("payment_installments"), F.lit(10.0).alias("payment_value"))
        return _conform(first.unionByName(second), "payments")

    @cached_property
    def products(self) -> DataFrame:
        p = self.t.part
        return _conform(p.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            F.when(F.col("p_partkey") % 50 == 0, F.lit(None))
             .otherwise(F.col("p_size") * 100).alias("product_weight_g"),
            F.col("p_size").alias("product_length_cm"),
            (F.col("p_size") % 10 + 5).alias("product_height_cm"),
            (F.col("p_size") % 7 + 3).alias("product_width_cm"),
            (F.col("p_partkey") % 6).alias("product_photos_qty"),
            F.length("p_name").alias("product_name_lenght"),
            (F.col("p_partkey") % 499).alias("product_description_lenght"),
        ), "products")

    @cached_property
    def category_translation(self) -> DataFrame:
        """One English name per category; PROMO is left out so lookups can miss."""
        return _conform(self.t.part.select("p_type")
                        .filter(F.col("p_type") != "PROMO").distinct()
                        .select(F.col("p_type").alias("product_category_name"),
                                F.lower("p_type").alias("category_english")),
                        "category_translation")

    @cached_property
    def nations(self) -> DataFrame:
        """Nation names, broadcast once their size is checked (25 in TPC-H)."""
        return broadcast_if_small(self.t.nation.select("n_nationkey", "n_name"))

    @cached_property
    def customers(self) -> DataFrame:
        n = self.nations
        c = self.t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
        return _conform(c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("n_name").alias("customer_state"),
            F.col("c_mktsegment").alias("customer_city")), "customers")

    @cached_property
    def sellers(self) -> DataFrame:
        n = self.nations
        s = self.t.supplier.select("s_suppkey", "s_nationkey")
        return _conform(s.join(n, s.s_nationkey == n.n_nationkey, "left").select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("n_name").alias("seller_state"),
            F.col("n_name").alias("seller_city")), "sellers")

    def order_stream(self, customer_buckets: int | None = None) -> DataFrame:
        """The order stream already decoded: the declared message columns,
        exactly what :func:`~storelake.sources.stream.parse_orders` yields for
        :meth:`order_messages` (the batch twin needs no JSON round trip).

        Built as flat, already-typed columns so Catalyst can push each
        filter down as the one column expression it reads."""
        e = self.t.events
        return e.select([c.alias(n) for n, c in order_columns(customer_buckets).items()])

    def order_messages(self, customer_buckets: int | None = None, bad_rows: bool = False, malformed: bool = False) -> DataFrame:
        """The order stream as the topic carries it: one JSON text per order.

        Each event becomes one order with one item. ``customer_buckets`` folds
        users into that many customers (a denser stream per customer).
        ``bad_rows`` makes some orders bad or larger by rule: every 97th has an
        unreadable time, every 53rd no state, every 31st no items; of the rest
        every 10th has two items and every 20th three, the later ones without
        freight. ``malformed`` spoils messages: every 89th is cut short, every 71st lacks its customer, every 61st
        has a text for its total.
        """
        e = self.t.events
        cols = order_columns(customer_buckets)
        if bad_rows:
            cols = with_bad_rows(cols)
        if malformed:
            cols["customer_id"] = F.when(F.col("event_id") % 71 != 0, cols["customer_id"])
        text = F.to_json(F.struct(*[c.alias(n) for n, c in cols.items()]))
        if malformed:
            text = (F.when(F.col("event_id") % 89 == 0, F.substr(text, F.lit(1), F.length(text) - 20))
                    .when(F.col("event_id") % 61 == 0, F.regexp_replace(text, '"total_payment_value":[0-9.E-]+', '"total_payment_value":"n/a"'))
                    .otherwise(text))
        return e.select(text.alias("value"))


def order_columns(customer_buckets: int | None = None) -> dict[str, Column]:
    """The declared order-message fields built from one ``events`` row, typed
    as :data:`storelake.schemas.ORDER_MESSAGE` declares them."""
    user = F.col("user_id") if customer_buckets is None else F.col("user_id") % customer_buckets
    states = F.array(*[F.lit(s) for s in STREAM_STATES])
    state = F.get(states, ((F.col("event_id") * 7 + F.col("user_id")) % 13).cast("int"))
    ts = F.date_trunc("minute", F.col("ts"))
    total = F.round(F.col("value") * 20, 2)
    k = F.get_json_object("props", "$.k")
    item = F.struct(
        F.lit(1).cast("int").alias("order_item_id"),
        k.alias("product_id"),
        F.lit(None).cast("string").alias("seller_id"),
        total.alias("price"),
        (k.cast("int") * F.lit(1.2)).alias("freight_value"),
        F.col("event_type").alias("product_category"))
    empty = F.lit("")
    nothing = F.lit(None).cast("string")
    return {
        "order_id": F.col("event_id").cast("string"),
        "customer_id": user.cast("string"),
        "customer_unique_id": user.cast("string"),
        "customer_state": state,
        "customer_city": nothing,
        "order_status": F.col("event_type"),
        "order_purchase_timestamp": F.date_format(ts, "dd-MM-yyyy HH:mm"),
        "order_approved_at": empty,
        "order_delivered_carrier_date": empty,
        "order_delivered_customer_date": empty,
        "order_estimated_delivery_date": empty,
        "items": F.array(item),
        "payment_type": nothing,
        "payment_installments": F.lit(1).cast("int"),
        "total_payment_value": total,
        "injected_anomaly": F.lit(None).cast(schemas.ORDER_MESSAGE["injected_anomaly"].dataType),
    }


def with_bad_rows(cols: dict[str, Column]) -> dict[str, Column]:
    """The order-message fields with bad and larger orders by event id (see ``order_messages``)."""
    def every(n):
        return F.col("event_id") % n == 0
    item = F.get(cols["items"], 0)
    more = [item.withField("order_item_id", F.lit(k).cast("int")).withField("price", item["price"] + (k - 1))
                .withField("freight_value", F.lit(None).cast("double")) for k in (2, 3)]
    return cols | {
        "order_purchase_timestamp": F.when(every(97), "no time").otherwise(cols["order_purchase_timestamp"]),
        "customer_state": F.when(~every(53), cols["customer_state"]),
        "items": F.when(every(31), F.slice(cols["items"], 1, 0)).when(every(20), F.array(item, *more))
                  .when(every(10), F.array(item, more[0])).otherwise(cols["items"]),
    }


def order_struct(e: DataFrame, customer_buckets: int | None = None) -> Column:
    """The declared order-message struct built from one ``events`` row."""
    return F.struct(*[c.alias(n) for n, c in order_columns(customer_buckets).items()])
