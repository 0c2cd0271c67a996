"""DuckDB SQL twins of the registered queries (the correctness oracle).

Every query starts from the same bindings as ``storelake.sources.bindings``,
written here as plain SQL over the test tables. Column names and types are
aligned with the Spark output: day differences, hours and weekdays are cast
to INTEGER; money sums go through DECIMAL(18,2) exactly as on the Spark side.
"""

from __future__ import annotations

import math

BINDINGS = """
b_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
         o_orderdate + to_hours(o_orderkey % 24) AS order_purchase_timestamp,
         CASE WHEN o_orderstatus = 'O' THEN NULL
              ELSE o_orderdate + to_days(CAST(o_orderkey % 20 + 2 AS INTEGER)) END
           AS order_delivered_customer_date,
         o_orderdate + to_days(CAST(o_custkey % 25 + 7 AS INTEGER)) AS order_estimated_delivery_date
  FROM orders),
b_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id, l_extendedprice AS price, l_quantity * 1.5 AS freight_value
  FROM lineitem),
b_payments AS (
  SELECT o_orderkey AS order_id, 1 AS payment_sequential,
         CAST(o_orderkey % 12 + 1 AS INTEGER) AS payment_installments,
         o_totalprice AS payment_value
  FROM orders WHERE o_orderkey % 17 <> 0
  UNION ALL
  SELECT o_orderkey, 2, 1, CAST(10.0 AS DOUBLE)
  FROM orders WHERE o_orderkey % 17 <> 0 AND o_orderkey % 5 = 0),
b_products AS (
  SELECT p_partkey AS product_id, p_type AS product_category_name,
         CAST(CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_size * 100 END AS INTEGER) AS product_weight_g,
         p_size AS product_length_cm, CAST(p_size % 10 + 5 AS INTEGER) AS product_height_cm,
         CAST(p_size % 7 + 3 AS INTEGER) AS product_width_cm,
         CAST(p_partkey % 6 AS INTEGER) AS product_photos_qty,
         CAST(length(p_name) AS INTEGER) AS product_name_lenght,
         CAST(p_partkey % 499 AS INTEGER) AS product_description_lenght
  FROM part),
b_translation AS (
  SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS category_english
  FROM part WHERE p_type <> 'PROMO'),
b_customers AS (
  SELECT c_custkey AS customer_id, n_name AS customer_state, c_mktsegment AS customer_city
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
b_sellers AS (
  SELECT s_suppkey AS seller_id, n_name AS seller_state, n_name AS seller_city
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
dim_customers AS (SELECT * FROM b_customers WHERE customer_id IS NOT NULL),
dim_sellers AS (SELECT * FROM b_sellers WHERE seller_id IS NOT NULL),
dim_products AS (
  SELECT p.*, t.category_english
  FROM b_products p LEFT JOIN b_translation t USING (product_category_name)
  WHERE p.product_id IS NOT NULL),
fact AS (
  SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value,
         o.customer_id, o.order_status, o.order_purchase_timestamp,
         o.order_delivered_customer_date, o.order_estimated_delivery_date,
         p.payment_sequential, p.payment_installments, p.payment_value,
         CAST(o.order_purchase_timestamp AS DATE) AS order_purchase_date,
         CAST(year(o.order_purchase_timestamp) AS INTEGER) AS purchase_year,
         CAST(month(o.order_purchase_timestamp) AS INTEGER) AS purchase_month,
         CAST(day(o.order_purchase_timestamp) AS INTEGER) AS purchase_day,
         CAST(dayofweek(o.order_purchase_timestamp) + 1 AS INTEGER) AS purchase_weekday,
         CAST(hour(o.order_purchase_timestamp) AS INTEGER) AS purchase_hour,
         CASE WHEN dayofweek(o.order_purchase_timestamp) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend_order
  FROM (SELECT * FROM b_items WHERE order_id IS NOT NULL AND product_id IS NOT NULL
          AND seller_id IS NOT NULL AND price IS NOT NULL) i
  JOIN (SELECT * FROM b_orders WHERE order_id IS NOT NULL AND customer_id IS NOT NULL
          AND order_purchase_timestamp IS NOT NULL) o USING (order_id)
  LEFT JOIN b_payments p USING (order_id))
"""


def with_bindings(body: str) -> str:
    return "WITH " + BINDINGS.strip() + ",\n" + body.strip()


def money_sum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


SQL: dict[str, str] = {}

SQL["fact_order_items"] = with_bindings("q AS (SELECT * FROM fact) SELECT * FROM q")

SQL["dim_products"] = with_bindings("q AS (SELECT * FROM dim_products) SELECT * FROM q")

SQL["customer_spending_profile"] = with_bindings(f"""
q AS (
  SELECT f.customer_id, c.customer_state, c.customer_city,
         COUNT(DISTINCT f.order_id) AS total_orders,
         {money_sum('f.price')} AS total_spent,
         {money_sum('f.price')} / COUNT(f.price) AS avg_item_price,
         {money_sum('f.freight_value')} AS total_freight_paid
  FROM fact f LEFT JOIN dim_customers c USING (customer_id)
  GROUP BY 1, 2, 3)
SELECT * FROM q""")


def days(end: str, start: str) -> str:
    return f"CAST(date_diff('day', CAST({start} AS DATE), CAST({end} AS DATE)) AS INTEGER)"


PRICING_CTE = f"""pq AS (
  SELECT f.order_id, f.product_id, f.price, f.freight_value,
         round(f.freight_value / NULLIF(f.price, 0), 4) AS freight_ratio,
         {days('f.order_delivered_customer_date', 'f.order_purchase_date')} AS delivery_days,
         {days('f.order_estimated_delivery_date', 'f.order_delivered_customer_date')}
           AS estimated_vs_actual_delivery,
         p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm,
         c.customer_state, f.purchase_hour AS order_hour, f.purchase_weekday AS order_dayofweek
  FROM fact f
  LEFT JOIN dim_products p USING (product_id)
  LEFT JOIN dim_customers c USING (customer_id)
  WHERE f.order_delivered_customer_date IS NOT NULL AND f.price > 0)"""

SQL["order_features_for_pricing"] = with_bindings(PRICING_CTE + "\nSELECT * FROM pq")

ML_CTES = f"""base AS (
  SELECT f.*, p.product_weight_g, p.product_length_cm, p.product_width_cm, p.product_height_cm,
         p.product_photos_qty, p.product_name_lenght, p.product_description_lenght,
         c.customer_state, c.customer_city, s.seller_state, s.seller_city
  FROM fact f
  LEFT JOIN dim_products p ON f.product_id = p.product_id
  LEFT JOIN dim_customers c ON f.customer_id = c.customer_id
  LEFT JOIN dim_sellers s ON f.seller_id = s.seller_id),
tot AS (
  SELECT order_id, COUNT(product_id) AS total_items_in_order,
         {money_sum('price')} AS total_order_value,
         MAX(payment_installments) AS max_installments,
         {money_sum('payment_value')} AS total_payment
  FROM base GROUP BY order_id),
q AS (
  SELECT {days('b.order_estimated_delivery_date', 'b.order_delivered_customer_date')} AS delay_vs_estimate_days,
         {days('b.order_estimated_delivery_date', 'b.order_purchase_date')} AS estimated_delivery_days,
         b.purchase_month, b.purchase_day, b.purchase_weekday, b.purchase_hour, b.is_weekend_order,
         b.product_weight_g, b.product_length_cm, b.product_width_cm, b.product_height_cm,
         b.product_length_cm * b.product_width_cm * b.product_height_cm AS product_volume,
         b.product_photos_qty, b.product_name_lenght, b.product_description_lenght,
         b.customer_state, b.customer_city, b.seller_state, b.seller_city,
         CASE WHEN b.customer_state = b.seller_state THEN 1 ELSE 0 END AS is_same_state,
         b.price AS price_per_item, b.freight_value AS freight_per_item,
         t.total_items_in_order, t.max_installments, t.total_payment, t.total_order_value,
         round(b.freight_value / NULLIF(b.price, 0), 4) AS freight_price_ratio,
         b.product_weight_g AS weight_per_item
  FROM base b LEFT JOIN tot t USING (order_id)
  WHERE b.order_delivered_customer_date IS NOT NULL AND b.product_weight_g IS NOT NULL)"""

SQL["ml_feature_store_v2"] = with_bindings(ML_CTES + "\nSELECT * FROM q")

SQL["fact_order_items_bucketed"] = SQL["fact_order_items"]
SQL["ml_feature_store_bucketed"] = SQL["ml_feature_store_v2"]
SQL["order_features_by_quarter"] = with_bindings(ML_CTES + f"""
SELECT purchase_month, 4 AS quarter, COUNT(*) AS feature_rows, {money_sum('price_per_item')} AS value,
       COUNT(*) FILTER (delay_vs_estimate_days < 0) AS late_rows
FROM q WHERE purchase_month BETWEEN 10 AND 12 GROUP BY purchase_month""")

SQL["daily_sales_by_category"] = with_bindings("""
q AS (
  SELECT f.order_purchase_date AS sale_date, p.category_english,
         COUNT(DISTINCT f.order_id) AS num_orders
  FROM fact f LEFT JOIN dim_products p USING (product_id)
  GROUP BY 1, 2)
SELECT * FROM q""")

SQL["layer_row_counts"] = with_bindings("""
q AS (
  SELECT 'bronze.orders' AS table_name, COUNT(*) AS row_count FROM b_orders
  UNION ALL SELECT 'bronze.order_items', COUNT(*) FROM b_items
  UNION ALL SELECT 'bronze.payments', COUNT(*) FROM b_payments
  UNION ALL SELECT 'bronze.products', COUNT(*) FROM b_products
  UNION ALL SELECT 'bronze.customers', COUNT(*) FROM b_customers
  UNION ALL SELECT 'bronze.sellers', COUNT(*) FROM b_sellers
  UNION ALL SELECT 'silver.fact_order_items', COUNT(*) FROM fact
  UNION ALL SELECT 'silver.dim_customers', COUNT(*) FROM dim_customers
  UNION ALL SELECT 'silver.dim_products', COUNT(*) FROM dim_products
  UNION ALL SELECT 'silver.dim_sellers', COUNT(*) FROM dim_sellers)
SELECT * FROM q""")


# --- the order stream (events -> order messages) and the six rules ----------
def stream_orders(buckets: int | None = None, bad_rows: bool = False) -> str:
    cust = "user_id" if buckets is None else f"user_id % {buckets}"
    when = (lambda n, bad, good: f"CASE WHEN event_id % {n} = 0 THEN {bad} ELSE {good} END") if bad_rows \
        else (lambda n, bad, good: good)
    state = """(['SP','RJ','MG','RS','PR','BA','PE','CE','AM','PA','AC','RR','AP'])
           [CAST((event_id * 7 + user_id) % 13 AS INTEGER) + 1]"""
    freight = "CAST(json_extract_string(props, '$.k') AS INTEGER) * CAST(1.2 AS DOUBLE)"
    return f"""
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id, CAST({cust} AS VARCHAR) AS customer_id,
         CAST({cust} AS VARCHAR) AS customer_unique_id,
         {when(53, 'NULL', state)} AS customer_state,
         {when(97, 'NULL', "date_trunc('minute', ts)")} AS ts,
         round(value * 20, 2) AS total, event_id, event_type,
         {when(31, 'NULL', freight)} AS item_freight,
         json_extract_string(props, '$.k') AS item_product_id
  FROM events),
o AS (
  SELECT *, coalesce(item_freight, 0.0) AS first_freight,
         CAST(hour(ts) AS INTEGER) AS purchase_hour,
         coalesce(ts, TIMESTAMP '2030-01-01 00:00:00') AS seen_at
  FROM ev WHERE order_id IS NOT NULL AND customer_id IS NOT NULL),
seq AS (
  SELECT *, lag(customer_state) OVER w AS prev_state, lag(ts) OVER w AS prev_ts,
         epoch(ts) - epoch(lag(ts) OVER w) AS gap_s
  FROM o WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY customer_unique_id ORDER BY ts, order_id)),
sess AS (
  SELECT *, SUM(CASE WHEN prev_ts IS NULL OR gap_s >= 3600 THEN 1 ELSE 0 END)
              OVER (PARTITION BY customer_unique_id ORDER BY ts, order_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_id
  FROM seq),
sess2 AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_unique_id, session_id ORDER BY ts, order_id)
              AS session_count
  FROM sess),
firsts AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_unique_id ORDER BY ts, order_id) AS rn
                 FROM o WHERE ts IS NOT NULL) WHERE rn = 1),
a_amount AS (
  SELECT order_id, 'amount' AS type, 1.0::DOUBLE AS score,
         'Value ' || CAST(CAST(round(total) AS BIGINT) AS VARCHAR) || ' exceeds 3000' AS details,
         seen_at AS detected_at
  FROM o WHERE total > 3000),
a_off AS (
  SELECT order_id, 'off_hours' AS type, 1.0::DOUBLE AS score,
         'Order at ' || CAST(purchase_hour AS VARCHAR) || 'h value '
           || CAST(CAST(round(total) AS BIGINT) AS VARCHAR) AS details,
         seen_at AS detected_at
  FROM o WHERE purchase_hour >= 1 AND purchase_hour < 5 AND total > 1000),
a_freight AS (
  SELECT order_id, 'freight_mismatch' AS type, 1.0::DOUBLE AS score,
         'Freight ' || CAST(CAST(round(first_freight) AS BIGINT) AS VARCHAR) || ' unusually high' AS details,
         seen_at AS detected_at
  FROM o WHERE ts IS NOT NULL AND first_freight > 100),
a_first AS (
  SELECT order_id, 'first_order_high_value' AS type, 1.0::DOUBLE AS score,
         'First order ' || CAST(CAST(round(total) AS BIGINT) AS VARCHAR) || ' exceeds 500' AS details,
         seen_at AS detected_at
  FROM firsts WHERE coalesce(total, 0.0) > 500),
a_geo AS (
  SELECT order_id, 'geo_velocity' AS type, 1.0::DOUBLE AS score,
         'State jump ' || prev_state || '->' || customer_state || ' in '
           || CAST((CAST(gap_s AS BIGINT) + 180) // 360 // 10 AS VARCHAR) || '.'
           || CAST((CAST(gap_s AS BIGINT) + 180) // 360 % 10 AS VARCHAR) || 'h' AS details,
         seen_at AS detected_at
  FROM seq
  WHERE prev_state IS NOT NULL AND prev_state <> '' AND prev_ts IS NOT NULL
    AND abs(gap_s) < 4 * 3600 AND customer_state <> prev_state
    AND least(customer_state, prev_state) || '|' || greatest(customer_state, prev_state)
        IN ('AC|MG', 'AC|SP', 'AM|RJ', 'AM|RS', 'AM|SP', 'AP|PR', 'PA|SP', 'RR|SP')),
a_velocity AS (
  SELECT order_id, 'velocity' AS type, 1.0::DOUBLE AS score,
         CAST(session_count AS VARCHAR) || ' orders in 1 hour' AS details, seen_at AS detected_at
  FROM sess2 WHERE session_count > 5)
"""


def rules_sql(select: str, buckets: int | None = None, bad_rows: bool = False) -> str:
    return "WITH " + stream_orders(buckets, bad_rows).strip() + "\n" + select


SQL["alerts_amount"] = rules_sql("SELECT * FROM a_amount")
SQL["alerts_off_hours"] = rules_sql("SELECT * FROM a_off")
SQL["alerts_freight_mismatch"] = rules_sql("SELECT * FROM a_freight")
SQL["alerts_first_order_high_value"] = rules_sql("SELECT * FROM a_first")
SQL["alerts_geo_velocity"] = rules_sql("SELECT * FROM a_geo")
SQL["alerts_velocity"] = rules_sql("SELECT * FROM a_velocity")
SQL["alerts_velocity_10_customers"] = rules_sql("SELECT * FROM a_velocity", buckets=10)
ALL_ALERTS = """
  SELECT * FROM a_geo UNION ALL SELECT * FROM a_first UNION ALL SELECT * FROM a_velocity
  UNION ALL SELECT * FROM a_freight UNION ALL SELECT * FROM a_amount UNION ALL SELECT * FROM a_off"""
SQL["order_alerts"] = rules_sql(ALL_ALERTS)
SQL["stream_alerts_late_hot_customers"] = rules_sql(ALL_ALERTS, buckets=10)
SQL["parsed_order_stream"] = rules_sql("""
SELECT order_id, customer_id, customer_unique_id, customer_state,
       strftime(ts, '%d-%m-%Y %H:%M') AS order_purchase_timestamp,
       total AS total_payment_value, 1 AS n_items, total AS item_price,
       item_freight, item_product_id
FROM ev""")


# --- stream facts, daily metrics, serving ----------------------------------
STREAM_FACTS = """,
sfact AS (
  SELECT o.order_id, 1 AS order_item_id, o.item_product_id AS product_id,
         CAST(NULL AS VARCHAR) AS seller_id, o.customer_id, o.customer_unique_id,
         o.event_type AS order_status, o.ts AS order_purchase_timestamp,
         o.total AS price, o.item_freight AS freight_value, o.event_type AS product_category_name
  FROM o),
dm AS (
  SELECT CAST(order_purchase_timestamp AS DATE) AS metric_date,
         COUNT(*) AS orders, COUNT(DISTINCT order_id) AS distinct_orders,
         CAST(CAST(SUM(CAST(price AS DECIMAL(18,2)) + CAST(freight_value AS DECIMAL(18,2)))
              AS DECIMAL(28,2)) AS DOUBLE) AS revenue
  FROM sfact WHERE order_purchase_timestamp IS NOT NULL GROUP BY 1),
alerts AS (""" + ALL_ALERTS + """),
kept AS (
  SELECT * FROM alerts ORDER BY detected_at DESC NULLS LAST, order_id, type LIMIT 200),
anomalies AS (
  SELECT ROW_NUMBER() OVER (ORDER BY detected_at DESC NULLS LAST, order_id, type) AS id,
         order_id, type, CAST(score AS REAL) AS score, details, detected_at
  FROM kept)
"""


def serving_sql(select: str) -> str:
    return "WITH " + stream_orders().strip() + STREAM_FACTS + select


SQL["stream_fact_order_items"] = serving_sql("SELECT * FROM sfact")
SQL["daily_metrics"] = serving_sql("SELECT * FROM dm")
SQL["daily_metrics_from_kv"] = serving_sql("SELECT metric_date, orders, revenue FROM dm")
SQL["sales_by_day"] = serving_sql("SELECT metric_date, orders, revenue FROM dm ORDER BY metric_date")
SQL["live_metrics"] = serving_sql("""
SELECT DATE '2024-01-15' AS date, coalesce(dm.orders, 0) AS orders,
       CAST(round(coalesce(dm.revenue, 0.0) * 100) AS BIGINT) / 100.0 AS revenue,
       CASE WHEN coalesce(dm.orders, 0) > 0
            THEN ((2 * CAST(round(dm.revenue * 100) AS BIGINT) + dm.orders) // (2 * dm.orders)) / 100.0
            ELSE 0.0 END AS avg_order_value
FROM (SELECT 1 AS one) d LEFT JOIN dm ON dm.metric_date = DATE '2024-01-15'""")
SQL["alert_summary"] = serving_sql("SELECT type, COUNT(*) AS count FROM alerts GROUP BY type")
SQL["recent_alerts"] = serving_sql(
    "SELECT * FROM alerts ORDER BY detected_at DESC NULLS LAST, order_id, type LIMIT 20")
SQL["anomalies_reload"] = serving_sql("SELECT * FROM anomalies")
SQL["alert_history"] = serving_sql(
    "SELECT * FROM anomalies ORDER BY detected_at DESC NULLS LAST, order_id, type LIMIT 50")
SQL["daily_metrics_upsert"] = serving_sql("SELECT * FROM dm")
SQL["served_alert_summary"] = serving_sql("SELECT type, COUNT(*) AS count FROM anomalies GROUP BY type")
SQL["serving_load_summary"] = serving_sql("""
SELECT 'daily_metrics' AS table_name, COUNT(*) AS row_count FROM dm
UNION ALL SELECT 'anomalies', COUNT(*) FROM anomalies""")
SQL["sales_by_day_positions"] = serving_sql("""
SELECT metric_date, orders, revenue, CAST(ROW_NUMBER() OVER (ORDER BY metric_date) AS INTEGER) AS position FROM dm""")
SQL["alert_summary_positions"] = serving_sql("""
SELECT type, COUNT(*) AS count, CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, type) AS INTEGER) AS position
FROM alerts GROUP BY type""")
SQL["order_alerts_bad_rows"] = rules_sql(ALL_ALERTS, bad_rows=True)
SQL["stream_facts_bad_rows"] = rules_sql("""
SELECT order_id, CAST(i AS INTEGER) AS order_item_id, item_product_id AS product_id, CAST(NULL AS VARCHAR) AS seller_id,
       customer_id, customer_unique_id, event_type AS order_status, ts AS order_purchase_timestamp,
       total + (i - 1) AS price, CASE WHEN i = 1 THEN item_freight END AS freight_value,
       event_type AS product_category_name
FROM o, range(1, 4) t(i)
WHERE i <= CASE WHEN event_id % 31 = 0 THEN 0 WHEN event_id % 20 = 0 THEN 3 WHEN event_id % 10 = 0 THEN 2 ELSE 1 END""",
                                         bad_rows=True)
SQL["anomalies_reload_bad_rows"] = "WITH " + stream_orders(bad_rows=True).strip() + STREAM_FACTS + "SELECT * FROM anomalies"
_REJECT = """CASE WHEN event_id % 89 = 0 THEN 'malformed' WHEN event_id % 71 = 0 THEN 'no_customer_id'
                  WHEN event_id % 61 = 0 THEN 'bad_field' END"""
SQL["order_message_rejects"] = f"""
SELECT CAST(event_id AS VARCHAR) AS order_key, {_REJECT} AS reject_reason, {_REJECT} = 'bad_field' AS used
FROM events WHERE {_REJECT} IS NOT NULL"""
SQL["order_messages_used"] = f"""
SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_id,
       CASE WHEN event_id % 61 <> 0 THEN round(value * 20, 2) END AS total_payment_value, {_REJECT} AS reject_reason
FROM events WHERE event_id % 89 <> 0 AND event_id % 71 <> 0"""
SQL["bronze_csv_rejects"] = with_bindings("""
q AS (SELECT * FROM b_orders)
SELECT 'order_purchase_timestamp' AS column_name, strftime(order_purchase_timestamp, '%d/%m/%Y') AS value,
       CAST(order_id AS VARCHAR) AS order_id
FROM q WHERE order_id % 83 = 0 AND order_purchase_timestamp IS NOT NULL
UNION ALL
SELECT 'order_estimated_delivery_date', 'soon', CAST(order_id AS VARCHAR) FROM q WHERE order_id % 59 = 0""")
SQL["bronze_csv_roundtrip"] = with_bindings("""
q AS (SELECT * FROM b_orders)
SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(customer_id AS VARCHAR) AS customer_id, order_status,
       order_purchase_timestamp, order_delivered_customer_date, order_estimated_delivery_date FROM q""")


# --- forecasting ---------------------------------------------------------------
FORECAST = """,
ds AS (
  SELECT f.order_purchase_date AS sale_date, p.category_english, COUNT(DISTINCT f.order_id) AS num_orders
  FROM fact f LEFT JOIN dim_products p USING (product_id) GROUP BY 1, 2),
dsd AS (
  SELECT category_english, sale_date, SUM(num_orders) AS y FROM ds
  WHERE sale_date IS NOT NULL AND category_english IS NOT NULL AND num_orders IS NOT NULL
  GROUP BY 1, 2),
wk AS (
  SELECT category_english, CAST(date_trunc('week', sale_date) AS DATE) + 6 AS week, SUM(y) AS y
  FROM dsd GROUP BY 1, 2),
bounds AS (
  SELECT category_english, MIN(CAST(date_trunc('week', sale_date) AS DATE) + 6) AS lo,
         MAX(CAST(date_trunc('week', sale_date) AS DATE) + 6) AS hi, COUNT(*) AS n_days
  FROM dsd GROUP BY 1),
cal AS (
  SELECT category_english, lo, n_days, CAST(date_diff('day', lo, hi) / 7 + 1 AS INTEGER) AS n,
         CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 7 DAYS)) AS DATE) AS week
  FROM bounds),
series AS (
  SELECT c.category_english, c.week, CAST(date_diff('day', c.lo, c.week) / 7 AS INTEGER) AS x,
         CAST(coalesce(w.y, 0) AS BIGINT) AS y, c.n, c.n_days
  FROM cal c LEFT JOIN wk w USING (category_english, week)),
bt AS (SELECT *, x >= n - 8 AS is_test FROM series WHERE n >= 23),
bt_fit AS (
  SELECT category_english, CAST(COUNT(*) AS DOUBLE) AS m, CAST(SUM(x) AS DOUBLE) AS sx,
         CAST(SUM(y) AS DOUBLE) AS sy, CAST(SUM(x * x) AS DOUBLE) AS sxx, CAST(SUM(x * y) AS DOUBLE) AS sxy
  FROM bt WHERE NOT is_test GROUP BY 1),
bt_coef AS (
  SELECT category_english, (m * sxy - sx * sy) / (m * sxx - sx * sx) AS slope, sx, sy, m FROM bt_fit),
bt_coef2 AS (SELECT category_english, slope, (sy - slope * sx) / m AS intercept FROM bt_coef),
bt_err AS (
  SELECT b.category_english, (c.intercept + c.slope * CAST(b.x AS DOUBLE)) - CAST(b.y AS DOUBLE) AS e
  FROM bt b JOIN bt_coef2 c USING (category_english) WHERE b.is_test),
evaluation AS (
  SELECT category_english, COUNT(*) AS test_points,
         list_reduce(list_sort(list(abs(e))), lambda a, v: a + v) / COUNT(*) AS mae,
         sqrt(list_reduce(list_sort(list(e * e)), lambda a, v: a + v) / COUNT(*)) AS rmse
  FROM bt_err GROUP BY 1),
fs AS (SELECT * FROM series WHERE n_days >= 30),
f_fit AS (
  SELECT category_english, CAST(COUNT(*) AS DOUBLE) AS m, CAST(SUM(x) AS DOUBLE) AS sx,
         CAST(SUM(y) AS DOUBLE) AS sy, CAST(SUM(x * x) AS DOUBLE) AS sxx, CAST(SUM(x * y) AS DOUBLE) AS sxy
  FROM fs GROUP BY 1),
f_coef AS (
  SELECT category_english, (m * sxy - sx * sy) / (m * sxx - sx * sx) AS slope, sx, sy, m FROM f_fit),
f_coef2 AS (SELECT category_english, slope, (sy - slope * sx) / m AS intercept FROM f_coef),
f_sigma AS (
  SELECT s.category_english,
         sqrt(list_reduce(list_sort(list(
              (CAST(s.y AS DOUBLE) - (c.intercept + c.slope * CAST(s.x AS DOUBLE)))
            * (CAST(s.y AS DOUBLE) - (c.intercept + c.slope * CAST(s.x AS DOUBLE))))),
              lambda a, v: a + v) / (COUNT(*) - 2)) AS sigma
  FROM fs s JOIN f_coef2 c USING (category_english) GROUP BY 1),
f_last AS (SELECT category_english, MAX(week) AS last_week, MAX(x) AS last_x FROM fs GROUP BY 1),
f_frame AS (
  SELECT category_english, week, x FROM fs
  UNION ALL
  SELECT category_english, CAST(last_week + CAST(7 * i AS INTEGER) AS DATE), CAST(last_x + i AS INTEGER)
  FROM f_last, range(1, 13) t(i)),
forecast AS (
  SELECT fr.category_english, CAST(fr.week AS TIMESTAMP) AS ds,
         c.intercept + c.slope * CAST(fr.x AS DOUBLE) AS yhat,
         (c.intercept + c.slope * CAST(fr.x AS DOUBLE)) - 1.2815515655446004 * g.sigma AS yhat_lower,
         (c.intercept + c.slope * CAST(fr.x AS DOUBLE)) + 1.2815515655446004 * g.sigma AS yhat_upper
  FROM f_frame fr JOIN f_coef2 c USING (category_english) JOIN f_sigma g USING (category_english))
"""


def forecast_sql(select: str) -> str:
    return with_bindings(FORECAST.lstrip(",").strip() + "\n" + select)


SQL["weekly_category_demand"] = forecast_sql("SELECT category_english, week, x, y FROM series")
SQL["forecast_evaluation_metrics"] = forecast_sql("SELECT * FROM evaluation")
SQL["forecast_weekly_demand"] = forecast_sql("SELECT * FROM forecast")
SQL["forecast_accuracy_summary"] = forecast_sql("""
SELECT CAST(SUM(CAST(mae AS DECIMAL(28,9))) AS DOUBLE) / COUNT(mae) AS avg_mae,
       CAST(SUM(CAST(rmse AS DECIMAL(28,9))) AS DOUBLE) / COUNT(rmse) AS avg_rmse,
       COUNT(*) AS categories
FROM evaluation""")
SQL["forecast_worst_categories"] = forecast_sql(
    "SELECT * FROM evaluation ORDER BY mae DESC, category_english LIMIT 10")


# --- the seasonal model: sums of products of its terms, Gauss-Jordan elimination one CTE per term ---------
def _seasonal_terms(x: str) -> list[str]:
    year = 365.25 / 7
    out = ["CAST(1.0 AS DOUBLE)", f"CAST({x} AS DOUBLE) / CAST({year!r} AS DOUBLE)"]
    for k in (1, 2, 3):
        angle = f"CAST({x} AS DOUBLE) * CAST({2 * math.pi * k / year!r} AS DOUBLE)"
        out += [f"sin({angle})", f"cos({angle})"]
    return out


def _seasonal_fit(name: str, rows: str) -> str:
    """CTEs up to ``<name>_beta`` (category_english, m, last_week, last_x, beta)."""
    t = _seasonal_terms("x")
    d, year = len(t), 365.25 / 7
    penalty = [0.0, 1e-3 / year**2, *[1e-3] * (d - 2)]
    sums = ", ".join(f"CAST(SUM(CAST(({t[i]}) * ({t[j] if j < d else 'CAST(y AS DOUBLE)'}) AS DECIMAL(38,12))) AS DOUBLE) AS s_{i}_{j}"
                     for i in range(d) for j in range(i, d + 1))
    rows_ = ", ".join("[" + ", ".join(f"s_{min(i, j)}_{max(i, j)}" + (f" + {penalty[i]!r}::DOUBLE * m" if i == j else "")
                                      for j in range(d + 1)) + "]" for i in range(d))
    ctes = [f"""{name}_sums AS (SELECT category_english, COUNT(*) AS m, MAX(week) AS last_week, MAX(x) AS last_x, {sums}
                 FROM {rows} GROUP BY 1)""",
            f"{name}_0 AS (SELECT category_english, m, last_week, last_x, [{rows_}] AS a FROM {name}_sums)"]
    for k in range(1, d + 1):
        ctes.append(f"""{name}_{k} AS (SELECT * REPLACE (list_transform(a, lambda r, i:
              CASE WHEN i = {k} THEN list_transform(r, lambda v: v / r[{k}])
                   ELSE list_transform(r, lambda v, j: v - r[{k}] / a[{k}][{k}] * a[{k}][j]) END) AS a) FROM {name}_{k - 1})""")
    ctes.append(f"{name}_beta AS (SELECT * EXCLUDE (a), list_transform(a, lambda r: r[{d + 1}]) AS beta FROM {name}_{d})")
    return ",\n".join(ctes)


def _seasonal_value(x: str) -> str:
    return " + ".join(["CAST(0.0 AS DOUBLE)", *[f"beta[{k + 1}] * ({t})" for k, t in enumerate(_seasonal_terms(x))]])


SEASONAL = FORECAST.rstrip() + ",\n" + _seasonal_fit("sf", "fs") + ",\n" + _seasonal_fit("sb", "(SELECT * FROM bt WHERE NOT is_test)") + f""",
sf_sigma AS (
  SELECT category_english, sqrt(CAST(SUM(CAST(r * r AS DECIMAL(38,9))) AS DOUBLE) / greatest(MAX(m) - 8, 1)) AS sigma
  FROM (SELECT category_english, m, CAST(y AS DOUBLE) - ({_seasonal_value('x')}) AS r FROM fs JOIN sf_beta USING (category_english))
  GROUP BY 1),
sf_frame AS (
  SELECT category_english, week, x FROM fs
  UNION ALL SELECT category_english, CAST(last_week + CAST(7 * i AS INTEGER) AS DATE), CAST(last_x + i AS INTEGER)
  FROM sf_beta, range(1, 13) t(i)),
sf_out AS (
  SELECT category_english, CAST(week AS TIMESTAMP) AS ds, {_seasonal_value('x')} AS yhat, 1.2815515655446004::DOUBLE * sigma AS band
  FROM sf_frame JOIN sf_beta USING (category_english) JOIN sf_sigma USING (category_english)),
sb_err AS (
  SELECT category_english, ({_seasonal_value('x')}) - CAST(y AS DOUBLE) AS e FROM bt JOIN sb_beta USING (category_english) WHERE is_test)
"""


def seasonal_sql(select: str) -> str:
    return with_bindings(SEASONAL.lstrip(",").strip() + "\n" + select)


for _n in ("forecast_weekly_demand_seasonal", "forecast_weekly_demand_seasonal_native"):
    SQL[_n] = seasonal_sql("SELECT category_english, ds, round(yhat, 6) AS yhat, round(yhat - band, 6) AS yhat_lower, "
                           "round(yhat + band, 6) AS yhat_upper FROM sf_out")
for _n in ("forecast_evaluation_seasonal", "forecast_evaluation_seasonal_native"):
    SQL[_n] = seasonal_sql("SELECT category_english, COUNT(*) AS test_points, round(AVG(abs(e)), 6) AS mae, "
                           "round(sqrt(AVG(e * e)), 6) AS rmse FROM sb_err GROUP BY 1")


# --- baskets: single-antecedent rules by counting pairs inside baskets -------
def basket_sql(item: str, select: str, support: float = 0.001, confidence: float = 0.2) -> str:
    src = ("SELECT order_id, product_id AS item FROM fact" if item == "product_id" else
           f"SELECT f.order_id, p.{item} AS item FROM fact f LEFT JOIN dim_products p USING (product_id)")
    return with_bindings(f"""
src AS ({src}),
bi0 AS (SELECT DISTINCT order_id, item FROM src WHERE item IS NOT NULL),
bsz AS (SELECT order_id, COUNT(*) AS n_items FROM bi0 GROUP BY order_id HAVING COUNT(*) > 1),
bi AS (SELECT bi0.* FROM bi0 JOIN bsz USING (order_id)),
n AS (SELECT COUNT(*) AS n, CEIL({support} * COUNT(*)) AS min_count FROM bsz),
ic AS (SELECT item, COUNT(*) AS f FROM bi GROUP BY item),
pc AS (SELECT a.item AS x, c.item AS y, COUNT(*) AS f
       FROM bi a JOIN bi c ON a.order_id = c.order_id AND a.item <> c.item GROUP BY 1, 2),
rules AS (
  SELECT pc.x AS product_id, pc.y AS recommended_product_id,
         CAST(pc.f AS DOUBLE) / ia.f AS confidence,
         (CAST(pc.f AS DOUBLE) / ia.f) / (CAST(ib.f AS DOUBLE) / n.n) AS lift,
         CAST(pc.f AS DOUBLE) / n.n AS support
  FROM pc JOIN ic ia ON ia.item = pc.x JOIN ic ib ON ib.item = pc.y CROSS JOIN n
  WHERE pc.f >= n.min_count AND CAST(pc.f AS DOUBLE) / ia.f >= {confidence})
{select}""")


SQL["multi_item_baskets"] = basket_sql("product_category_name", """
SELECT order_id, CAST(COUNT(*) AS INTEGER) AS n_items, string_agg(item, ',' ORDER BY item) AS items_key
FROM bi GROUP BY order_id""")
SQL["basket_rules"] = basket_sql("product_category_name", "SELECT * FROM rules")
SQL["basket_rules_by_product"] = basket_sql("product_id", "SELECT * FROM rules")
SQL["basket_rules_by_product_pairs"] = basket_sql("product_id", "SELECT * FROM rules", 0.0002, 0.05)
SQL["basket_rule_quality"] = basket_sql("product_category_name", """
SELECT round(AVG(confidence), 9) AS avg_confidence, round(AVG(lift), 9) AS avg_lift,
       round(AVG(support), 9) AS avg_support, MAX(confidence) AS max_confidence,
       MAX(lift) AS max_lift, COUNT(*) AS rules
FROM rules""")
SQL["top_basket_rules"] = basket_sql("product_category_name", """
SELECT * FROM rules ORDER BY lift DESC, confidence DESC, product_id, recommended_product_id LIMIT 10""")


# frequent sets of any size: every subset of a basket, its items from the rarest on
_SETS = """,
nos AS (SELECT item, f, ROW_NUMBER() OVER (ORDER BY f, item) AS no FROM ic, n WHERE f >= n.min_count),
bn AS (SELECT bi.order_id, nos.no FROM bi JOIN nos USING (item)),
subs AS (
  SELECT order_id, [no] AS items, no AS last_no FROM bn
  UNION ALL SELECT s.order_id, list_append(s.items, b.no), b.no FROM subs s JOIN bn b ON s.order_id = b.order_id AND b.no > s.last_no),
sets AS (SELECT items, COUNT(*) AS f FROM subs, n GROUP BY items, n.min_count HAVING COUNT(*) >= n.min_count)
"""


def sets_sql(select: str) -> str:
    return basket_sql("product_category_name", _SETS + select).replace("WITH ", "WITH RECURSIVE ", 1)


SQL["basket_itemsets"] = sets_sql("""
SELECT string_agg(item, ',' ORDER BY item) AS items_key, f AS freq
FROM (SELECT items, sets.f, unnest(items) AS no FROM sets) JOIN (SELECT no, item FROM nos) USING (no) GROUP BY items, f""")
SQL["basket_rules_levelwise"] = SQL["basket_rules_all_antecedents"] = sets_sql(""",
split AS (
  SELECT items, f, unnest(items) AS to_no FROM sets WHERE len(items) > 1),
all_rules AS (
  SELECT a.items AS before, CAST(s.f AS DOUBLE) / a.f AS confidence, s.f, s.to_no
  FROM split s JOIN sets a ON a.items = list_filter(s.items, lambda x: x <> s.to_no))
SELECT x.item AS product_id, y.item AS recommended_product_id, confidence,
       confidence / (CAST(y.f AS DOUBLE) / n.n) AS lift, CAST(r.f AS DOUBLE) / n.n AS support
FROM all_rules r JOIN nos x ON x.no = r.before[1] JOIN nos y ON y.no = r.to_no CROSS JOIN n
WHERE confidence >= 0.2""")


SQL["customer_state_index"] = with_bindings(ML_CTES + """
SELECT customer_state,
       CAST(ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, customer_state) - 1 AS DOUBLE) AS customer_state_idx
FROM q
WHERE delay_vs_estimate_days IS NOT NULL AND estimated_delivery_days IS NOT NULL
  AND product_weight_g IS NOT NULL AND product_volume IS NOT NULL AND price_per_item IS NOT NULL
  AND freight_per_item IS NOT NULL AND total_order_value IS NOT NULL AND customer_state IS NOT NULL
GROUP BY customer_state""")

_DELAY_NUM = ("estimated_delivery_days purchase_month purchase_day purchase_weekday purchase_hour "
              "is_weekend_order product_weight_g product_length_cm product_width_cm product_height_cm "
              "product_volume product_photos_qty is_same_state price_per_item freight_per_item "
              "total_items_in_order max_installments total_payment total_order_value "
              "freight_price_ratio weight_per_item").split()
_DELAY_REQ = ("delay_vs_estimate_days estimated_delivery_days product_weight_g product_volume "
              "price_per_item freight_per_item total_order_value").split()
_PRICE_NUM = ("freight_value freight_ratio delivery_days estimated_vs_actual_delivery product_weight_g "
              "product_length_cm product_height_cm product_width_cm order_hour order_dayofweek").split()
_PRICE_REQ = ("price freight_value delivery_days product_weight_g product_length_cm "
              "product_width_cm product_height_cm").split()


def _nn(cols) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


SQL["model_input_counts"] = with_bindings(ML_CTES + ",\n" + PRICING_CTE + f"""
SELECT 'delay.loaded' AS table_name, COUNT(*) AS row_count FROM q
UNION ALL SELECT 'delay.required', COUNT(*) FROM q WHERE {_nn(_DELAY_REQ)}
UNION ALL SELECT 'delay.assembled', COUNT(*) FROM q WHERE {_nn(_DELAY_REQ)} AND {_nn(_DELAY_NUM)}
UNION ALL SELECT 'price.loaded', COUNT(*) FROM pq
UNION ALL SELECT 'price.required', COUNT(*) FROM pq WHERE {_nn(_PRICE_REQ)}
UNION ALL SELECT 'price.assembled', COUNT(*) FROM pq WHERE {_nn(_PRICE_REQ)} AND {_nn(_PRICE_NUM)}""")


def _best_split(features, columns: str) -> str:
    rows = "\nUNION ALL ".join(f"SELECT {k} AS at_no, '{f}' AS feature, CAST({f} AS DOUBLE) AS value, y FROM whole" for k, f in enumerate(features))
    return with_bindings(ML_CTES + f""",
whole AS (SELECT CAST(delay_vs_estimate_days AS DOUBLE) AS y, {", ".join(features)}
          FROM q WHERE {_nn(_DELAY_REQ)} AND {_nn(features)}),
long AS ({rows}),
sums AS (SELECT at_no, feature, value, COUNT(*) AS n, SUM(CAST(y AS DECIMAL(38,9))) AS s FROM long GROUP BY 1, 2, 3),
runs AS (
  SELECT *, lag(value) OVER w AS prev, SUM(n) OVER w - n AS ln, SUM(s) OVER w - s AS ls,
         SUM(n) OVER (PARTITION BY at_no) AS an, SUM(s) OVER (PARTITION BY at_no) AS total
  FROM sums WINDOW w AS (PARTITION BY at_no ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
sides AS (
  SELECT feature, at_no, (prev + value) / 2 AS threshold, CAST(ln AS BIGINT) AS ln, CAST(an - ln AS BIGINT) AS rn,
         CAST(ls AS DOUBLE) AS sl, CAST(total - ls AS DOUBLE) AS sr, CAST(total AS DOUBLE) AS s, CAST(an AS DOUBLE) AS an
  FROM runs WHERE prev IS NOT NULL),
gains AS (SELECT *, sl * sl / ln + sr * sr / rn - s * s / an AS gain FROM sides)
SELECT {columns} FROM (SELECT * FROM gains ORDER BY round(gain, 6) DESC, at_no, threshold LIMIT 1)""")


SQL["delay_best_split"] = _best_split(_DELAY_NUM, """feature, round(threshold, 6) AS threshold, ln AS left_rows, rn AS right_rows,
       round(sl / ln, 6) AS left_mean, round(sr / rn, 6) AS right_mean, round(gain, 6) AS gain""")
SQL["delay_first_tree"] = _best_split(
    ["estimated_delivery_days", "purchase_month", "purchase_day", "purchase_weekday", "purchase_hour", "is_weekend_order",
     "product_weight_g", "product_length_cm", "product_width_cm", "product_height_cm", "product_photos_qty",
     "is_same_state", "total_items_in_order", "max_installments"],
    "feature, round(threshold, 6) AS threshold, round(sl / ln, 6) AS left_mean, round(sr / rn, 6) AS right_mean")
SQL["stream_order_alerts"] = rules_sql(ALL_ALERTS)
SQL["stream_daily_metrics"] = serving_sql("SELECT metric_date, orders, revenue FROM dm")

SQL["stream_daily_metrics_restarted"] = SQL["stream_daily_metrics"]
SQL["stream_newest_alerts"] = serving_sql("SELECT * FROM kept")
SQL["stream_alert_counts"] = serving_sql("""
SELECT CAST(batch AS INTEGER) AS batch, type, COUNT(*) AS alerts
FROM alerts JOIN (
  SELECT CAST(event_id AS VARCHAR) AS order_id, (SELECT MAX(i) FROM range(0, 4) t(i) WHERE event_id >= lo + span * i // 4) AS batch
  FROM events, (SELECT MIN(event_id) AS lo, MAX(event_id) - MIN(event_id) + 1 AS span FROM events)) USING (order_id)
GROUP BY 1, 2""")

_PRICED = with_bindings(PRICING_CTE + f""",
mi AS (SELECT *, floor(price) + delivery_days * CAST(0.5 AS DOUBLE) AS prediction FROM pq WHERE {_nn(_PRICE_REQ)})""")
SQL["model_split_counts"] = _PRICED + """,
sides AS (SELECT *, CASE WHEN CAST('0x' || substr(md5(CAST(order_id AS VARCHAR) || '|42'), 1, 7) AS BIGINT) % 1000 < 800
                         THEN 'train' ELSE 'test' END AS side FROM mi)
SELECT side, COUNT(*) AS row_count, COUNT(DISTINCT order_id) AS orders, CAST(SUM(order_id) AS BIGINT) AS id_sum
FROM sides GROUP BY side"""
SQL["model_metrics"] = _PRICED + """
SELECT round(AVG(abs(prediction - price)), 6) AS mae, round(sqrt(AVG((prediction - price) * (prediction - price))), 6) AS rmse,
       round(1 - SUM((prediction - price) * (prediction - price)) / (COUNT(price) * var_pop(price)), 6) AS r2,
       COUNT(*) AS test_rows
FROM mi"""
SQL["pricing_adjustments"] = _PRICED + """
SELECT product_id, price, prediction AS predicted_price, round(prediction / NULLIF(price, 0), 4) AS adjustment_factor,
       customer_state, delivery_days
FROM mi"""
