"""The same results as plain SQL over the Parquet tables, for checking."""

from __future__ import annotations

from marketlake.plans.lake_reports import SAME_AS


def r(x: str, dp: int = 2) -> str:
    s = f"{10**dp}e0"
    return f"(CAST(sign({x})*floor(abs({x})*{s}+0.5e0) AS BIGINT)/{s})"


def units(x: str) -> str:
    return f"CAST(sign({x})*floor(abs({x})*10000e0+0.5e0) AS BIGINT)"


def total(x: str) -> str:
    return f"(CAST(sum({units(x)}) AS DOUBLE)/10000e0)"


def mean(x: str) -> str:
    return f"(CAST(sum({units(x)}) AS DOUBLE)/count({x})/10000e0)"


ORDERS = f"""orders_m AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'failed' ELSE 'confirmed' END AS status,
    {r('o_totalprice/800e0')} AS total,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'bank_transfer' WHEN '3-MEDIUM' THEN 'paypal'
      WHEN '4-NOT SPECIFIED' THEN 'crypto' WHEN '5-LOW' THEN 'debit_card' ELSE 'credit_card' END AS payment_method,
    o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS created_at,
    CAST(o_orderdate AS DATE) AS order_date
  FROM orders)"""

CATEGORY = """CASE p_type WHEN 'ECONOMY' THEN 'housewares' WHEN 'LARGE' THEN 'furniture_decor' WHEN 'MEDIUM' THEN 'computers_accessories'
      WHEN 'PROMO' THEN 'toys' WHEN 'STANDARD' THEN 'health_beauty' ELSE coalesce(p_type, 'other') END"""

SOURCE_ITEMS = f"""source_items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, {r('l_extendedprice/l_quantity/100e0')} AS price,
    {r('l_extendedprice*l_tax/100e0')} AS freight_value FROM lineitem)"""

ITEMS = f"""items_m AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, coalesce({CATEGORY}, 'other') AS category,
    CAST(l_quantity AS INTEGER) AS quantity, {r('l_extendedprice/l_quantity/100e0')} AS unit_price,
    {r('l_extendedprice*l_tax/100e0')} AS freight_value
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey)"""

STATES = """states_m AS (
  SELECT c_custkey AS customer_id, n_name AS shipping_state
  FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 0) ON c_nationkey = n_nationkey)"""


def tier(n: str, a: int = 15, b: int = 10, c: int = 5) -> str:
    return f"CASE WHEN {n} >= {a} THEN 'platinum' WHEN {n} >= {b} THEN 'gold' WHEN {n} >= {c} THEN 'silver' ELSE 'bronze' END"


SCORED = f"""{ORDERS},
tiers_m AS (SELECT o_custkey AS customer_id, {tier('count(*)')} AS customer_tier FROM orders GROUP BY 1),
counts_m AS (SELECT l_orderkey AS order_id, count(*) AS item_count FROM lineitem GROUP BY 1),
flagged_m AS (
  SELECT o.*, customer_tier, coalesce(item_count, 0) AS item_count,
    (total > 500 OR payment_method = 'crypto' OR (customer_tier = 'bronze' AND total > 200)) AS is_suspicious
  FROM orders_m o LEFT JOIN tiers_m USING (customer_id) LEFT JOIN counts_m USING (order_id)),
raw_m AS (
  SELECT *, 0e0 + CASE WHEN is_suspicious THEN 0.4e0 ELSE 0e0 END + CASE WHEN total > 500 THEN 0.2e0 ELSE 0e0 END
    + CASE WHEN payment_method = 'crypto' THEN 0.15e0 ELSE 0e0 END
    + CASE WHEN customer_tier = 'bronze' AND total > 200 THEN 0.25e0 ELSE 0e0 END
    + CASE WHEN item_count > 3 AND total > 500 THEN 0.1e0 ELSE 0e0 END AS raw_score,
    concat_ws(',', CASE WHEN is_suspicious THEN 'known_risky_customer' END, CASE WHEN total > 500 THEN 'high_value_order' END,
      CASE WHEN payment_method = 'crypto' THEN 'unusual_payment_method' END,
      CASE WHEN customer_tier = 'bronze' AND total > 200 THEN 'tier_amount_mismatch' END,
      CASE WHEN item_count > 3 AND total > 500 THEN 'bulk_purchase' END) AS fraud_flags
  FROM flagged_m),
scored_m AS (SELECT *, least(raw_score, 1e0) AS fraud_score, raw_score >= 0.5e0 AS is_fraud FROM raw_m)"""

CLICKS = """clicks_m AS (
  SELECT event_id, user_id AS session_id, CASE WHEN user_id % 10 >= 3 THEN CAST(user_id AS VARCHAR) END AS customer_id,
    event_type AS action, CAST(floor(value * 1000e0 + 0.5e0) AS BIGINT) AS duration_ms, ts AS "timestamp" FROM events)"""

ORDER_ITEMS = f"""{ORDERS}, {ITEMS},
order_items_m AS (SELECT i.*, o.customer_id, o.status, o.order_date, o.total FROM items_m i JOIN orders_m o USING (order_id))"""

PRODUCTS = f"""{SOURCE_ITEMS},
medians_m AS (SELECT product_id, median(price) AS median_price FROM source_items GROUP BY 1),
products_m AS (
  SELECT p_partkey AS product_id, {CATEGORY} AS category, {r('coalesce(median_price, 50e0)')} AS unit_price, p_size AS stock_level
  FROM part LEFT JOIN medians_m ON product_id = p_partkey)"""

INTERACTIONS = f"""{SOURCE_ITEMS},
inter_m AS (
  SELECT 'person-' || c_custkey AS customer_id, product_id, count(order_id) AS purchase_count, {total('price')} AS total_spend
  FROM source_items JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON o_orderkey = order_id
  JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)"""

KPIS = f"""{SCORED},
kpis AS (
  SELECT order_date, count(order_id) AS total_orders, {total('total')} AS gross_revenue, {mean('total')} AS avg_order_value,
    count(DISTINCT customer_id) AS unique_customers, count(*) FILTER (status = 'confirmed') AS confirmed_orders,
    count(*) FILTER (status = 'failed') AS failed_orders, {mean('fraud_score')} AS avg_fraud_score,
    count(*) FILTER (fraud_score >= 0.5e0) AS flagged_orders,
    count(*) FILTER (status = 'confirmed') / CAST(count(order_id) AS DOUBLE) AS conversion_rate,
    count(*) FILTER (fraud_score >= 0.5e0) / CAST(count(order_id) AS DOUBLE) AS fraud_rate
  FROM scored_m GROUP BY 1)"""

KPI_REPORT = f"""order_date, total_orders, {r('gross_revenue')} AS gross_revenue, {r('avg_order_value')} AS avg_order_value,
  unique_customers, {r('conversion_rate*100e0', 1)} AS conversion_rate_pct, {r('fraud_rate*100e0', 2)} AS fraud_rate_pct"""

CLV = f"""{ORDERS},
clv AS (
  SELECT *, CASE WHEN total_spend > 500 THEN 'high' WHEN total_spend > 150 THEN 'medium' ELSE 'low' END AS clv_segment FROM (
    SELECT customer_id, count(order_id) AS order_count, {total('total')} AS total_spend, {mean('total')} AS avg_order_value,
      min(created_at) AS first_order, max(created_at) AS last_order, count(DISTINCT order_date) AS active_days
    FROM orders_m WHERE status = 'confirmed' GROUP BY 1))"""

COHORTS = f"""{ORDERS},
firsts AS (SELECT customer_id, CAST(date_trunc('month', min(order_date)) AS DATE) AS cohort_month
  FROM orders_m WHERE status = 'confirmed' GROUP BY 1),
activity AS (SELECT DISTINCT o.customer_id, CAST(date_trunc('month', order_date) AS DATE) AS activity_month, cohort_month
  FROM orders_m o JOIN firsts USING (customer_id) WHERE status = 'confirmed')"""

STATE_REVENUE = f"""{ORDERS}, {STATES},
state_rev AS (
  SELECT shipping_state, count(order_id) AS total_orders, {total('total')} AS gross_revenue, {mean('total')} AS avg_order_value,
    count(DISTINCT customer_id) AS unique_customers
  FROM orders_m LEFT JOIN states_m USING (customer_id) WHERE status = 'confirmed' AND shipping_state IS NOT NULL GROUP BY 1)"""

DOT = "list_dot_product(u.embedding::DOUBLE[], i.embedding::DOUBLE[])"


def ranked(k: int, seen: str = "") -> str:
    """Top k per user by dot product; `seen` is an anti-join condition."""
    return f"""ranked AS (
  SELECT u.vec_id AS customer_id, i.vec_id AS product_id, {DOT} AS score,
    row_number() OVER (PARTITION BY u.vec_id ORDER BY {DOT} DESC, i.vec_id) AS rank
  FROM embeddings u CROSS JOIN embeddings i {seen}
  QUALIFY row_number() OVER (PARTITION BY u.vec_id ORDER BY {DOT} DESC, i.vec_id) <= {k})"""


SEEN = "WHERE NOT EXISTS (SELECT 1 FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_custkey = u.vec_id AND l_partkey = i.vec_id)"

NORM = "sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))"

REQUESTS = """req AS (
  SELECT c_custkey AS customer_id, CAST(least(coalesce(CASE WHEN c_custkey % 26 <> 0 THEN c_custkey % 26 END, 5), 20) AS INTEGER) AS n,
    CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'toys' WHEN 'MACHINERY' THEN 'computers_acc' WHEN 'BUILDING' THEN 'no_such_thing' ELSE '' END AS category
  FROM customer)"""

RESPONSES = f"""{ORDERS}, {PRODUCTS}, {REQUESTS},
counts_m AS (SELECT l_orderkey AS order_id, count(*) AS item_count FROM lineitem GROUP BY 1),
spend AS (SELECT customer_id, {total('coalesce(total, 0e0)')} / greatest(CAST(sum(coalesce(item_count, 0)) AS BIGINT), 1) AS avg_spend
  FROM orders_m LEFT JOIN counts_m USING (order_id) GROUP BY 1),
{ranked(200)},
popular AS (SELECT vec_id AS product_id, {NORM} AS score, row_number() OVER (ORDER BY {NORM} DESC, vec_id) AS rank
  FROM embeddings QUALIFY row_number() OVER (ORDER BY {NORM} DESC, vec_id) <= 200),
pool AS (
  SELECT q.customer_id, n, category AS wanted, product_id, score, rank, 'als_personalised' AS strategy
  FROM req q JOIN ranked USING (customer_id) WHERE rank <= least(n * 8, 200)
  UNION ALL
  SELECT q.customer_id, n, category, product_id, score, rank, 'als_popular'
  FROM req q CROSS JOIN popular WHERE rank <= least(n * 8, 200) AND q.customer_id NOT IN (SELECT vec_id FROM embeddings)),
judged AS (
  SELECT pool.*, category, unit_price, stock_level, avg_spend,
    CASE WHEN unit_price IS NULL OR coalesce(avg_spend, 0e0) = 0 OR unit_price BETWEEN avg_spend * 0.4e0 AND avg_spend * 1.6e0 THEN 1
      WHEN unit_price BETWEEN avg_spend * 0.2e0 AND avg_spend * 3e0 THEN 2 END AS step
  FROM pool LEFT JOIN products_m USING (product_id) LEFT JOIN spend USING (customer_id)
  WHERE wanted = '' OR coalesce(lower(category), '') LIKE '%' || replace(wanted, '_', '\\_') || '%' ESCAPE '\\'),
picked AS (
  SELECT customer_id, n, strategy, product_id, {r('least(score, 0.99e0)', 3)} AS score, category, unit_price, stock_level, avg_spend,
    row_number() OVER (PARTITION BY customer_id ORDER BY step, rank) AS place
  FROM judged WHERE step IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY step, rank) <= n),
shelf AS (SELECT *, row_number() OVER (ORDER BY product_id) AS place FROM products_m QUALIFY row_number() OVER (ORDER BY product_id) <= 20),
answers AS (
  SELECT * FROM picked
  UNION ALL
  SELECT q.customer_id, n, 'catalog_fallback', product_id, NULL, s.category, unit_price, stock_level, avg_spend, place
  FROM req q CROSS JOIN shelf s LEFT JOIN spend ON spend.customer_id = q.customer_id
  WHERE place <= n AND q.customer_id NOT IN (SELECT customer_id FROM picked)),
response_rows AS (
  SELECT customer_id, CAST(count(*) OVER (PARTITION BY customer_id) AS INTEGER) AS "count", strategy,
    CASE WHEN avg_spend <> 0 THEN {r('avg_spend')} END AS avg_spend_per_item, product_id, score, CAST(place AS INTEGER) AS rank,
    category, unit_price, stock_level, strategy AS source
  FROM answers)"""

LABEL_VALUES = """labels_m(label_key, step, lo, hi, label) AS (VALUES
  ('toys', 1, 0e0, 30e0, 'Budget Toy Set'), ('toys', 2, 30e0, 70e0, 'Activity Play Set'), ('toys', 3, 70e0, 999e0, 'Premium RC Toy'),
  ('health_beauty', 1, 0e0, 25e0, 'Daily Skincare Kit'), ('health_beauty', 2, 25e0, 60e0, 'Beauty Essentials Set'), ('health_beauty', 3, 60e0, 999e0, 'Premium Beauty Bundle'),
  ('furniture_decor', 1, 0e0, 40e0, 'Decorative Accent'), ('furniture_decor', 2, 40e0, 80e0, 'Home Décor Set'), ('furniture_decor', 3, 80e0, 999e0, 'Statement Furniture Piece'),
  ('computers_accessories', 1, 0e0, 50e0, 'PC Accessory'), ('computers_accessories', 2, 50e0, 150e0, 'Computer Peripheral Kit'), ('computers_accessories', 3, 150e0, 999e0, 'Tech Bundle'),
  ('housewares', 1, 0e0, 40e0, 'Kitchen Essential'), ('housewares', 2, 40e0, 80e0, 'Home Utility Set'), ('housewares', 3, 80e0, 999e0, 'Premium Kitchenware'))"""


def label(category: str, price: str) -> str:
    return f"""coalesce(
    (SELECT min_by(label, step) FROM labels_m l WHERE l.label_key = {category} AND coalesce({price}, 0e0) >= lo AND coalesce({price}, 0e0) < hi),
    (SELECT max_by(label, step) FROM labels_m l WHERE l.label_key = {category}), {category})"""


def velocity(source: str) -> str:
    """Windows over (order_id, customer_id, created_at, total) of `source`."""
    return f"""windows_m AS (
  SELECT order_id, customer_id,
    count(*) OVER (PARTITION BY customer_id ORDER BY created_at RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS orders_in_window,
    CAST(sum({units('total')}) OVER (PARTITION BY customer_id ORDER BY created_at
      RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND CURRENT ROW) AS DOUBLE)/10000e0 AS spend_in_window
  FROM {source})"""


EVENT_ORDERS = "event_orders AS (SELECT event_id AS order_id, user_id AS customer_id, ts AS created_at, value AS total FROM events)"


def decisions(alerts: str, limit: str) -> str:
    """Velocity score and decision for `alerts` (order_id, total, fraud_score, fraud_flags) joined to windows_m."""
    return f"""checked AS (
  SELECT a.order_id, a.customer_id, w.orders_in_window, w.spend_in_window, a.fraud_score, a.fraud_flags,
    {r('w.spend_in_window + a.total', 4)} AS spend
  FROM {alerts} a JOIN windows_m w USING (order_id)),
velo AS (
  SELECT *, least(0e0 + CASE WHEN orders_in_window >= 3 THEN 0.4e0 ELSE 0e0 END + CASE WHEN spend > {limit} THEN 0.35e0 ELSE 0e0 END, 1e0) AS v
  FROM checked),
decided AS (
  SELECT order_id, customer_id, orders_in_window, spend_in_window,
    CASE WHEN least(fraud_score + v, 1e0) >= 0.7e0 THEN 'BLOCK' WHEN least(fraud_score + v, 1e0) >= 0.5e0 THEN 'REVIEW' ELSE 'PASS' END AS fraud_decision,
    {r('least(fraud_score + v, 1e0)', 4)} AS combined_fraud_score,
    concat_ws(',', CASE WHEN fraud_flags <> '' THEN fraud_flags END,
      CASE WHEN orders_in_window >= 3 THEN 'velocity_orders_' || orders_in_window || '_in_1h' END,
      CASE WHEN spend > {limit} THEN 'spend_limit_exceeded_' || CAST(round_even(spend, 0) AS BIGINT) END) AS all_fraud_flags
  FROM velo)"""


ORDER_DECISIONS = f"""{SCORED}, {velocity('orders_m')},
alerts AS (SELECT * FROM scored_m WHERE is_fraud), {decisions('alerts', '1000e0')}"""

STOCK = """stock_m AS (
  SELECT event_id, user_id AS product_id, CASE WHEN event_type <> 'error' THEN event_type END AS category,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS current_stock, CAST(json_extract_string(props, '$.k') AS INTEGER) - 50 AS delta,
    'wh-' || (event_id % 7) AS warehouse_id, ts AS "timestamp" FROM events)"""

LATEST_STOCK = f"""{STOCK},
latest_m AS (
  SELECT product_id, arg_min(coalesce(category, 'unknown'), ("timestamp", event_id)) AS category,
    arg_max(current_stock, ("timestamp", event_id)) AS stock_level, max("timestamp") AS last_updated,
    arg_max(warehouse_id, ("timestamp", event_id)) AS warehouse_id
  FROM stock_m GROUP BY 1)"""


def series(period_s: int, stat: str) -> str:
    value = {"sum": total("value"), "max": "max(value)", "avg": mean("value")}[stat]
    return f"""series AS (
  SELECT event_type AS metric, time_bucket(INTERVAL {period_s} SECONDS, ts, TIMESTAMP '1970-01-01') AS window_start, {value} AS stat
  FROM events GROUP BY 1, 2)"""


def alarm(name: str, period_s: int, stat: str, test: str, periods: int) -> str:
    run = f"""QUALIFY lag(window_start, {periods - 1}) OVER (PARTITION BY metric ORDER BY window_start)
      = window_start - INTERVAL {(periods - 1) * period_s} SECONDS""" if periods > 1 else ""
    return f"""WITH {series(period_s, stat)}
SELECT '{name}' AS alarm, metric, window_start, stat FROM series WHERE stat {test} {run}"""


SESSIONS = f"""{CLICKS},
gaps AS (SELECT *, coalesce("timestamp" - lag("timestamp") OVER s > INTERVAL 1800 SECONDS, true) AS opens
  FROM clicks_m WINDOW s AS (PARTITION BY session_id ORDER BY "timestamp", event_id)),
numbered AS (SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY session_id ORDER BY "timestamp", event_id) AS no FROM gaps),
sessions_m AS (
  SELECT session_id, min("timestamp") AS first_seen, max("timestamp") AS last_seen, count(*) AS event_count,
    CAST(floor(epoch_us(max("timestamp")) / 1e6) AS BIGINT) + 1800 AS expires_at,
    coalesce(arg_min(struct_pack(c := customer_id), ("timestamp", event_id)).c, 'anonymous') AS customer_id
  FROM numbered GROUP BY session_id, no)"""

FUNNEL = f"""{CLICKS}, dated AS (SELECT *, CAST("timestamp" AS DATE) AS event_date FROM clicks_m)"""


def category_report(limit: str = "") -> str:
    return f"""WITH {ORDER_ITEMS}
SELECT category, count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS units_sold,
  {r(total('quantity * unit_price'))} AS gross_revenue, {r(mean('unit_price'))} AS avg_unit_price, {r(mean('freight_value'))} AS avg_freight,
  {r('100e0 * ' + mean('freight_value') + '/ nullif(' + mean('unit_price') + ', 0e0)', 1)} AS freight_to_price_pct
FROM order_items_m WHERE status = 'confirmed' GROUP BY 1 ORDER BY gross_revenue DESC, category {limit}"""


def fraud_days(n: int) -> str:
    return f"""{SCORED}, days AS (
  SELECT order_date, count(*) AS total_orders, count(*) FILTER (fraud_score >= 0.5e0) AS flagged_orders,
    {r('100e0 * count(*) FILTER (fraud_score >= 0.5e0) / count(*)', 2)} AS fraud_rate_pct, {r(mean('fraud_score'), 4)} AS avg_fraud_score,
    {r('coalesce(CAST(sum(' + units('total') + ') FILTER (fraud_score >= 0.5e0) AS DOUBLE)/10000e0, 0e0)')} AS flagged_revenue
  FROM scored_m GROUP BY 1 ORDER BY 1 DESC LIMIT {n})"""


HISTORY = f"WITH {EVENT_ORDERS}, {velocity('event_orders')}"

ORACLE: dict[str, str] = {
    "p1_clean_clicks": f"""WITH {CLICKS},
doubled AS (SELECT * FROM clicks_m UNION ALL SELECT * REPLACE ("timestamp" + INTERVAL 1 SECOND AS "timestamp") FROM clicks_m),
firsts AS (SELECT * FROM doubled QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY "timestamp") = 1)
SELECT *, CAST("timestamp" AS DATE) AS event_date, CAST(hour("timestamp") AS INTEGER) AS event_hour,
  customer_id IS NOT NULL AS is_authenticated FROM firsts""",
    "p2_clean_orders": f"""WITH {SCORED}, {STATES}
SELECT order_id, customer_id, status, total, fraud_score, order_date, shipping_state, payment_method AS shipping_city
FROM scored_m LEFT JOIN states_m USING (customer_id)""",
    "p3_enrich_clicks": f"""WITH {CLICKS}
SELECT event_id, CAST(hour("timestamp") AS INTEGER) AS hour_of_day, dayname("timestamp") AS day_of_week,
  isodow("timestamp") >= 6 AS is_weekend, customer_id IS NOT NULL AS is_authenticated FROM clicks_m""",
    "p4_explode_items": f"""WITH {ORDER_ITEMS}
SELECT order_id, customer_id, product_id, category, unit_price, quantity, freight_value FROM order_items_m""",
    "p5_unnest_sql": f"""WITH {ORDER_ITEMS}
SELECT order_id, product_id, quantity * unit_price AS line_value FROM order_items_m WHERE status = 'confirmed'""",
    "p6_confirmed_orders": f"WITH {ORDERS} SELECT order_id, customer_id, total FROM orders_m WHERE status = 'confirmed'",
    "p7_recent_orders": f"""WITH {ORDERS}
SELECT order_id, order_date, total FROM orders_m WHERE order_date >= (SELECT max(order_date) FROM orders_m) - 30""",
    "p8_confirmed_with_state": f"""WITH {ORDERS}, {STATES}
SELECT order_id, shipping_state, total FROM orders_m JOIN states_m USING (customer_id)
WHERE status = 'confirmed' AND shipping_state IS NOT NULL""",
    "p9_training_orders": """SELECT o_orderkey AS order_id, o_custkey AS customer_id, 'delivered' AS order_status
FROM orders WHERE o_orderstatus = 'F'""",
    "p10_primary_payments": """SELECT o_orderkey AS order_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto' WHEN '3-MEDIUM' THEN 'voucher'
    WHEN '4-NOT SPECIFIED' THEN 'crypto' ELSE 'debit_card' END AS payment_type, o_totalprice AS payment_value FROM orders""",
    "p11_j1_product_categories": f"SELECT p_partkey AS product_id, {CATEGORY} AS category FROM part",
    "p12_value_maps": f"""WITH {ORDERS}
SELECT order_id, CASE payment_method WHEN 'crypto' THEN 'credit_card' ELSE payment_method END AS payment_method, status FROM orders_m""",
    "p13_live_orders": f"""WITH {SCORED}
SELECT order_id, CAST(total AS VARCHAR) AS total, CAST({r('fraud_score', 4)} AS VARCHAR) AS fraud_score, CAST(item_count AS INTEGER) AS item_count,
  CAST(epoch_us(created_at) // 1000000 AS BIGINT) + 7776000 AS ttl FROM scored_m
WHERE epoch_us(created_at) // 1000000 + 7776000 > (SELECT max(epoch_us(created_at) // 1000000) FROM scored_m)""",
    "j2_catalogue": f"WITH {PRODUCTS} SELECT product_id, category, unit_price, 0 AS stock_level FROM products_m",
    "j3_customer_tiers": f"""SELECT c_custkey AS customer_id, coalesce(n, 1) AS order_count, {tier('coalesce(n, 1)')} AS tier
FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
    "j4_orders_with_payment": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'processing' ELSE 'canceled' END AS order_status,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'boleto' WHEN '3-MEDIUM' THEN 'voucher'
    WHEN '4-NOT SPECIFIED' THEN 'crypto' ELSE 'debit_card' END AS payment_type FROM orders""",
    "j5_training_interactions": f"""WITH {INTERACTIONS}
SELECT *, CAST(ln(1e0 + purchase_count) AS FLOAT) AS implicit_rating FROM inter_m""",
    "j6_built_orders": f"""WITH {ORDERS}, {SOURCE_ITEMS},
sums AS (SELECT order_id, count(*) AS item_count, {r(total('price'))} AS subtotal FROM source_items GROUP BY 1),
priced AS (
  SELECT *, {r('subtotal - discount')} AS total FROM (
    SELECT *, {r('subtotal * CASE order_id % 5 WHEN 3 THEN 0.05e0 WHEN 4 THEN 0.10e0 ELSE 0e0 END')} AS discount FROM sums)),
people AS (
  SELECT c_custkey AS customer_id, {tier('coalesce(n, 1)')} AS customer_tier, c_mktsegment AS city, n_name AS state FROM customer
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey)
SELECT p.order_id, o.customer_id, coalesce(customer_tier, 'bronze') AS customer_tier, CAST(item_count AS INTEGER) AS item_count, subtotal, discount, p.total,
  CASE payment_method WHEN 'crypto' THEN 'credit_card' ELSE payment_method END AS payment_method,
  coalesce(city, 'unknown') AS city, coalesce(state, 'XX') AS state, status,
  p.total > 500 OR (coalesce(customer_tier, 'bronze') = 'bronze' AND p.total > 200) AS is_suspicious
FROM priced p JOIN orders_m o USING (order_id) LEFT JOIN people USING (customer_id)""",
    "j7_cohort_activity": f"WITH {COHORTS} SELECT * FROM activity",
    "j8_scored_with_metadata": f"""WITH {PRODUCTS}, {ranked(5)}
SELECT customer_id, CAST(rank AS INTEGER) AS rank, product_id, category, unit_price, stock_level
FROM ranked LEFT JOIN products_m USING (product_id)""",
    "j9_unseen_scores": f"""WITH {ranked(20, SEEN)}
SELECT customer_id, product_id, {r('score', 6)} AS score, CAST(rank AS INTEGER) AS rank FROM ranked""",
    "j10_product_labels": f"""WITH {ITEMS}, {LABEL_VALUES},
labelled AS (
  SELECT category, unit_price, coalesce(hit, last, category) AS product_label FROM items_m
  LEFT JOIN (SELECT label_key, label AS hit, lo, hi FROM labels_m) l ON l.label_key = category AND unit_price >= lo AND unit_price < hi
  LEFT JOIN (SELECT label_key AS k, max_by(label, step) AS last FROM labels_m GROUP BY 1) m ON m.k = category)
SELECT category, product_label, count(*) AS n, min(unit_price) AS lowest, max(unit_price) AS highest FROM labelled GROUP BY 1, 2""",
    "j11_order_history": f"{HISTORY} SELECT * FROM windows_m",
    "a1_daily_kpis": f"WITH {KPIS} SELECT * FROM kpis",
    "a2_customer_clv": f"WITH {CLV} SELECT * FROM clv",
    "a3_product_interactions": f"""WITH {ORDER_ITEMS}
SELECT customer_id, product_id, count(order_id) AS purchase_count, CAST(sum(quantity) AS BIGINT) AS total_quantity,
  {total('quantity * unit_price')} AS total_spend,
  {r('ln(1e0 + count(order_id) * CAST(sum(quantity) AS BIGINT))', 6)} AS implicit_rating FROM order_items_m GROUP BY 1, 2""",
    "a4_training_ratings": f"WITH {INTERACTIONS} SELECT *, {r('CAST(CAST(ln(1e0 + purchase_count) AS FLOAT) AS DOUBLE)', 4)} AS implicit_rating FROM inter_m",
    "a5_state_revenue": f"WITH {STATE_REVENUE} SELECT * FROM state_rev",
    "a6_median_prices": f"WITH {SOURCE_ITEMS} SELECT product_id, {r('median(price)', 4)} AS unit_price FROM source_items GROUP BY 1",
    "a7_order_tiers": f"SELECT o_custkey AS customer_id, count(*) AS order_count, {tier('count(*)', 5, 3, 2)} AS tier FROM orders GROUP BY 1",
    "a8_collected_items": f"""WITH {SOURCE_ITEMS}
SELECT order_id, CAST(count(*) AS INTEGER) AS n_items,
  string_agg(CAST(product_id AS VARCHAR), ',' ORDER BY product_id) AS product_ids FROM source_items GROUP BY 1""",
    "a9_order_totals": f"""WITH {SOURCE_ITEMS}
SELECT order_id, {r(total('price'))} AS subtotal, 0e0 AS discount, {r(total('price'))} AS total, count(*) AS item_count
FROM source_items GROUP BY 1""",
    "a10_spend_per_item": f"""WITH {SCORED}
SELECT customer_id, {total('total')} / greatest(CAST(sum(item_count) AS BIGINT), 1) AS avg_spend_per_item FROM scored_m GROUP BY 1""",
    "a11_conditional_rates": f"""WITH {SCORED}
SELECT payment_method, count(*) FILTER (status = 'confirmed') AS confirmed, count(*) FILTER (status = 'failed') AS failed,
  count(*) FILTER (is_fraud) AS flagged, {r('100e0 * count(*) FILTER (is_fraud) / count(*)')} AS flagged_pct FROM scored_m GROUP BY 1""",
    "a12_distinct_counts": f"""WITH {ORDER_ITEMS}
SELECT count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers, count(DISTINCT product_id) AS products,
  count(DISTINCT order_date) AS days FROM order_items_m""",
    "a13_interaction_counts": f"""WITH {INTERACTIONS}
SELECT count(*) AS interactions, count(DISTINCT customer_id) AS customers, count(DISTINCT product_id) AS products FROM inter_m""",
    "a14_list_summary": f"""WITH {RESPONSES}
SELECT customer_id, array_to_string(list_sort(list_distinct(list(category)))[1:3], ',') AS categories,
  min(unit_price) AS min_price, max(unit_price) AS max_price FROM response_rows GROUP BY 1""",
    "w2_orders_last_hour": f"{HISTORY} SELECT order_id, orders_in_window FROM windows_m",
    "w3_spend_last_day": f"{HISTORY} SELECT order_id, spend_in_window FROM windows_m",
    "w5_first_months": f"WITH {COHORTS} SELECT customer_id, cohort_month FROM firsts",
    "f1_f7_time_functions": """SELECT event_id, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour,
  strftime(ts, '%Y-%m-%d %H:00') AS hour_label, CAST(date_trunc('month', ts) AS DATE) AS month, dayname(ts) AS weekday,
  isodow(ts) >= 6 AS weekend, date_diff('month', DATE '2023-11-01', CAST(date_trunc('month', ts) AS DATE)) AS months FROM events""",
    "f8_f13_number_functions": f"""SELECT l_orderkey, l_linenumber, l_partkey, {r('l_extendedprice/7e0', 0)} AS r0, {r('l_extendedprice/7e0', 1)} AS r1,
  {r('l_extendedprice/7e0', 3)} AS r3, {r('ln(1e0 + l_quantity)', 6)} AS log1p_qty, l_extendedprice / nullif(l_discount, 0e0) AS guarded,
  least(l_discount * 20e0, 1e0) AS capped, greatest(l_quantity - 25e0, 0e0) AS floored,
  l_extendedprice BETWEEN 20000e0 * 0.4e0 AND 20000e0 * 1.6e0 AS in_band FROM lineitem""",
    "f14_array_functions": f"""WITH {ORDERS}, {ITEMS}
SELECT o.order_id, CAST(count(i.order_id) AS INTEGER) AS n_items,
  CAST(coalesce(sum(CAST(floor(quantity * unit_price * 100e0 + 0.5e0) AS BIGINT)), 0) AS DOUBLE) / 100e0 AS value
FROM orders_m o LEFT JOIN items_m i USING (order_id) GROUP BY 1""",
    "f15_f17_text_functions": """SELECT p_partkey, replace(lower(p_name), ' ', '_') AS key, contains(lower(p_name), 'ring') AS has_ring,
  array_to_string(list_transform(string_split(p_name, ' '), lambda w : upper(w[1]) || w[2:]), ' ') AS label,
  substring(p_name, 1, 8) AS short, CAST(CAST(round_even(p_retailprice / 2e0, 0) AS BIGINT) AS VARCHAR) AS whole FROM part""",
    "f18_vector_functions": f"""SELECT vec_id, {r(NORM, 6)} AS norm,
  {r('list_dot_product(embedding::DOUBLE[], list_reverse(embedding)::DOUBLE[])', 6)} AS dot_reversed FROM embeddings""",
    "f22_json_fields": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  json_extract_string(props, '$.k') AS k_text FROM events""",
    "t1_fraud_scores": f"WITH {SCORED} SELECT order_id, {r('fraud_score', 4)} AS fraud_score, fraud_flags, is_fraud FROM scored_m",
    "t2_stored_orders": f"""WITH {SCORED}
SELECT order_id, customer_id, status, CAST(total AS VARCHAR) AS total, CAST({r('fraud_score', 4)} AS VARCHAR) AS fraud_score, payment_method,
  CAST(item_count AS INTEGER) AS item_count, CAST(epoch_us(created_at) // 1000000 AS BIGINT) + 7776000 AS ttl FROM scored_m""",
    "t3_fraud_alerts": f"""WITH {SCORED}
SELECT order_id, customer_id, total, {r('fraud_score', 4)} AS fraud_score, created_at AS "timestamp" FROM scored_m WHERE is_fraud""",
    "t4_order_events": f"""WITH {ORDERS} SELECT order_id, customer_id, status, total, created_at AS "timestamp" FROM orders_m""",
    "t5_fraud_decisions": f"WITH {ORDER_DECISIONS} SELECT * EXCLUDE (customer_id) FROM decided",
    "t5_event_decisions": f"""WITH {EVENT_ORDERS}, {velocity('event_orders')},
alerts AS (SELECT event_id AS order_id, user_id AS customer_id, value AS total, CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100e0 AS fraud_score,
  'error_event' AS fraud_flags FROM events WHERE event_type = 'error'), {decisions('alerts', '150e0')}
SELECT * EXCLUDE (customer_id) FROM decided""",
    "s12_latest_orders": f"""WITH {ORDERS}
SELECT order_id, customer_id, CASE status WHEN 'pending' THEN 'confirmed' ELSE status END AS status, total,
  CASE status WHEN 'pending' THEN 2 ELSE 1 END AS version FROM orders_m""",
    "s13_merged_decisions": f"""WITH {ORDER_DECISIONS}
SELECT s.order_id, s.customer_id, total, fraud_decision, combined_fraud_score FROM scored_m s LEFT JOIN decided d USING (order_id)""",
    "t8_click_sessions": f"WITH {SESSIONS} SELECT * FROM sessions_m",
    "t9_latest_stock": f"WITH {LATEST_STOCK} SELECT * FROM latest_m",
    "t9_stock_alerts": f"""WITH {STOCK}, low AS (
  SELECT product_id, coalesce(category, 'unknown') AS category, current_stock, delta,
    CASE WHEN current_stock <= 3 THEN 'CRITICAL' ELSE 'WARNING' END AS severity, warehouse_id, "timestamp"
  FROM stock_m WHERE current_stock <= 10)
SELECT *, 'Low Inventory [' || severity || '] — ' || category || ' / ' || product_id AS subject FROM low""",
    "t9_stocked_products": f"""WITH {PRODUCTS}, {LATEST_STOCK}
SELECT coalesce(p.product_id, l.product_id) AS product_id, coalesce(p.category, l.category) AS category, p.unit_price,
  coalesce(l.stock_level, p.stock_level) AS stock_level, l.last_updated, l.warehouse_id
FROM products_m p FULL JOIN latest_m l ON p.product_id = l.product_id""",
    "t10_error_alarms": alarm("errors", 300, "sum", ">= 5e0", 1),
    "t10_backlog_alarms": alarm("backlog", 3600, "max", "> 20e0", 3),
    "t10_mean_alarms": alarm("mean", 3600, "avg", "> 15e0", 2),
    "t10_metric_series": f"WITH {series(300, 'sum')} SELECT * FROM series",
    "r1_dense_ids": """SELECT count(DISTINCT l_partkey) AS n, count(DISTINCT l_partkey) AS n_ids, 0 AS lowest,
  CAST(count(DISTINCT l_partkey) - 1 AS INTEGER) AS highest FROM lineitem""",
    "r2_als_factors": f"""WITH {INTERACTIONS}
SELECT 'customer' AS kind, count(DISTINCT customer_id) AS n, 64 AS length FROM inter_m
UNION ALL SELECT 'product', count(DISTINCT product_id), 64 FROM inter_m""",
    "r2_held_out_measures": f"""WITH days_m AS (
  SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1),
counted_m AS (SELECT d, coalesce(sum(n) OVER (ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER () AS n_all FROM days_m),
cut_m AS (SELECT coalesce(min(d) FILTER (before >= 0.8e0 * n_all), max(d)) AS cut FROM counted_m),
pairs_m AS (
  SELECT o_custkey AS customer_id, l_partkey AS product_id, min(CAST(o_orderdate AS DATE)) AS first
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2),
early_m AS (SELECT * FROM pairs_m, cut_m WHERE first < cut),
late_m AS (SELECT * FROM pairs_m, cut_m WHERE first >= cut),
{ranked(20, "WHERE NOT EXISTS (SELECT 1 FROM early_m e WHERE e.customer_id = u.vec_id AND e.product_id = i.vec_id)")},
each_m AS (
  SELECT l.customer_id, count(*) AS pairs, count(rank) AS hits, sum(rank) AS ranks, min(rank) AS best
  FROM late_m l LEFT JOIN ranked r ON r.customer_id = l.customer_id AND r.product_id = l.product_id GROUP BY 1),
total_m AS (
  SELECT CAST(coalesce(sum(pairs), 0) AS BIGINT) AS pairs, count(*) AS customers, CAST(coalesce(sum(hits), 0) AS BIGINT) AS hits,
    CAST(sum(ranks) AS DOUBLE) AS ranks, count(best) AS with_hit, avg(coalesce(1e0 / best, 0e0)) AS mrr FROM each_m)
SELECT pairs, customers, hits, {r('CAST(hits AS DOUBLE) / nullif(pairs, 0)', 6)} AS recall,
  {r('CAST(with_hit AS DOUBLE) / nullif(customers, 0)', 6)} AS hit_rate, {r('ranks / nullif(hits, 0)', 6)} AS mean_rank,
  {r('mrr', 6)} AS mean_reciprocal_rank FROM total_m""",
    "r4_o5_personal_scores": f"""WITH {ranked(40)}
SELECT customer_id, product_id, {r('score', 6)} AS score, CAST(rank AS INTEGER) AS rank FROM ranked""",
    "r5_o6_popular_items": f"SELECT vec_id AS product_id, {r(NORM, 6)} AS score FROM embeddings ORDER BY {NORM} DESC, vec_id LIMIT 200",
    "r6_category_rows": f"""WITH {RESPONSES}
SELECT a.*, req.category AS asked_category FROM response_rows a JOIN req USING (customer_id) WHERE req.category <> ''""",
    "r9_fallback_rows": f"WITH {RESPONSES} SELECT * FROM response_rows WHERE strategy = 'catalog_fallback'",
    "r10_request_options": f"WITH {REQUESTS} SELECT * FROM req",
    "r11_bulk_lists": f"""WITH {PRODUCTS}, {ranked(20, SEEN)}
SELECT customer_id, CAST(least(20, (SELECT count(*) FROM embeddings)) AS INTEGER) AS n_popular, CAST(rank AS INTEGER) AS rank, product_id,
  {r('score', 4)} AS score, category, unit_price FROM ranked LEFT JOIN products_m USING (product_id)""",
    "r12_w4_recommendations": f"WITH {RESPONSES} SELECT * FROM response_rows",
    "r13_w7_display_rows": f"""WITH {RESPONSES}, {LABEL_VALUES},
last_m AS (SELECT label_key AS k, max_by(label, step) AS last FROM labels_m GROUP BY 1),
shown AS (
  SELECT a.*, max(score) OVER (PARTITION BY customer_id) AS best, l.label AS hit, m.last FROM response_rows a
  LEFT JOIN labels_m l ON l.label_key = category AND coalesce(unit_price, 0e0) >= lo AND coalesce(unit_price, 0e0) < hi
  LEFT JOIN last_m m ON m.k = category)
SELECT customer_id, rank, coalesce(hit, last, category, 'Product') AS product_label,
  replace(coalesce(category, 'unknown'), '_', ' ') AS category_text, substring(CAST(product_id AS VARCHAR), 1, 8) || '…' AS short_id,
  CASE WHEN strategy = 'als_personalised' AND best > 0 AND score IS NOT NULL
    THEN greatest(1, CAST(floor(score / best * 99e0 + 0.5e0) AS INTEGER)) END AS match_pct,
  coalesce('R$ ' || CAST(CAST(unit_price AS DECIMAL(18,2)) AS VARCHAR), '—') AS price_text,
  CASE WHEN stock_level > 0 THEN '✓ ' || stock_level || ' in stock' WHEN stock_level = 0 THEN 'Low stock' ELSE '' END AS stock_text,
  CASE source WHEN 'als_personalised' THEN 'ALS' WHEN 'als_popular' THEN 'Trending' ELSE 'Catalog' END AS source_text,
  CASE strategy WHEN 'als_personalised' THEN '🤖 ALS personalised' WHEN 'als_popular' THEN '⭐ Trending (new customer)' ELSE '📦 Catalog browse' END AS strategy_text,
  coalesce(' · avg spend R$' || CAST(floor(avg_spend_per_item + 0.5e0) AS BIGINT) || '/item · band R$' || CAST(floor(avg_spend_per_item * 0.4e0 + 0.5e0) AS BIGINT)
    || '–R$' || CAST(floor(avg_spend_per_item * 1.6e0 + 0.5e0) AS BIGINT), '') AS band_text
FROM shown""",
    "q1_daily_revenue": f"""WITH {KPIS}
SELECT {KPI_REPORT} FROM kpis WHERE order_date >= (SELECT max(order_date) FROM kpis) - 30 ORDER BY order_date DESC""",
    "q1_o4_latest_revenue": f"WITH {KPIS} SELECT {KPI_REPORT} FROM kpis ORDER BY order_date DESC LIMIT 30",
    "q2_o2_top_products": f"""WITH {ORDER_ITEMS}
SELECT product_id, category, count(DISTINCT order_id) AS order_appearances, CAST(sum(quantity) AS BIGINT) AS units_sold,
  {r(total('quantity * unit_price'))} AS revenue, {r(mean('freight_value'))} AS avg_freight
FROM order_items_m WHERE status = 'confirmed' AND order_date >= (SELECT max(order_date) FROM orders_m) - 7
GROUP BY 1, 2 ORDER BY revenue DESC, product_id LIMIT 20""",
    "q3_category_revenue": category_report(),
    "q3_o3_top_categories": category_report("LIMIT 15"),
    "q4_state_revenue": f"""WITH {STATE_REVENUE}
SELECT shipping_state, total_orders, {r('gross_revenue')} AS gross_revenue, {r('avg_order_value')} AS avg_order_value, unique_customers,
  {r('gross_revenue / nullif(CAST(unique_customers AS DOUBLE), 0e0)')} AS revenue_per_customer FROM state_rev ORDER BY gross_revenue DESC""",
    "q5_w1_payment_breakdown": f"""WITH {SCORED}
SELECT payment_method, count(*) AS order_count, {r('100e0 * count(*) / sum(count(*)) OVER ()', 1)} AS share_pct,
  {r(mean('total'))} AS avg_order_value, {r(total('total'))} AS total_revenue, {r(mean('fraud_score'), 4)} AS avg_fraud_score
FROM scored_m WHERE status = 'confirmed' GROUP BY 1""",
    "q6_cohort_retention": f"""WITH {COHORTS}
SELECT cohort_month, date_diff('month', cohort_month, activity_month) AS period_number, count(DISTINCT customer_id) AS active_customers
FROM activity GROUP BY 1, 2""",
    "q7_freight_by_state": f"""WITH {ORDER_ITEMS}, {STATES}
SELECT shipping_state, count(DISTINCT order_id) AS orders, {r(mean('total'))} AS avg_order_value, {r(mean('freight_value'))} AS avg_freight,
  {r('100e0 * ' + mean('freight_value') + ' / nullif(' + mean('total') + ', 0e0)', 1)} AS freight_pct_of_order
FROM order_items_m JOIN states_m USING (customer_id) WHERE status = 'confirmed' AND shipping_state IS NOT NULL GROUP BY 1""",
    "q8_fraud_by_day": f"WITH {fraud_days(30)} SELECT * FROM days",
    "q8_w8_fraud_trend": f"""WITH {fraud_days(14)}
SELECT order_date, total_orders, flagged_orders, avg_fraud_score, fraud_rate_pct,
  {r('CAST((SELECT sum(' + units('fraud_rate_pct') + ') FROM days) AS DOUBLE) / (SELECT count(*) FROM days) / 10000e0', 4)} AS mean_fraud_pct FROM days""",
    "q9_click_funnel": f"""WITH {FUNNEL}
SELECT event_date, action, count(*) AS event_count, count(DISTINCT session_id) AS unique_sessions, count(DISTINCT customer_id) AS authenticated_users,
  {r('avg(duration_ms) / 1000e0', 1)} AS avg_duration_sec
FROM dated WHERE event_date >= (SELECT max(event_date) FROM dated) - 7 GROUP BY 1, 2""",
    "q9_w6_funnel_share": f"""WITH {CLICKS}
SELECT action, count(*) AS event_count, count(DISTINCT session_id) AS sessions, {r('avg(duration_ms) / 1000e0', 1)} AS avg_sec,
  {r('count(*) / CAST(max(count(*)) OVER () AS DOUBLE)', 4)} AS share_of_first FROM clicks_m GROUP BY 1""",
    "q10_hourly_orders": f"""WITH {ORDERS}
SELECT strftime(created_at, '%Y-%m-%d %H:00') AS hour, count(*) AS orders, {r(total('total'))} AS revenue, count(DISTINCT customer_id) AS customers
FROM orders_m WHERE order_date >= (SELECT max(order_date) FROM orders_m) - 1 GROUP BY 1""",
    "q11_clv_segments": f"""WITH {CLV}
SELECT clv_segment, count(*) AS customer_count, {r(mean('total_spend'))} AS avg_clv, {r('avg(order_count)', 1)} AS avg_orders,
  {r('min(total_spend)')} AS min_spend, {r('max(total_spend)')} AS max_spend FROM clv GROUP BY 1""",
    "s1_click_scan": f"WITH {CLICKS} SELECT event_id, action, CAST(duration_ms AS INTEGER) AS duration_ms, customer_id FROM clicks_m",
    "s2_ndjson_scan": f"""WITH {SCORED}, {STATES}
SELECT order_id, status, total, shipping_state AS state, CAST(item_count AS INTEGER) AS n_items
FROM scored_m LEFT JOIN states_m USING (customer_id)""",
    "s7_envelope_alerts": """SELECT event_id, CASE WHEN value >= 1 THEN CAST(user_id AS VARCHAR) END AS customer_id,
  CASE WHEN value >= 1 THEN value END AS total, CASE WHEN value < 1 THEN 'unreadable' END AS problem FROM events""",
    "s8_partitioned_overwrite": """SELECT CAST(ts AS DATE) AS event_date, count(*) AS n, count(DISTINCT event_id) AS n_ids
FROM events GROUP BY 1""",
    "s9_lake_kpis": f"WITH {KPIS} SELECT * FROM kpis",
    "s11_sql_over_views": f"""WITH {ORDER_ITEMS}
SELECT category, count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS units_sold, max(freight_value) AS max_freight
FROM order_items_m WHERE status = 'confirmed' GROUP BY 1""",
    "s14_stored_catalogue": f"WITH {PRODUCTS} SELECT * FROM products_m",
    "s15_quarantined_messages": """SELECT event_id,
  CASE event_type WHEN 'view' THEN 'missing product_id,current_stock' ELSE 'unreadable' END AS problem
FROM events WHERE event_type IN ('error', 'signup', 'view') OR value < 1""",
    "r3_factor_tables": f"""SELECT vec_id AS customer_id, CAST(len(embedding) AS INTEGER) AS length,
  {r('CAST(embedding[1] AS DOUBLE)', 6)} AS "first" FROM embeddings""",
    "t4_order_event_stream": f"WITH {ORDERS} SELECT status, count(*) AS n, count(*) AS n_orders FROM orders_m GROUP BY 1",
    "t12_unique_click_stream": f"WITH {CLICKS} SELECT event_id, action, CAST(duration_ms AS INTEGER) AS duration_ms FROM clicks_m",
}

# Files and streams must give what the batch operators give.
ORACLE["s4_stored_interactions"] = ORACLE["a3_product_interactions"]
ORACLE["s5_csv_catalogue"] = ORACLE["j2_catalogue"]
ORACLE["t2_order_stream"] = ORACLE["t1_fraud_scores"]
ORACLE["t5_decision_stream"] = ORACLE["t5_fraud_decisions"]
ORACLE["t5_state_decisions"] = ORACLE["t5_fraud_decisions"]
ORACLE["t6_enriched_click_stream"] = ORACLE["p3_enrich_clicks"]
ORACLE["t7_session_stream"] = ORACLE["t8_click_sessions"]
ORACLE["t10_alarm_stream"] = ORACLE["t10_backlog_alarms"]
ORACLE["t9_stock_level_stream"] = ORACLE["t9_latest_stock"]
ORACLE["t9_stock_alert_stream"] = ORACLE["t9_stock_alerts"]

# A lake built by runs, and reports on its views, must give what the tables give.
ORACLE.update({name: ORACLE[same] for name, same in SAME_AS.items()})
