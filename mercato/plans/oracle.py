"""DuckDB SQL oracle for every registered query.

The SQL restates each operator in its plain, literal form (global windows,
materialised fan-out joins, self-joins on aggregates) over the same mapping of
the driver tables, so it checks the Spark formulations (range-bucketed rank,
pre-aggregated fan-out, window-free first purchase) rather than repeating them.

Type conventions match the Spark side: money is summed as DECIMAL and shown as
DOUBLE, year/month/day parts and day differences are INTEGER, counts BIGINT.
"""

from __future__ import annotations

from mercato.plans.queries import ABC_FILTER_CLASS, PERIOD_END, PERIOD_START

# name -> (sql, dependencies)
_CTE: dict[str, tuple[str, tuple[str, ...]]] = {}


def _cte(name: str, sql: str, *deps: str) -> None:
    _CTE[name] = (sql, deps)


PRICE = "CAST(l_extendedprice AS DECIMAL(18,2))"
FREIGHT = f"CAST({PRICE} * l_tax AS DECIMAL(18,4))"

# ------------------------------------------------------------------ silver mapping
_cte("ship", """SELECT l_orderkey, MIN(l_shipdate) AS first_ship, MAX(l_shipdate) AS last_ship
FROM lineitem GROUP BY l_orderkey""")
_cte("s_orders", """SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
  CASE o.o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'P' THEN 'canceled'
                       WHEN 'O' THEN 'shipped' END AS order_status,
  o.o_orderdate AS order_purchase_timestamp,
  o.o_orderdate + INTERVAL 1 DAY AS order_approved_at,
  s.first_ship AS order_delivered_carrier_date,
  CASE WHEN o.o_orderstatus = 'F' THEN s.last_ship END AS order_delivered_customer_date,
  o.o_orderdate + to_days(CAST(o.o_orderkey % 90 - 5 AS INTEGER)) AS order_estimated_delivery_date
FROM orders o LEFT JOIN ship s ON s.l_orderkey = o.o_orderkey""", "ship")
_cte("s_items", f"""SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
  l_partkey AS product_id, l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
  {PRICE} AS price, {FREIGHT} AS freight_value
FROM lineitem""")
_cte("s_payments", f"""SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
  l_returnflag AS payment_type, 1 AS payment_installments,
  CAST({PRICE} + {FREIGHT} AS DECIMAL(18,4)) AS payment_value
FROM lineitem""")
_cte("s_customers", """SELECT c.c_custkey AS customer_id, c.c_custkey AS customer_unique_id,
  CAST((c.c_custkey * 37) % 110000 AS INTEGER) AS customer_zip_code_prefix,
  CASE WHEN c.c_custkey % 50 <> 0 THEN c.c_mktsegment END AS customer_city,
  n.n_name AS customer_state
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
_cte("s_products", """SELECT p_partkey AS product_id, p_type AS product_category_name,
  CAST(length(p_name) AS INTEGER) AS product_name_length,
  CAST(length(p_brand) AS INTEGER) AS product_description_length,
  CAST(p_partkey % 5 AS INTEGER) AS product_photos_qty,
  CAST(p_size AS INTEGER) AS product_weight_g, CAST(p_size AS INTEGER) AS product_length_cm,
  CAST(p_size AS INTEGER) AS product_height_cm, CAST(p_size AS INTEGER) AS product_width_cm
FROM part""")
_cte("s_category", """SELECT DISTINCT p_type AS product_category_name,
  lower(p_type) AS product_category_name_english
FROM part WHERE p_type <> 'ECONOMY'""")
_cte("s_sellers", """SELECT s.s_suppkey AS seller_id,
  CAST((s.s_suppkey * 37) % 110000 AS INTEGER) AS seller_zip_code_prefix,
  r.r_name AS seller_city, n.n_name AS seller_state
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey""")
_cte("s_reviews", """SELECT event_id AS review_id, event_id * 2 AS order_id,
  CAST(floor(value) % 5 + 1 AS INTEGER) AS review_score,
  CAST(NULL AS VARCHAR) AS review_comment_title, CAST(NULL AS VARCHAR) AS review_comment_message,
  ts AS review_creation_date, CAST(NULL AS TIMESTAMP) AS review_answer_timestamp
FROM events""")

# ------------------------------------------------------------------ conformance
_cte("items_dedup", """SELECT order_id, order_item_id, product_id, seller_id,
  shipping_limit_date, price, freight_value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id, order_item_id ORDER BY
    product_id NULLS FIRST, seller_id NULLS FIRST, shipping_limit_date NULLS FIRST,
    price NULLS FIRST, freight_value NULLS FIRST) AS rn FROM s_items) WHERE rn = 1""", "s_items")
_cte("orders_flagged", """SELECT *,
  COALESCE(order_delivered_customer_date < order_purchase_timestamp, false)
    AS flag_delivered_before_purchase,
  COALESCE(order_estimated_delivery_date < order_purchase_timestamp, false)
    AS flag_estimated_before_purchase,
  COALESCE(order_purchase_timestamp > CAST(current_timestamp AS TIMESTAMP), false)
    AS flag_future_purchase
FROM s_orders""", "s_orders")
_cte("orders_dedup", """SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY customer_id NULLS FIRST,
    order_status NULLS FIRST, order_purchase_timestamp NULLS FIRST,
    order_approved_at NULLS FIRST, order_delivered_carrier_date NULLS FIRST,
    order_delivered_customer_date NULLS FIRST, order_estimated_delivery_date NULLS FIRST,
    flag_delivered_before_purchase NULLS FIRST, flag_estimated_before_purchase NULLS FIRST,
    flag_future_purchase NULLS FIRST) AS rn
  FROM orders_flagged) WHERE rn = 1""", "orders_flagged")
_cte("pay_agg", """SELECT order_id, SUM(payment_value) AS total_payment
FROM s_payments WHERE payment_value >= 0 GROUP BY order_id""", "s_payments")
_cte("item_agg", """SELECT order_id, SUM(price) AS total_items, SUM(freight_value) AS total_freight,
  SUM(price) + SUM(freight_value) AS total_items_freight
FROM items_dedup WHERE price >= 0 AND freight_value >= 0 GROUP BY order_id""", "items_dedup")
_cte("orders_fin", """SELECT o.*, p.total_payment, i.total_items, i.total_freight,
  i.total_items_freight,
  COALESCE(round(p.total_payment, 2) <> round(i.total_items_freight, 2), false)
    AS flag_financial_inconsistency
FROM orders_dedup o LEFT JOIN pay_agg p USING (order_id) LEFT JOIN item_agg i USING (order_id)""",
     "orders_dedup", "pay_agg", "item_agg")
_cte("orders_measured", """SELECT *,
  CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE),
                 CAST(order_delivered_customer_date AS DATE)) AS INTEGER) AS delivery_days,
  CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE),
                 CAST(order_estimated_delivery_date AS DATE)) AS INTEGER) AS estimated_delivery_days,
  COALESCE(order_delivered_customer_date > order_estimated_delivery_date, false) AS flag_delayed,
  CASE WHEN COALESCE(order_delivered_customer_date > order_estimated_delivery_date, false)
       THEN CAST(date_diff('day', CAST(order_estimated_delivery_date AS DATE),
                           CAST(order_delivered_customer_date AS DATE)) AS INTEGER)
       ELSE 0 END AS delay_days
FROM orders_fin""", "orders_fin")
_cte("customers_clean", """SELECT customer_id, customer_unique_id,
  CASE WHEN customer_zip_code_prefix BETWEEN 1000 AND 99999 THEN customer_zip_code_prefix END
    AS customer_zip_code_prefix,
  COALESCE(customer_city, 'unknown') AS customer_city,
  COALESCE(customer_state, 'unknown') AS customer_state
FROM s_customers""", "s_customers")

# ------------------------------------------------------------------ gold
_cte("fact_orders", """SELECT o.order_id, o.customer_id, c.customer_state, c.customer_city,
  o.order_status, o.order_purchase_timestamp,
  CAST(o.order_purchase_timestamp AS DATE) AS purchase_date, o.order_approved_at,
  o.order_delivered_carrier_date, o.order_delivered_customer_date,
  o.order_estimated_delivery_date, o.total_payment, o.total_items, o.total_freight,
  o.total_items_freight, o.delivery_days, o.estimated_delivery_days, o.flag_delayed,
  o.delay_days, o.flag_financial_inconsistency, o.flag_delivered_before_purchase,
  o.flag_estimated_before_purchase, o.flag_future_purchase
FROM orders_measured o LEFT JOIN s_customers c USING (customer_id)""",
     "orders_measured", "s_customers")
_cte("dim_customers", """SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY customer_unique_id NULLS FIRST,
    customer_zip_code_prefix NULLS FIRST, customer_city NULLS FIRST,
    customer_state NULLS FIRST) AS rn FROM customers_clean) WHERE rn = 1""", "customers_clean")
_cte("dim_products", """SELECT * EXCLUDE (rn) FROM (
  SELECT p.product_id, p.product_category_name,
    COALESCE(t.product_category_name_english, 'uncategorized') AS product_category_name_english,
    p.product_name_length, p.product_description_length, p.product_photos_qty,
    p.product_weight_g, p.product_length_cm, p.product_height_cm, p.product_width_cm,
    ROW_NUMBER() OVER (PARTITION BY p.product_id ORDER BY p.product_category_name NULLS FIRST,
      COALESCE(t.product_category_name_english, 'uncategorized') NULLS FIRST,
      p.product_name_length NULLS FIRST, p.product_description_length NULLS FIRST,
      p.product_photos_qty NULLS FIRST, p.product_weight_g NULLS FIRST,
      p.product_length_cm NULLS FIRST, p.product_height_cm NULLS FIRST,
      p.product_width_cm NULLS FIRST) AS rn
  FROM s_products p LEFT JOIN s_category t USING (product_category_name)) WHERE rn = 1""",
     "s_products", "s_category")
_cte("dim_sellers", """SELECT * EXCLUDE (rn) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY seller_id ORDER BY seller_zip_code_prefix NULLS FIRST,
    seller_city NULLS FIRST, seller_state NULLS FIRST) AS rn FROM s_sellers) WHERE rn = 1""",
     "s_sellers")
_cte("dim_dates", """SELECT date, CAST(year(date) AS INTEGER) AS year,
  CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
  CAST(weekofyear(date) AS INTEGER) AS week, CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, dayofweek(date) IN (0, 6) AS is_weekend
FROM (SELECT DISTINCT CAST(order_purchase_timestamp AS DATE) AS date FROM s_orders
      WHERE order_purchase_timestamp IS NOT NULL)""", "s_orders")
_cte("fact_order_items", """SELECT i.order_id, i.order_item_id, i.product_id, i.seller_id,
  s.seller_state, p.product_category_name_english, i.shipping_limit_date, i.price,
  i.freight_value, i.price + i.freight_value AS total_value
FROM s_items i LEFT JOIN dim_products p USING (product_id)
LEFT JOIN dim_sellers s USING (seller_id)""", "s_items", "dim_products", "dim_sellers")

# ------------------------------------------------------------------ marts
_YM = ("CAST(year(order_purchase_timestamp) AS INTEGER) AS year, "
       "CAST(month(order_purchase_timestamp) AS INTEGER) AS month")


def _rank_pick(q: float, col: str) -> str:
    """Value at 1-based rank ceil(q * n) among non-null values (exact percentile)."""
    return (f"MAX(CASE WHEN rn = GREATEST(1, CAST(ceil(CAST({q} AS DOUBLE) * n) AS BIGINT)) "
            f"THEN {col} END)")


_cte("mr_ranked", f"""SELECT {_YM}, order_id, total_payment,
  CASE WHEN total_payment IS NOT NULL THEN ROW_NUMBER() OVER (
    PARTITION BY year(order_purchase_timestamp), month(order_purchase_timestamp),
      total_payment IS NULL ORDER BY total_payment) END AS rn,
  COUNT(total_payment) OVER (PARTITION BY year(order_purchase_timestamp),
    month(order_purchase_timestamp)) AS n
FROM fact_orders WHERE order_status <> 'canceled'""", "fact_orders")
_cte("mr_base", f"""SELECT year, month, SUM(total_payment) AS total_revenue,
  COUNT(order_id) AS total_orders,
  CAST(SUM(total_payment) AS DOUBLE) / NULLIF(COUNT(total_payment), 0) AS avg_order_value,
  {_rank_pick(0.5, 'total_payment')} AS median_order_value,
  {_rank_pick(0.9, 'total_payment')} AS p90_order_value
FROM mr_ranked GROUP BY year, month""", "mr_ranked")
_cte("metrics_revenue", """SELECT *, CASE WHEN prev_month_revenue > 0 THEN round(
    (CAST(total_revenue AS DOUBLE) - CAST(prev_month_revenue AS DOUBLE))
    / CAST(prev_month_revenue AS DOUBLE) * 100, 2) END AS monthly_growth_pct
FROM (SELECT *, LAG(total_revenue) OVER (ORDER BY year, month) AS prev_month_revenue
      FROM mr_base)""", "mr_base")
_cte("metrics_revenue_by_state", """SELECT customer_state, SUM(total_payment) AS total_revenue,
  COUNT(order_id) AS total_orders,
  CAST(SUM(total_payment) AS DOUBLE) / NULLIF(COUNT(total_payment), 0) AS avg_order_value
FROM fact_orders WHERE order_status <> 'canceled' GROUP BY customer_state""", "fact_orders")
_cte("valid_items", """SELECT i.* FROM fact_order_items i
JOIN (SELECT DISTINCT order_id FROM fact_orders WHERE order_status <> 'canceled') v
  USING (order_id)""", "fact_order_items", "fact_orders")
_cte("metrics_revenue_by_category", """SELECT product_category_name_english,
  SUM(total_value) AS total_revenue, COUNT(order_id) AS total_orders,
  SUM(price) AS total_items_revenue, SUM(freight_value) AS total_freight_revenue
FROM valid_items GROUP BY product_category_name_english""", "valid_items")
_cte("metrics_revenue_by_seller", """SELECT seller_id, seller_state, SUM(price) AS total_revenue,
  COUNT(order_id) AS total_orders, COUNT(DISTINCT product_id) AS unique_products
FROM valid_items GROUP BY seller_id, seller_state""", "valid_items")
_cte("delivered", """SELECT * FROM fact_orders
WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL""", "fact_orders")
_cte("metrics_delivery", f"""SELECT *,
  round(CAST(total_delayed AS DOUBLE) / total_delivered * 100, 2) AS delay_rate_pct,
  round((1 - CAST(total_delayed AS DOUBLE) / total_delivered) * 100, 2) AS sla_compliance_pct
FROM (SELECT {_YM}, AVG(delivery_days) AS avg_delivery_days,
        AVG(estimated_delivery_days) AS avg_estimated_days,
        CAST(SUM(CAST(flag_delayed AS INTEGER)) AS BIGINT) AS total_delayed,
        COUNT(order_id) AS total_delivered, AVG(delay_days) AS avg_delay_days
      FROM delivered GROUP BY 1, 2)""", "delivered")
_cte("metrics_delivery_by_state", """SELECT *,
  round(CAST(total_delayed AS DOUBLE) / total_delivered * 100, 2) AS delay_rate_pct
FROM (SELECT customer_state, AVG(delivery_days) AS avg_delivery_days,
        CAST(SUM(CAST(flag_delayed AS INTEGER)) AS BIGINT) AS total_delayed,
        COUNT(order_id) AS total_delivered
      FROM delivered GROUP BY customer_state)""", "delivered")
_cte("metrics_cancellations", f"""SELECT *,
  round(CAST(total_canceled AS DOUBLE) / total_orders * 100, 2) AS cancellation_rate_pct
FROM (SELECT {_YM}, COUNT(order_id) AS total_orders,
        CAST(SUM(CASE WHEN order_status = 'canceled' THEN 1 ELSE 0 END) AS BIGINT) AS total_canceled,
        SUM(CASE WHEN order_status = 'canceled' THEN total_payment ELSE 0 END) AS lost_revenue
      FROM fact_orders GROUP BY 1, 2)""", "fact_orders")
_cte("metrics_reviews", f"""SELECT *,
  round(CAST(promoters - detractors AS DOUBLE) / total_reviews * 100, 2) AS nps
FROM (SELECT {_YM}, AVG(r.review_score) AS avg_score, COUNT(r.review_id) AS total_reviews,
        CAST(SUM(CASE WHEN r.review_score >= 4 THEN 1 ELSE 0 END) AS BIGINT) AS promoters,
        CAST(SUM(CASE WHEN r.review_score = 3 THEN 1 ELSE 0 END) AS BIGINT) AS neutrals,
        CAST(SUM(CASE WHEN r.review_score <= 2 THEN 1 ELSE 0 END) AS BIGINT) AS detractors
      FROM s_reviews r LEFT JOIN (SELECT order_id, order_purchase_timestamp FROM fact_orders) o
        USING (order_id)
      GROUP BY 1, 2)""", "s_reviews", "fact_orders")
_cte("review_items", """SELECT r.review_id, r.order_id, r.review_score, i.order_item_id,
  i.product_category_name_english
FROM s_reviews r LEFT JOIN fact_order_items i USING (order_id)""", "s_reviews", "fact_order_items")
_cte("metrics_reviews_by_category", """SELECT product_category_name_english,
  AVG(review_score) AS avg_score, COUNT(review_id) AS total_reviews
FROM review_items GROUP BY product_category_name_english""", "review_items")
_cte("customer_ltv", """SELECT *, CAST(year(first_purchase_date) AS INTEGER) AS year,
  CAST(month(first_purchase_date) AS INTEGER) AS month
FROM (SELECT customer_id, MIN(order_purchase_timestamp) AS first_purchase_date,
        COUNT(order_id) AS total_orders, SUM(total_payment) AS ltv
      FROM fact_orders GROUP BY customer_id)""", "fact_orders")
_cte("metrics_customers", """SELECT year, month, COUNT(customer_id) AS new_customers,
  CAST(SUM(ltv) AS DOUBLE) / NULLIF(COUNT(ltv), 0) AS avg_ltv
FROM customer_ltv GROUP BY year, month""", "customer_ltv")
_cte("first_purchase", """SELECT o.customer_id, o.order_id, o.order_purchase_timestamp,
  f.first_purchase_date
FROM fact_orders o LEFT JOIN (SELECT customer_id, MIN(order_purchase_timestamp)
  AS first_purchase_date FROM fact_orders GROUP BY customer_id) f USING (customer_id)""",
     "fact_orders")
_cte("metrics_cohort", """SELECT strftime(first_purchase_date, '%Y-%m') AS cohort_month,
  CAST(date_diff('month', date_trunc('month', first_purchase_date),
                 date_trunc('month', order_purchase_timestamp)) AS INTEGER) AS months_since_first,
  COUNT(DISTINCT customer_id) AS customers
FROM first_purchase GROUP BY 1, 2""", "first_purchase")
_cte("product_revenue", """SELECT product_id, product_category_name_english,
  SUM(price) AS total_revenue, COUNT(order_id) AS total_orders
FROM valid_items GROUP BY product_id, product_category_name_english""", "valid_items")
_cte("ranked_products", """SELECT *,
  ROW_NUMBER() OVER w AS rank,
  SUM(total_revenue) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_revenue,
  SUM(total_revenue) OVER () AS grand_total
FROM product_revenue
WINDOW w AS (ORDER BY total_revenue DESC NULLS LAST, product_id ASC NULLS FIRST)""",
     "product_revenue")
_cte("metrics_abc", """SELECT product_id, product_category_name_english, total_revenue, total_orders,
  rank,
  CAST(total_revenue AS DOUBLE) / CAST(grand_total AS DOUBLE) * 100 AS revenue_pct,
  CAST(running_revenue AS DOUBLE) / CAST(grand_total AS DOUBLE) * 100 AS cumulative_revenue_pct,
  CASE WHEN running_revenue * 100 <= grand_total * 80 THEN 'A'
       WHEN running_revenue * 100 <= grand_total * 95 THEN 'B' ELSE 'C' END AS abc_class
FROM ranked_products""", "ranked_products")
_cte("abc_detail", """SELECT abc_class, product_id, product_category_name_english,
  total_revenue, total_orders, round(revenue_pct, 2) AS revenue_pct,
  round(cumulative_revenue_pct, 2) AS cumulative_revenue_pct
FROM metrics_abc""", "metrics_abc")
_cte("metrics_cohort_ret", """SELECT *, CAST(customers AS DOUBLE) / MAX(CASE WHEN months_since_first = 0
  THEN customers END) OVER (PARTITION BY cohort_month) * 100 AS retention_pct
FROM metrics_cohort""", "metrics_cohort")


# ------------------------------------------------------------------ money columns
def _dbl(*cols: str) -> str:
    """``* REPLACE`` list casting money columns to DOUBLE."""
    return "REPLACE (" + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols) + ")"


FO_MONEY = ("total_payment", "total_items", "total_freight", "total_items_freight")
FOI_MONEY = ("price", "freight_value", "total_value")

# key -> (final select, dependencies)
_Q: dict[str, tuple[str, tuple[str, ...]]] = {}


def _q(key: str, sql: str, *deps: str) -> None:
    _Q[key] = (sql, deps)


def _period(start: tuple[int, int], end: tuple[int, int]) -> str:
    return (f"year * 100 + month BETWEEN {start[0] * 100 + start[1]} "
            f"AND {end[0] * 100 + end[1]}")


# S
_q("csv_scan_raw", "SELECT * FROM s_orders", "s_orders")
_q("csv_scan_bronze", """SELECT CAST(order_id AS VARCHAR) AS order_id, order_item_id,
  CAST(product_id AS VARCHAR) AS product_id, CAST(seller_id AS VARCHAR) AS seller_id,
  shipping_limit_date, CAST(price AS DOUBLE) AS price,
  CAST(freight_value AS DOUBLE) AS freight_value FROM s_items""", "s_items")
_q("parquet_scan_silver", f"SELECT * {_dbl('payment_value')} FROM s_payments", "s_payments")
_q("parquet_scan_gold", """SELECT order_id, customer_state, CAST(total_payment AS DOUBLE)
  AS total_payment FROM fact_orders WHERE order_status <> 'canceled'""", "fact_orders")
_q("csv_sink", "SELECT * FROM dim_customers", "dim_customers")
_q("parquet_sink_partitioned", f"""SELECT * {_dbl('price', 'freight_value')},
  CAST(year(shipping_limit_date) AS INTEGER) AS ingestion_year,
  CAST(month(shipping_limit_date) AS INTEGER) AS ingestion_month FROM s_items""", "s_items")
_q("parquet_sink", f"SELECT * {_dbl(*FOI_MONEY)} FROM fact_order_items", "fact_order_items")
_q("jdbc_sink", "SELECT * FROM dim_sellers", "dim_sellers")
_q("sql_source", """SELECT customer_state, COUNT(*) AS orders FROM fact_orders
WHERE order_status = 'delivered' GROUP BY customer_state""", "fact_orders")
_q("write_verify", """SELECT COUNT(*) AS written_rows, COUNT(*) AS expected_rows
FROM fact_orders""", "fact_orders")
_TABLE_COUNTS = """SELECT 'fact_orders' AS table_name, COUNT(*) AS total FROM fact_orders
UNION ALL SELECT 'fact_order_items', COUNT(*) FROM fact_order_items
UNION ALL SELECT 'dim_customers', COUNT(*) FROM dim_customers
UNION ALL SELECT 'dim_products', COUNT(*) FROM dim_products
UNION ALL SELECT 'dim_sellers', COUNT(*) FROM dim_sellers"""
_q("row_count_probe", _TABLE_COUNTS + "\nUNION ALL SELECT 'dim_dates', COUNT(*) FROM dim_dates",
   "fact_orders", "fact_order_items", "dim_customers", "dim_products", "dim_sellers", "dim_dates")

# Q


def _null_profile(table: str, cols: list[str]) -> str:
    parts = [f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, "
             f"COUNT(*) AS total_rows, round(CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS DOUBLE)"
             f" / NULLIF(COUNT(*), 0) * 100, 2) AS null_pct FROM {table}" for c in cols]
    return "\nUNION ALL ".join(parts)


_ORDER_COLS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp",
               "order_approved_at", "order_delivered_carrier_date",
               "order_delivered_customer_date", "order_estimated_delivery_date"]
_q("normalize_columns", "SELECT * FROM s_customers", "s_customers")
_q("dedup_full_row", "SELECT DISTINCT order_id, payment_type FROM s_payments", "s_payments")
_q("null_profile", _null_profile("s_orders", _ORDER_COLS), "s_orders")
_q("non_empty_guard", """SELECT COUNT(*) > 0 AS has_rows,
  COUNT(*) FILTER (WHERE NOT (COALESCE(trim(CAST(customer_id AS VARCHAR)), '') = ''
    AND COALESCE(trim(CAST(customer_unique_id AS VARCHAR)), '') = ''
    AND COALESCE(trim(CAST(customer_zip_code_prefix AS VARCHAR)), '') = ''
    AND COALESCE(trim(customer_city), '') = ''
    AND COALESCE(trim(customer_state), '') = '')) > 0 AS has_non_blank_row
FROM s_customers""", "s_customers")
_q("rename_typos", "SELECT * FROM s_products", "s_products")
_q("ingestion_metadata", """SELECT *, TIMESTAMP '2024-01-15 08:30:00' AS ingestion_date,
  CAST(2024 AS INTEGER) AS ingestion_year, CAST(1 AS INTEGER) AS ingestion_month FROM s_sellers""", "s_sellers")
_cte("messy_payments", """SELECT order_id, payment_sequential,
  CASE WHEN order_id % 11 <> 0 THEN payment_type END AS payment_type,
  CASE WHEN order_id % 7 = 0 THEN 'n/a' ELSE CAST(payment_value AS VARCHAR) END AS payment_value, 'web' AS channel
FROM s_payments""", "s_payments")


def _finding(column: str, expected: str | None, found: str | None) -> str:
    text = {None: "CAST(NULL AS VARCHAR)"}
    nulls = f"COUNT(*) FILTER (WHERE {column} IS NULL)"
    bad = ("0" if expected in (None, "string") else
           f"COUNT(*) FILTER (WHERE {column} IS NOT NULL AND TRY_CAST({column} AS {expected}) IS NULL)")
    other = "ok" if expected == found else "other type"
    finding = (f"CASE WHEN {bad} > 0 THEN 'uncastable' WHEN {nulls} > 0 THEN 'null in required' ELSE '{other}' END"
               if expected else "'extra'")
    if found is None:
        nulls, bad, finding = "NULL", "NULL", "'missing'"
    return (f"SELECT '{column}' AS column_name, {text.get(expected, repr(expected))} AS expected_type, "
            f"{text.get(found, repr(found))} AS found_type, {finding} AS finding, COUNT(*) AS total_rows, "
            f"CAST({nulls} AS BIGINT) AS null_rows, CAST({bad} AS BIGINT) AS failed_casts FROM messy_payments")


_q("schema_contract", "\nUNION ALL ".join(_finding(*c) for c in (
    ("order_id", "string", "bigint"), ("payment_sequential", "int", "int"), ("payment_type", "string", "string"),
    ("payment_installments", "int", None), ("payment_value", "double", "string"), ("channel", None, "string"))),
   "messy_payments")
_q("cast_to_contract", """SELECT CAST(order_id AS VARCHAR) AS order_id, payment_sequential,
  payment_type, payment_installments, CAST(payment_value AS DOUBLE) AS payment_value
FROM s_payments""", "s_payments")
_q("drop_strict_nulls", """SELECT * FROM s_customers WHERE customer_id IS NOT NULL
  AND customer_unique_id IS NOT NULL AND customer_zip_code_prefix IS NOT NULL
  AND customer_city IS NOT NULL AND customer_state IS NOT NULL""", "s_customers")
_q("optional_null_profile", _null_profile("s_orders", _ORDER_COLS[4:]), "s_orders")
_q("dedup_by_key", f"SELECT * {_dbl('price', 'freight_value')} FROM items_dedup", "items_dedup")
_q("order_date_flags", """SELECT order_id, flag_delivered_before_purchase,
  flag_estimated_before_purchase, flag_future_purchase FROM orders_flagged""", "orders_flagged")
_q("invalid_date_count", """SELECT COUNT(*) FILTER (WHERE flag_delivered_before_purchase
  OR flag_estimated_before_purchase OR flag_future_purchase) AS invalid_dates,
  COUNT(*) AS total_orders FROM orders_flagged""", "orders_flagged")
_q("financial_flag", """SELECT order_id, CAST(total_payment AS DOUBLE) AS total_payment,
  CAST(total_items AS DOUBLE) AS total_items, CAST(total_freight AS DOUBLE) AS total_freight,
  CAST(total_items_freight AS DOUBLE) AS total_items_freight, flag_financial_inconsistency
FROM orders_fin""", "orders_fin")
_q("customer_rules", "SELECT * FROM customers_clean", "customers_clean")
_q("invalid_zip_count", """SELECT COUNT(*) FILTER (WHERE customer_zip_code_prefix IS NULL)
  AS invalid_zip, COUNT(*) AS total_customers FROM customers_clean""", "customers_clean")
_q("delivery_measures", """SELECT order_id,
  CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE),
                 CAST(order_delivered_customer_date AS DATE)) AS INTEGER) AS delivery_days,
  CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE),
                 CAST(order_estimated_delivery_date AS DATE)) AS INTEGER) AS estimated_delivery_days,
  COALESCE(order_delivered_customer_date > order_estimated_delivery_date, false) AS flag_delayed,
  CASE WHEN order_delivered_customer_date > order_estimated_delivery_date
       THEN CAST(date_diff('day', CAST(order_estimated_delivery_date AS DATE),
                           CAST(order_delivered_customer_date AS DATE)) AS INTEGER)
       ELSE 0 END AS delay_days
FROM s_orders""", "s_orders")
_q("default_category", """SELECT product_id, product_category_name, product_category_name_english
FROM dim_products""", "dim_products")
_q("item_total_value", """SELECT order_id, order_item_id, CAST(price AS DOUBLE) AS price,
  CAST(freight_value AS DOUBLE) AS freight_value, CAST(total_value AS DOUBLE) AS total_value
FROM fact_order_items""", "fact_order_items")
_q("period_label", """SELECT DISTINCT CAST(year(order_purchase_timestamp) AS INTEGER) AS year,
  CAST(month(order_purchase_timestamp) AS INTEGER) AS month,
  strftime(order_purchase_timestamp, '%Y-%m') AS period FROM fact_orders""", "fact_orders")
_q("id_abbreviation", """SELECT seller_id, substring(CAST(seller_id AS VARCHAR), 1, 8) || '...'
  AS seller_short FROM dim_sellers""", "dim_sellers")
_q("scalar_dates", """SELECT order_id, CAST(order_purchase_timestamp AS DATE) AS purchase_date,
  CAST(year(order_purchase_timestamp) AS INTEGER) AS year,
  CAST(month(order_purchase_timestamp) AS INTEGER) AS month,
  CAST(day(order_purchase_timestamp) AS INTEGER) AS day,
  CAST(weekofyear(order_purchase_timestamp) AS INTEGER) AS week,
  CAST(quarter(order_purchase_timestamp) AS INTEGER) AS quarter,
  CAST(dayofweek(order_purchase_timestamp) + 1 AS INTEGER) AS day_of_week,
  strftime(order_purchase_timestamp, '%Y-%m') AS year_month,
  CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE),
                 CAST(order_estimated_delivery_date AS DATE)) AS INTEGER) AS estimate_days,
  CAST(date_diff('month', date_trunc('month', order_purchase_timestamp),
                 date_trunc('month', order_estimated_delivery_date)) AS INTEGER) AS estimate_months
FROM s_orders""", "s_orders")
_q("scalar_strings", """SELECT seller_id, lower(trim(seller_city)) AS city_lower,
  regexp_replace(lower(seller_state), '[^a-z0-9]+', '_', 'g') AS state_slug,
  lpad(CAST(seller_zip_code_prefix AS VARCHAR), 5, '0') AS zip5,
  COALESCE(seller_city, 'unknown') AS city_or_unknown,
  substring(CAST(seller_id AS VARCHAR), 1, 3) || '...' AS seller_short3
FROM dim_sellers""", "dim_sellers")

# F
_MR = _dbl("total_revenue", "median_order_value", "p90_order_value", "prev_month_revenue")
_q("period_filter", f"SELECT * {_MR} FROM metrics_revenue WHERE {_period(PERIOD_START, PERIOD_END)}",
   "metrics_revenue")
_q("abc_class_filter", f"""SELECT * {_dbl('total_revenue')} FROM abc_detail
WHERE abc_class = '{ABC_FILTER_CLASS}'""", "abc_detail")

# J
_q("join_left_preagg", """SELECT o.order_id, o.order_status,
  CAST(p.total_payment AS DOUBLE) AS total_payment
FROM orders_dedup o LEFT JOIN pay_agg p USING (order_id)""", "orders_dedup", "pay_agg")
_q("join_left_broadcast", """SELECT p.product_category_name, p.product_id,
  t.product_category_name_english
FROM s_products p LEFT JOIN s_category t USING (product_category_name)""",
   "s_products", "s_category")
_q("join_semi_valid_orders", f"SELECT * {_dbl(*FOI_MONEY)} FROM valid_items", "valid_items")
_q("join_fanout_reviews", """SELECT order_id, review_id, review_score, order_item_id,
  product_category_name_english FROM review_items""", "review_items")
_q("first_purchase_window", "SELECT * FROM first_purchase", "first_purchase")

# A
_q("payments_per_order", f"SELECT * {_dbl('total_payment')} FROM pay_agg", "pay_agg")
_q("items_per_order", f"""SELECT * {_dbl('total_items', 'total_freight', 'total_items_freight')}
FROM item_agg""", "item_agg")
_q("metrics_revenue", f"SELECT * {_MR} FROM metrics_revenue", "metrics_revenue")
_q("metrics_revenue_exact", f"SELECT * {_MR} FROM metrics_revenue", "metrics_revenue")
_q("metrics_revenue_by_state", f"SELECT * {_dbl('total_revenue')} FROM metrics_revenue_by_state",
   "metrics_revenue_by_state")
_q("metrics_revenue_by_category", f"""SELECT *
  {_dbl('total_revenue', 'total_items_revenue', 'total_freight_revenue')}
FROM metrics_revenue_by_category""", "metrics_revenue_by_category")
_q("metrics_revenue_by_seller", f"SELECT * {_dbl('total_revenue')} FROM metrics_revenue_by_seller",
   "metrics_revenue_by_seller")
_q("metrics_delivery", "SELECT * FROM metrics_delivery", "metrics_delivery")
_q("metrics_delivery_by_state", "SELECT * FROM metrics_delivery_by_state",
   "metrics_delivery_by_state")
_q("metrics_cancellations", f"SELECT * {_dbl('lost_revenue')} FROM metrics_cancellations",
   "metrics_cancellations")
_q("metrics_reviews", "SELECT * FROM metrics_reviews", "metrics_reviews")
_q("metrics_reviews_by_category", "SELECT * FROM metrics_reviews_by_category",
   "metrics_reviews_by_category")
_q("metrics_customers", "SELECT * FROM metrics_customers", "metrics_customers")
_q("metrics_cohort", "SELECT * FROM metrics_cohort", "metrics_cohort")
_q("metrics_abc", f"SELECT * {_dbl('total_revenue')} FROM metrics_abc", "metrics_abc")
_q("customer_ltv", f"SELECT * {_dbl('ltv')} FROM customer_ltv", "customer_ltv")
_q("repurchase_rate", """SELECT COUNT(*) FILTER (WHERE total_orders > 1) AS recurrent_customers,
  COUNT(*) AS total_customers,
  COALESCE(round(CAST(COUNT(*) FILTER (WHERE total_orders > 1) AS DOUBLE)
    / NULLIF(COUNT(*), 0) * 100, 2), 0.0) AS repurchase_rate_pct
FROM customer_ltv""", "customer_ltv")
_q("product_revenue", f"SELECT * {_dbl('total_revenue')} FROM product_revenue", "product_revenue")
_q("revenue_grand_total", """SELECT CAST(SUM(total_revenue) AS DOUBLE) AS grand_total_revenue
FROM product_revenue""", "product_revenue")
_q("abc_class_counts", "SELECT abc_class, COUNT(*) AS products FROM metrics_abc GROUP BY abc_class",
   "metrics_abc")

# M
_q("dim_customers", "SELECT * FROM dim_customers", "dim_customers")
_q("dim_products", "SELECT * FROM dim_products", "dim_products")
_q("dim_sellers", "SELECT * FROM dim_sellers", "dim_sellers")
_q("dim_dates", "SELECT * FROM dim_dates", "dim_dates")
_q("fact_orders", f"SELECT * {_dbl(*FO_MONEY)} FROM fact_orders", "fact_orders")
_q("fact_order_items", f"SELECT * {_dbl(*FOI_MONEY)} FROM fact_order_items", "fact_order_items")

# W
_q("global_rank", """SELECT product_id, CAST(total_revenue AS DOUBLE) AS total_revenue, rank
FROM ranked_products""", "ranked_products")
_q("running_share", """SELECT product_id, rank, CAST(running_revenue AS DOUBLE) AS running_revenue,
  CAST(running_revenue AS DOUBLE) / CAST(grand_total AS DOUBLE) * 100 AS cumulative_revenue_pct
FROM ranked_products""", "ranked_products")

# D


def _label(select: str) -> str:
    return f"{select}, strftime(make_date(year, month, 1), '%Y-%m') AS period"


_q("overview_kpis", """SELECT
  CAST((SELECT SUM(total_revenue) FROM metrics_revenue) AS DOUBLE) AS total_revenue,
  CAST((SELECT SUM(total_orders) FROM metrics_revenue) AS BIGINT) AS total_orders,
  CAST((SELECT SUM(total_revenue) FROM metrics_revenue) AS DOUBLE)
    / (SELECT SUM(total_orders) FROM metrics_revenue) AS avg_ticket,
  round((SELECT AVG(delay_rate_pct) FROM metrics_delivery), 9) AS avg_delay_rate_pct""",
   "metrics_revenue", "metrics_delivery")
_q("overview_monthly_revenue",
   _label("SELECT year, month, CAST(total_revenue AS DOUBLE) AS total_revenue")
   + " FROM metrics_revenue", "metrics_revenue")
_q("overview_top_states", """SELECT customer_state, CAST(total_revenue AS DOUBLE) AS total_revenue
FROM metrics_revenue_by_state ORDER BY total_revenue DESC NULLS LAST, customer_state NULLS FIRST
LIMIT 10""", "metrics_revenue_by_state")
_q("overview_order_status", """SELECT order_status, COUNT(*) AS total FROM fact_orders
GROUP BY order_status""", "fact_orders")
_q("overview_nps_series", _label("SELECT year, month, nps") + " FROM metrics_reviews",
   "metrics_reviews")
_q("revenue_periods", _label("SELECT DISTINCT year, month") + " FROM metrics_revenue",
   "metrics_revenue")
_q("revenue_period_kpis", f"""SELECT CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue,
  CAST(SUM(total_orders) AS BIGINT) AS total_orders,
  CAST(SUM(total_revenue) AS DOUBLE) / SUM(total_orders) AS avg_ticket,
  round(AVG(CAST(median_order_value AS DOUBLE)), 9) AS median_ticket,
  round(AVG(CAST(p90_order_value AS DOUBLE)), 9) AS p90_ticket
FROM metrics_revenue WHERE {_period(PERIOD_START, PERIOD_END)}""", "metrics_revenue")
_q("revenue_period_series", _label(
    "SELECT year, month, CAST(total_revenue AS DOUBLE) AS total_revenue, monthly_growth_pct")
   + f" FROM metrics_revenue WHERE {_period(PERIOD_START, PERIOD_END)}", "metrics_revenue")
_q("revenue_growth_sign", _label("""SELECT year, month, monthly_growth_pct,
  CASE WHEN monthly_growth_pct >= 0 THEN 'positive' ELSE 'negative' END AS growth_sign""")
   + " FROM metrics_revenue", "metrics_revenue")
_q("revenue_state_map", """SELECT customer_state, CAST(total_revenue AS DOUBLE) AS total_revenue,
  total_orders FROM metrics_revenue_by_state""", "metrics_revenue_by_state")
_q("revenue_top_categories", """SELECT product_category_name_english,
  CAST(total_revenue AS DOUBLE) AS total_revenue FROM metrics_revenue_by_category
ORDER BY total_revenue DESC NULLS LAST, product_category_name_english NULLS FIRST LIMIT 15""",
   "metrics_revenue_by_category")
_q("cancellation_series", _label("""SELECT year, month, cancellation_rate_pct,
  CAST(lost_revenue AS DOUBLE) AS lost_revenue""") + " FROM metrics_cancellations",
   "metrics_cancellations")
_q("revenue_raw", f"SELECT * {_MR} FROM metrics_revenue", "metrics_revenue")
_q("logistics_kpis", """SELECT round(AVG(avg_delivery_days), 9) AS avg_delivery,
  round(AVG(delay_rate_pct), 9) AS avg_delay, round(AVG(sla_compliance_pct), 9) AS avg_sla,
  CAST(SUM(total_delayed) AS BIGINT) AS total_delayed,
  CAST(SUM(total_delivered) AS BIGINT) AS total_delivered FROM metrics_delivery""",
   "metrics_delivery")
_q("logistics_days_series", _label("SELECT year, month, avg_delivery_days, avg_estimated_days")
   + " FROM metrics_delivery", "metrics_delivery")
_q("logistics_delay_series", _label("SELECT year, month, delay_rate_pct")
   + " FROM metrics_delivery", "metrics_delivery")
_STATE_SEL = ("SELECT customer_state, avg_delivery_days, delay_rate_pct, total_delivered "
              "FROM metrics_delivery_by_state")
_q("logistics_by_state", _STATE_SEL, "metrics_delivery_by_state")
_q("logistics_slowest_states", _STATE_SEL + """
ORDER BY avg_delivery_days DESC NULLS LAST, customer_state NULLS FIRST LIMIT 10""",
   "metrics_delivery_by_state")
_q("logistics_most_delayed_states", _STATE_SEL + """
ORDER BY delay_rate_pct DESC NULLS LAST, avg_delivery_days DESC NULLS LAST,
  customer_state NULLS FIRST LIMIT 10""", "metrics_delivery_by_state")
_q("reviews_kpis", """SELECT round(AVG(nps), 9) AS avg_nps,
  round(SUM(avg_score * total_reviews) / SUM(total_reviews), 9) AS avg_score,
  CAST(SUM(total_reviews) AS BIGINT) AS total_reviews,
  CAST(SUM(promoters) AS BIGINT) AS promoters, CAST(SUM(detractors) AS BIGINT) AS detractors
FROM metrics_reviews""", "metrics_reviews")
_q("reviews_monthly", _label("""SELECT year, month, nps, avg_score, total_reviews,
  CASE WHEN nps >= 0 THEN 'positive' ELSE 'negative' END AS nps_sign""")
   + " FROM metrics_reviews", "metrics_reviews")
_q("nps_distribution", """SELECT CAST(SUM(promoters) AS BIGINT) AS promoters,
  CAST(SUM(neutrals) AS BIGINT) AS neutrals, CAST(SUM(detractors) AS BIGINT) AS detractors
FROM metrics_reviews""", "metrics_reviews")
_q("reviews_top_categories", """SELECT product_category_name_english, avg_score, total_reviews
FROM metrics_reviews_by_category WHERE product_category_name_english IS NOT NULL
ORDER BY avg_score DESC NULLS LAST, product_category_name_english LIMIT 20""",
   "metrics_reviews_by_category")
_q("reviews_raw", "SELECT * FROM metrics_reviews", "metrics_reviews")
_q("customer_kpis", """SELECT CAST(SUM(new_customers) AS BIGINT) AS total_customers,
  round(AVG(avg_ltv), 9) AS avg_ltv FROM metrics_customers""", "metrics_customers")
_q("recurrent_customers", """SELECT
  (SELECT COUNT(*) FROM (SELECT customer_id FROM fact_orders GROUP BY customer_id
                         HAVING COUNT(*) > 1) r) AS recurrent,
  (SELECT COUNT(DISTINCT customer_id) FROM fact_orders) AS total,
  COALESCE(round_even(CAST((SELECT COUNT(*) FROM (SELECT customer_id FROM fact_orders
      GROUP BY customer_id HAVING COUNT(*) > 1) r) AS DOUBLE)
    / NULLIF((SELECT COUNT(DISTINCT customer_id) FROM fact_orders), 0) * 100, 1), 0.0)
    AS rate_pct""", "fact_orders")
_q("customer_series", _label("SELECT year, month, new_customers, avg_ltv")
   + " FROM metrics_customers", "metrics_customers")


def _pivot(value: str, source: str) -> str:
    """One column for each of the fixed months since the first order, and all later cells in one column."""
    months = ", ".join(f"MAX(CASE WHEN months_since_first = {m} THEN {value} END) AS \"{m}\"" for m in range(84))
    cell = f"CAST(CAST({value} AS DECIMAL(18,6)) AS VARCHAR)"
    return (f"SELECT cohort_month, {months}, string_agg(months_since_first || '=' || {cell}, ';' "
            f"ORDER BY months_since_first) FILTER (WHERE months_since_first NOT BETWEEN 0 AND 83) AS later_months "
            f"FROM {source} GROUP BY cohort_month")


_q("cohort_matrix", _pivot("customers", "metrics_cohort"), "metrics_cohort")
_q("cohort_retention_pct", _pivot("retention_pct", "metrics_cohort_ret"), "metrics_cohort_ret")
_q("top_sellers", """SELECT s.seller_id, s.seller_city, s.seller_state,
  CAST(r.total_revenue AS DOUBLE) AS total_revenue, r.total_orders,
  substring(CAST(s.seller_id AS VARCHAR), 1, 8) || '...' AS seller_short
FROM metrics_revenue_by_seller r JOIN dim_sellers s ON r.seller_id = s.seller_id
ORDER BY r.total_revenue DESC NULLS LAST, s.seller_id NULLS FIRST LIMIT 10""",
   "metrics_revenue_by_seller", "dim_sellers")
_q("top_categories_by_volume", """SELECT product_category_name_english, total_orders,
  CAST(total_revenue AS DOUBLE) AS total_revenue FROM metrics_revenue_by_category
ORDER BY total_orders DESC NULLS LAST, total_revenue DESC NULLS LAST,
  product_category_name_english NULLS FIRST LIMIT 10""", "metrics_revenue_by_category")
_q("abc_summary", """SELECT abc_class, COUNT(*) AS total_products,
  CAST(SUM(total_revenue) AS DOUBLE) AS total_revenue FROM metrics_abc GROUP BY abc_class""",
   "metrics_abc")
_q("abc_detail", f"SELECT * {_dbl('total_revenue')} FROM abc_detail", "abc_detail")
_q("table_counts", _TABLE_COUNTS, "fact_orders", "fact_order_items", "dim_customers",
   "dim_products", "dim_sellers")
_FLAGS = """CAST(SUM(CAST(flag_financial_inconsistency AS INTEGER)) AS BIGINT) AS financial_inconsistency,
  CAST(SUM(CAST(flag_delayed AS INTEGER)) AS BIGINT) AS delayed,
  CAST(SUM(CAST(flag_delivered_before_purchase AS INTEGER)) AS BIGINT) AS delivered_before_purchase,
  CAST(SUM(CAST(flag_estimated_before_purchase AS INTEGER)) AS BIGINT) AS estimated_before_purchase,
  CAST(SUM(CAST(flag_future_purchase AS INTEGER)) AS BIGINT) AS future_purchase,
  COUNT(*) AS total"""
_q("flag_summary", f"SELECT {_FLAGS} FROM fact_orders", "fact_orders")
_q("flag_percentages", f"""SELECT total, flag, occurrences,
  CAST(occurrences AS DOUBLE) / NULLIF(total, 0) * 100 AS pct
FROM (UNPIVOT (SELECT {_FLAGS} FROM fact_orders)
      ON financial_inconsistency, delayed, delivered_before_purchase,
         estimated_before_purchase, future_purchase
      INTO NAME flag VALUE occurrences)""", "fact_orders")
# column, type and nullability of fact_orders
_CATALOG = [
    ("order_id", "bigint", "YES"), ("customer_id", "bigint", "YES"), ("customer_state", "string", "YES"),
    ("customer_city", "string", "YES"), ("order_status", "string", "YES"),
    ("order_purchase_timestamp", "timestamp_ntz", "YES"), ("purchase_date", "date", "YES"),
    ("order_approved_at", "timestamp_ntz", "YES"), ("order_delivered_carrier_date", "timestamp_ntz", "YES"),
    ("order_delivered_customer_date", "timestamp_ntz", "YES"),
    ("order_estimated_delivery_date", "timestamp_ntz", "YES"), ("total_payment", "decimal(28,4)", "YES"),
    ("total_items", "decimal(28,2)", "YES"), ("total_freight", "decimal(28,4)", "YES"),
    ("total_items_freight", "decimal(31,4)", "YES"), ("delivery_days", "int", "YES"),
    ("estimated_delivery_days", "int", "YES"), ("flag_delayed", "boolean", "NO"), ("delay_days", "int", "YES"),
    ("flag_financial_inconsistency", "boolean", "NO"), ("flag_delivered_before_purchase", "boolean", "NO"),
    ("flag_estimated_before_purchase", "boolean", "NO"), ("flag_future_purchase", "boolean", "NO")]
_q("schema_catalog", "\nUNION ALL ".join(
    f"""SELECT CAST({i + 1} AS INTEGER) AS ordinal_position, '{name}' AS column_name, '{kind}' AS data_type,
  '{nullable}' AS is_nullable, COUNT(*) AS total_rows, COUNT({name}) AS filled_rows FROM fact_orders"""
    for i, (name, kind, nullable) in enumerate(_CATALOG)), "fact_orders")
_q("adhoc_select", """SELECT order_status, COUNT(*) AS orders,
  CAST(SUM(total_payment) AS DOUBLE) AS revenue FROM fact_orders GROUP BY order_status""",
   "fact_orders")
_q("sellers_raw", f"SELECT * {_dbl('total_revenue')} FROM metrics_revenue_by_seller",
   "metrics_revenue_by_seller")
_q("cohort_raw", "SELECT cohort_month, months_since_first, customers FROM metrics_cohort",
   "metrics_cohort")


def _ordered_ctes(deps: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(name: str) -> None:
        if name in seen:
            return
        for d in _CTE[name][1]:
            visit(d)
        seen.append(name)

    for d in deps:
        visit(d)
    return seen


def build(key: str) -> str:
    final, deps = _Q[key]
    names = _ordered_ctes(deps)
    if not names:
        return final
    body = ",\n".join(f"{n} AS (\n{_CTE[n][0]}\n)" for n in names)
    return f"WITH {body}\n{final}"


def oracle_sql() -> dict[str, str]:
    return {key: build(key) for key in _Q}
