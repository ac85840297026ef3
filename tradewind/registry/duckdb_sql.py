"""SQL that states each query's expected result, for DuckDB.

Rounding is done on integers (hundredths), so it is exact and independent of
either engine's decimal division.
"""

from __future__ import annotations

import re

# Named building blocks; a query gets the ones it mentions.
_BLOCKS: dict[str, str] = {}


def hundredths(num: str, den: str, factor: int) -> str:
    """``num * factor / den`` rounded half away from zero, as a HUGEINT."""
    n, d = f"CAST(({num}) AS HUGEINT)", f"CAST(({den}) AS HUGEINT)"
    return (
        f"(CASE WHEN {d} <> 0 THEN CAST(sign({n}) * sign({d}) AS HUGEINT) * "
        f"((abs({n}) * {factor} * 2 + abs({d})) // (abs({d}) * 2)) END)"
    )


def two_places(num: str, den: str, factor: int) -> str:
    return f"CAST({hundredths(num, den, factor)} AS DOUBLE) / 100"


def pct(num: str, den: str) -> str:
    return two_places(num, den, 10_000)


def cents(amount: str) -> str:
    """A two-decimal amount as an integer."""
    return f"CAST(({amount}) * 100 AS HUGEINT)"


def month(ts: str) -> str:
    return f"CAST(date_trunc('month', {ts}) AS DATE)"


def iso(col: str) -> str:
    return f"CAST({col} AS VARCHAR)"


def iso_ts(col: str) -> str:
    return f"replace(CAST({col} AS VARCHAR), ' ', 'T')"


def dbl(col: str) -> str:
    return f"CAST({col} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def int4(expr: str) -> str:
    return f"CAST({expr} AS INTEGER)"


def title(text: str) -> str:
    """First character upper-cased in every run of letters and digits."""
    parts = rf"regexp_extract_all(lower({text}), '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+')"
    first = "replace(upper(w[1:1]), 'ẞ', 'ß')"
    return f"array_to_string([{first} || w[2:] for w in {parts}], '')"


_BLOCKS["raw_orders"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id,
       CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                          WHEN 'P' THEN 'canceled' END AS order_status,
       o_orderdate AS order_purchase_timestamp,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderdate END AS order_approved_at,
       o_orderdate + INTERVAL 365 DAY AS order_estimated_delivery_date,
       handover AS order_delivered_carrier_date,
       arrival AS order_delivered_customer_date
FROM orders LEFT JOIN (
  SELECT l_orderkey,
         min(l_shipdate) FILTER (WHERE l_returnflag <> 'N') AS handover,
         CASE WHEN bool_or(l_linestatus = 'F') THEN max(l_shipdate) END AS arrival
  FROM lineitem GROUP BY l_orderkey
) ON l_orderkey = o_orderkey
"""
_BLOCKS["raw_items"] = """
SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
       l_shipdate - to_days(CAST(l_quantity AS INTEGER)) AS shipping_limit_date,
       CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))
            AS DECIMAL(12,2)) AS freight_value
FROM lineitem
"""
_BLOCKS["raw_payments"] = """
SELECT l_orderkey AS order_id, l_returnflag AS payment_type,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2))
         * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
         AS DECIMAL(12,2)) AS payment_value
FROM lineitem
"""
_BLOCKS["raw_reviews"] = """
SELECT o_orderkey AS order_id, CAST(left(o_orderpriority, 1) AS INTEGER) AS review_score
FROM orders
"""
_BLOCKS["raw_customers"] = """
SELECT c_custkey AS customer_id, c_custkey // 2 AS customer_unique_id,
       lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
       'porto d''' || lower(c_mktsegment) AS customer_city, lower(n_name) AS customer_state
FROM customer JOIN nation ON c_nationkey = n_nationkey
"""
_BLOCKS["raw_sellers"] = """
SELECT s_suppkey AS seller_id, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
       lower(s_name) AS seller_city, lower(n_name) AS seller_state
FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""
_BLOCKS["raw_products"] = """
SELECT p_partkey AS product_id,
       CASE p_brand WHEN 'Brand#1' THEN '' WHEN 'Brand#2' THEN NULL ELSE p_type END
         AS product_category_name,
       CAST(p_size AS VARCHAR) AS product_weight_g,
       CASE WHEN p_brand = 'Brand#3' THEN '' ELSE CAST(p_size AS VARCHAR) END AS product_length_cm,
       CASE WHEN p_brand <> 'Brand#4' THEN CAST(p_size AS VARCHAR) END AS product_height_cm,
       CAST(CAST(trunc(p_retailprice) AS INTEGER) AS VARCHAR) AS product_width_cm
FROM part
"""
_BLOCKS["raw_translation"] = """
SELECT DISTINCT CASE WHEN p_type = 'ECONOMY' THEN 'ECONOMY CLASS' ELSE p_type END AS product_category_name,
       lower(CASE WHEN p_type = 'ECONOMY' THEN 'ECONOMY CLASS' ELSE p_type END) || '_goods'
         AS product_category_name_english
FROM part
"""
_BLOCKS["dim_customers"] = f"""
SELECT customer_unique_id, arg_max(customer_zip_code_prefix, customer_id) AS zip_code_prefix,
       {title("arg_max(customer_city, customer_id)")} AS city,
       upper(arg_max(customer_state, customer_id)) AS state
FROM raw_customers GROUP BY customer_unique_id
"""
_BLOCKS["dim_sellers"] = f"""
SELECT seller_id, seller_zip_code_prefix AS zip_code_prefix,
       {title("seller_city")} AS city, upper(seller_state) AS state
FROM raw_sellers
"""
_BLOCKS["dim_products"] = """
SELECT product_id, ifnull(product_category_name_english, 'unknown') AS category_english,
       TRY_CAST(product_weight_g AS INTEGER) AS weight_g,
       TRY_CAST(product_length_cm AS INTEGER) AS length_cm,
       TRY_CAST(product_height_cm AS INTEGER) AS height_cm,
       TRY_CAST(product_width_cm AS INTEGER) AS width_cm
FROM raw_products LEFT JOIN raw_translation USING (product_category_name)
"""
_BLOCKS["fact_orders"] = """
SELECT o.order_id, c.customer_unique_id, o.order_status,
       o.order_purchase_timestamp AS purchase_timestamp,
       o.order_approved_at AS approved_timestamp,
       o.order_delivered_carrier_date AS delivered_carrier_timestamp,
       o.order_delivered_customer_date AS delivered_customer_timestamp,
       o.order_estimated_delivery_date AS estimated_delivery_timestamp,
       CAST(coalesce((SELECT sum(i.price) FROM raw_items i WHERE i.order_id = o.order_id), 0)
            AS DECIMAL(18,2)) AS total_price,
       CAST(coalesce((SELECT sum(i.freight_value) FROM raw_items i WHERE i.order_id = o.order_id), 0)
            AS DECIMAL(18,2)) AS total_freight,
       CAST(coalesce((SELECT sum(p.payment_value) FROM raw_payments p WHERE p.order_id = o.order_id), 0)
            AS DECIMAL(18,2)) AS total_payment
FROM raw_orders o JOIN raw_customers c ON c.customer_id = o.customer_id
"""
_BLOCKS["valid_orders"] = """
SELECT *, CAST(date_trunc('month', purchase_timestamp) AS DATE) AS order_month
FROM fact_orders WHERE order_status NOT IN ('canceled', 'unavailable')
"""


def _days(start: str, end: str) -> str:
    return hundredths(f"epoch_us({end}) - epoch_us({start})", "86400000000", 100)


# Order states whose parcels are tracked.
_BLOCKS["tracked_statuses"] = "SELECT * FROM (VALUES ('delivered'), ('shipped')) AS t(order_status)"
_BLOCKS["fact_deliveries"] = f"""
SELECT o.order_id, i.seller_id, c.customer_unique_id,
       o.order_purchase_timestamp AS purchase_timestamp,
       o.order_delivered_customer_date AS delivered_customer_timestamp,
       o.order_estimated_delivery_date AS estimated_delivery_timestamp,
       {_days("o.order_purchase_timestamp", "o.order_delivered_customer_date")} AS actual_h,
       {_days("o.order_purchase_timestamp", "o.order_estimated_delivery_date")} AS estimated_h,
       {_days("o.order_estimated_delivery_date", "o.order_delivered_customer_date")} AS difference_h,
       CASE WHEN o.order_delivered_customer_date > o.order_estimated_delivery_date THEN 1 ELSE 0 END
         AS is_late
FROM raw_orders o
JOIN raw_customers c ON c.customer_id = o.customer_id
JOIN (SELECT DISTINCT order_id, seller_id FROM raw_items) i ON i.order_id = o.order_id
WHERE o.order_status IN (SELECT order_status FROM tracked_statuses)
"""
_BLOCKS["milestones"] = """
SELECT *, (is_late = 1 AND handed_late)::INTEGER AS is_seller_late,
       (is_late = 1 AND NOT handed_late)::INTEGER AS is_carrier_late
FROM (
  SELECT fact_deliveries.*, order_delivered_carrier_date AS carrier_handover_timestamp,
         shipping_limit_timestamp,
         ifnull(order_delivered_carrier_date > shipping_limit_timestamp, false) AS handed_late
  FROM fact_deliveries
  JOIN raw_orders USING (order_id)
  JOIN (SELECT order_id, seller_id, max(shipping_limit_date) AS shipping_limit_timestamp
        FROM raw_items GROUP BY ALL) USING (order_id, seller_id))
"""
_BLOCKS["ceo_base"] = """
SELECT order_month, CAST(count(order_id) AS BIGINT) AS total_orders,
       CAST(sum(total_payment) * 100 AS HUGEINT) AS revenue_c
FROM valid_orders GROUP BY order_month
"""
_BLOCKS["ceo_monthly"] = f"""
SELECT order_month, total_orders, CAST(revenue_c AS DOUBLE) / 100 AS total_revenue,
       {two_places("revenue_c", "total_orders", 1)} AS avg_order_value,
       {pct("revenue_c - lag(revenue_c) OVER w", "lag(revenue_c) OVER w")}
         AS mom_revenue_growth_pct,
       {pct("total_orders - lag(total_orders) OVER w", "lag(total_orders) OVER w")}
         AS mom_orders_growth_pct,
       revenue_c, {hundredths("revenue_c", "total_orders", 1)} AS aov_h
FROM ceo_base WINDOW w AS (ORDER BY order_month)
"""
# A late parcel has arrived, so the other arrivals were on time.
_ON_TIME = "count(delivered_customer_timestamp) - sum(is_late)"
_BLOCKS["ops_base"] = f"""
SELECT {month("purchase_timestamp")} AS order_month, count(*) AS total_shipments,
       count(delivered_customer_timestamp) AS total_delivered,
       {hundredths("sum(actual_h)", "count(actual_h)", 1)} AS days_h,
       {hundredths(_ON_TIME, "count(delivered_customer_timestamp)", 10_000)} AS otd_h,
       {hundredths("sum(is_late)", "count(delivered_customer_timestamp)", 10_000)} AS late_h
FROM fact_deliveries GROUP BY 1
"""
_BLOCKS["ops_monthly"] = """
SELECT order_month, total_shipments, total_delivered,
       CAST(days_h AS DOUBLE) / 100 AS avg_delivery_days,
       CAST(otd_h AS DOUBLE) / 100 AS otd_pct,
       CAST(late_h AS DOUBLE) / 100 AS late_delivery_rate_pct, days_h, otd_h, late_h
FROM ops_base
"""
_BLOCKS["marketing_base"] = f"""
SELECT order_month, count(*) FILTER (is_first) AS new_customers, count(is_first) AS total_orders,
       {hundredths("count(*) FILTER (NOT is_first)", "count(is_first)", 10_000)} AS repeat_h,
       ifnull({hundredths("sum(score_sum)", "sum(score_n)", 100)}, 0) AS score_h
FROM (
  SELECT {month("f.purchase_timestamp")} AS order_month, v.rank = 1 AS is_first,
         score_sum, score_n
  FROM fact_orders f
  LEFT JOIN (SELECT order_id, row_number() OVER (PARTITION BY customer_unique_id
                                                 ORDER BY purchase_timestamp) AS rank
             FROM valid_orders) v USING (order_id)
  LEFT JOIN (SELECT order_id, sum(review_score) AS score_sum, count(review_score) AS score_n
             FROM raw_reviews GROUP BY ALL) USING (order_id))
GROUP BY order_month
"""
_BLOCKS["marketing_monthly"] = """
SELECT order_month, new_customers AS new_customers_acquired, total_orders,
       CAST(repeat_h AS DOUBLE) / 100 AS repeat_order_share_pct,
       CAST(score_h AS DOUBLE) / 100 AS avg_review_score, repeat_h, score_h
FROM marketing_base
"""
_BLOCKS["rfm_raw"] = """
SELECT customer_unique_id,
       min(datesub('day', purchase_timestamp, (SELECT max(purchase_timestamp) FROM fact_orders))
          )::INTEGER AS raw_recency_days,
       count(*) AS raw_frequency, sum(total_payment) AS raw_monetary
FROM valid_orders GROUP BY customer_unique_id
"""
# The score of a purchase count; any greater count scores 4.
_BLOCKS["frequency_scores"] = "SELECT * FROM (VALUES (1, 1), (2, 3)) AS t(raw_frequency, f_score)"
_BLOCKS["rfm_scores"] = """
SELECT rfm_raw.*, ntile(4) OVER (ORDER BY raw_recency_days DESC, customer_unique_id) AS r_score,
       coalesce(frequency_scores.f_score, 4) AS f_score,
       ntile(4) OVER (ORDER BY raw_monetary, customer_unique_id) AS m_score
FROM rfm_raw LEFT JOIN frequency_scores USING (raw_frequency)
"""
# The segments in the order in which they are tried, with the scores
# that each admits.
_BLOCKS["segment_rules"] = """
SELECT * FROM (VALUES
  (1, 'Champions',             4, 4, 3, 4, 3, 4),
  (2, 'Loyal',                 3, 4, 3, 4, 1, 4),
  (3, 'New / Recent',          3, 4, 1, 1, 1, 4),
  (4, 'At Risk / Can''t Lose', 1, 2, 3, 4, 1, 4),
  (5, 'Lost',                  1, 1, 1, 1, 1, 1),
  (6, 'About to Sleep / Cold', 1, 4, 1, 4, 1, 4)
) AS t(tried, rfm_segment, r_from, r_to, f_from, f_to, m_from, m_to)
"""
_BLOCKS["rfm_segments"] = """
SELECT s.*, (SELECT arg_min(rfm_segment, tried) FROM segment_rules
             WHERE s.r_score BETWEEN r_from AND r_to AND s.f_score BETWEEN f_from AND f_to
               AND s.m_score BETWEEN m_from AND m_to) AS rfm_segment
FROM rfm_scores s
"""
_BLOCKS["cohorts"] = f"""
SELECT cohort_month, first_value(n) OVER w AS cohort_size, cohort_index, n AS active_customers,
       {pct("n", "first_value(n) OVER w")} AS retention_pct
FROM (
  SELECT cohort_month, datediff('month', cohort_month, order_month)::INTEGER AS cohort_index,
         count(DISTINCT customer_unique_id) AS n
  FROM (SELECT customer_unique_id, order_month,
               min(order_month) OVER (PARTITION BY customer_unique_id) AS cohort_month
        FROM valid_orders)
  GROUP BY ALL)
WINDOW w AS (PARTITION BY cohort_month ORDER BY cohort_index)
"""
_BLOCKS["root_cause"] = f"""
SELECT seller_state, customer_state, n AS total_deliveries, late AS total_late_deliveries,
       {pct("late", "n")} AS late_delivery_rate_pct,
       {pct("seller_late", "late")} AS seller_fault_share_pct,
       {pct("carrier_late", "late")} AS carrier_fault_share_pct
FROM (
  SELECT s.state AS seller_state, c.state AS customer_state, count(*) AS n,
         sum(is_late)::BIGINT AS late, sum(is_seller_late) AS seller_late,
         sum(is_carrier_late) AS carrier_late
  FROM milestones JOIN dim_sellers s USING (seller_id)
  JOIN dim_customers c USING (customer_unique_id)
  GROUP BY ALL)
"""
_BLOCKS["worst"] = "SELECT * FROM root_cause WHERE total_deliveries >= 50"
_BLOCKS["patterns"] = """
SELECT dayofweek(ts)::INTEGER AS day_of_week, dayname(ts) AS day_name,
       hour(ts)::INTEGER AS hour_of_day,
       count(*) AS order_count, sum(CAST(value AS DECIMAL(12,2))) AS revenue
FROM events WHERE event_type = 'purchase' GROUP BY ALL
"""
_BLOCKS["trends"] = f"""
SELECT order_month, payment_type, count(*) AS transaction_count,
       {dbl("sum(payment_value)")} AS payment_value
FROM raw_payments JOIN valid_orders USING (order_id) GROUP BY ALL
"""


def _expand(select: str) -> str:
    """Prepend every building block the statement needs, in order."""
    needed: set[str] = set()
    pending = [select]
    while pending:
        text = pending.pop()
        for name, body in _BLOCKS.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                pending.append(body)
    if not needed:
        return select.strip()
    blocks = ",\n".join(f"{n} AS ({_BLOCKS[n].strip()})" for n in _BLOCKS if n in needed)
    return f"WITH {blocks}\n{select.strip()}"


_CEO_COLUMNS = """order_month_text AS order_month, total_orders, total_revenue, avg_order_value,
       mom_revenue_growth_pct, mom_orders_growth_pct"""


def _ceo(where: str = "", tail: str = "") -> str:
    return f"""
SELECT {_CEO_COLUMNS}
FROM (SELECT *, CAST(order_month AS VARCHAR) AS order_month_text FROM ceo_monthly {where} {tail})
"""


_OPS = f"""
SELECT {iso("order_month")} AS order_month, total_shipments, total_delivered,
       avg_delivery_days, otd_pct, late_delivery_rate_pct
FROM ops_monthly
"""
_ROUTE = """seller_state, customer_state, total_deliveries, total_late_deliveries,
       late_delivery_rate_pct, seller_fault_share_pct, carrier_fault_share_pct"""
_WORST_ORDER = "late_delivery_rate_pct DESC, seller_state, customer_state"


def _change(col: str) -> str:
    return f"CAST({col} - lag({col}) OVER w AS DOUBLE) / 100"


_STATEMENTS: dict[str, str] = {}

# --- Sources and sinks
_STATEMENTS["S1_read_raw_csv"] = """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, '') AS text, lang, source,
       CAST(n_chars AS VARCHAR) AS n_chars FROM documents
"""
_STATEMENTS["S2_normalize_columns"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status FROM orders
"""
_STATEMENTS["S1_read_two_files"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders
"""
_STATEMENTS["S3_load_all"] = """
SELECT table_name, CAST(sum(n) AS BIGINT) AS row_count FROM (
  SELECT unnest([name, 'TOTAL']) AS table_name, n FROM (
    SELECT 'raw_orders' AS name, count(*) AS n FROM raw_orders
    UNION ALL SELECT 'raw_order_items', count(*) FROM raw_items
    UNION ALL SELECT 'raw_customers', count(*) FROM raw_customers
    UNION ALL SELECT 'raw_sellers', count(*) FROM raw_sellers
    UNION ALL SELECT 'raw_products', count(*) FROM raw_products
    UNION ALL SELECT 'raw_order_payments', count(*) FROM raw_payments
    UNION ALL SELECT 'raw_order_reviews', count(*) FROM raw_reviews
    UNION ALL SELECT 'raw_geolocation', count(*) FROM nation
    UNION ALL SELECT 'raw_category_translation', count(*) FROM raw_translation
  )
) GROUP BY table_name
"""
_STATEMENTS["S4_replace_table"] = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       {iso(month("o_orderdate"))} AS order_month FROM orders
"""
_STATEMENTS["S5_register_views"] = f"""
SELECT {iso("c.order_month")} AS order_month, c.total_orders, o.total_shipments
FROM ceo_monthly c JOIN ops_monthly o ON c.order_month = o.order_month
"""
_STATEMENTS["S6_export_json"] = _ceo()

# --- Profiling and data quality
_DUPLICATES = """SELECT l_orderkey, l_linenumber, count(*) AS n_rows
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""
_STATEMENTS["Q1_row_count_metric"] = f"""
SELECT 'total_rows' AS metric, count(*) AS val FROM lineitem
UNION ALL SELECT 'duplicate_line_keys', count(*) FROM ({_DUPLICATES})
"""
_STATEMENTS["Q2_duplicate_keys"] = f"SELECT count(*) AS duplicate_keys FROM ({_DUPLICATES})"
_STATEMENTS["Q3_missing_profile"] = """
SELECT count(*) AS total_records,
       count(*) FILTER (WHERE order_id IS NULL) AS missing_order_id,
       count(*) FILTER (WHERE customer_id IS NULL) AS missing_customer_id,
       count(*) FILTER (WHERE order_status IS NULL OR order_status = '') AS missing_order_status,
       count(*) FILTER (WHERE order_purchase_timestamp IS NULL) AS missing_purchase_timestamp,
       count(*) FILTER (WHERE order_delivered_customer_date IS NULL) AS missing_delivered_date
FROM raw_orders
"""
_STATEMENTS["Q4_category_distribution"] = f"""
SELECT payment_type, count(*) AS transaction_count,
       {dbl("sum(payment_value)")} AS total_payment_value
FROM raw_payments GROUP BY payment_type
"""
_STATEMENTS["Q5_value_anomalies"] = f"""
SELECT {dbl("min(v)")} AS min_payment, {dbl("max(v)")} AS max_payment,
       {two_places("sum(v) * 100", "count(v)", 1)} AS avg_payment,
       count(*) FILTER (WHERE v <= 0) AS zero_or_negative_count
FROM (SELECT CAST(c_acctbal AS DECIMAL(12,2)) AS v FROM customer)
"""
_STATEMENTS["Q6_missing_category_profile"] = """
SELECT count(*) AS total_products,
       count(*) FILTER (WHERE product_category_name IS NULL OR product_category_name = '')
         AS missing_category_name
FROM raw_products
"""
_STATEMENTS["Q7_unmatched_values"] = """
SELECT product_category_name AS untranslated_category FROM raw_products
WHERE product_category_name <> ''
EXCEPT SELECT product_category_name FROM raw_translation
"""
_STATEMENTS["Q8_check_unique"] = _DUPLICATES
_STATEMENTS["Q9_check_not_null"] = """
SELECT column_name, violations FROM (
  SELECT 'order_id' AS column_name, count(*) - count(order_id) AS violations FROM fact_orders
  UNION ALL SELECT 'purchase_timestamp', count(*) - count(purchase_timestamp) FROM fact_orders
  UNION ALL SELECT 'approved_timestamp', count(*) - count(approved_timestamp) FROM fact_orders
  UNION ALL SELECT 'delivered_carrier_timestamp', count(*) - count(delivered_carrier_timestamp)
    FROM fact_orders
  UNION ALL SELECT 'delivered_customer_timestamp', count(*) - count(delivered_customer_timestamp)
    FROM fact_orders
) WHERE violations > 0
"""
_STATEMENTS["Q10_check_foreign_key"] = """
SELECT doc_id, count(*) AS n_rows FROM documents d
WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
GROUP BY doc_id
"""
_STATEMENTS["Q11_check_domain"] = """
SELECT rule, violations FROM (
  SELECT 'length(state) <= 2' AS rule, count(*) FILTER (WHERE length(state) > 2) AS violations
    FROM dim_customers
  UNION ALL SELECT 'length(city) <= 100', count(*) FILTER (WHERE length(city) > 100)
    FROM dim_customers
  UNION ALL SELECT 'length(zip_code_prefix) <= 10',
    count(*) FILTER (WHERE length(zip_code_prefix) > 10) FROM dim_customers
  UNION ALL SELECT 'abs(customer_unique_id) <= 100',
    count(*) FILTER (WHERE abs(customer_unique_id) > 100) FROM dim_customers
) WHERE violations > 0
"""
_STATEMENTS["Q12_validate_row_counts"] = """
SELECT 'dim_customers' AS table_name, count(*) AS row_count FROM dim_customers
UNION ALL SELECT 'dim_products', count(*) FROM dim_products
UNION ALL SELECT 'dim_sellers', count(*) FROM dim_sellers
UNION ALL SELECT 'fact_orders', count(*) FROM fact_orders
UNION ALL SELECT 'fact_deliveries', count(*) FROM fact_deliveries
"""

# --- Cleaning and scalar functions
_STATEMENTS["C1_insert_if_absent"] = """
SELECT product_category_name, product_category_name_english FROM raw_translation
UNION ALL
SELECT a, b FROM (VALUES
  ('portateis_cozinha_e_preparadores_de_alimentos', 'portable_kitchen_and_food_processors'),
  ('pc_gamer', 'pc_gamer'), ('PROMO', 'replaced')) n(a, b)
WHERE NOT EXISTS (SELECT 1 FROM raw_translation WHERE product_category_name = a)
"""
_STATEMENTS["C2_blank_to_null"] = """
SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority
FROM orders
"""
_STATEMENTS["C3_safe_cast"] = """
SELECT product_id, CAST(nullif(product_length_cm, '') AS DOUBLE) AS length_cm,
       CAST(product_width_cm || '.255' AS DOUBLE) AS price,
       CASE WHEN product_length_cm <> '' THEN '2017-10-02T10:56:33' END AS ts,
       true AS not_an_integer
FROM raw_products
"""
_STATEMENTS["C4_default_value"] = """
SELECT product_id, coalesce(product_height_cm, 'unknown') AS height,
       coalesce(product_category_name, 'unknown') AS category
FROM raw_products
"""
_STATEMENTS["C5_title_case"] = f"SELECT doc_id, {title('text')} AS titled FROM documents"
_STATEMENTS["C6_upper_code"] = (
    "SELECT customer_id, upper(customer_state) AS state FROM raw_customers"
)
_STATEMENTS["C7_month_bucket"] = f"SELECT event_id, {iso(month('ts'))} AS event_month FROM events"
_STATEMENTS["C8_days_between"] = f"""
SELECT event_id, CAST({_days("TIMESTAMP '2024-01-15 12:34:56'", "ts")} AS DOUBLE) / 100 AS days
FROM events
"""
_STATEMENTS["C9_whole_days"] = f"""
SELECT event_id, {int4("datesub('day', ts, (SELECT max(ts) FROM events))")} AS days FROM events
"""
_STATEMENTS["C10_months_elapsed"] = f"""
SELECT o_orderkey, {int4("datediff('month', (SELECT min(o_orderdate) FROM orders), o_orderdate)")}
  AS months FROM orders
"""
_STATEMENTS["C11_dow_hour"] = f"""
SELECT event_id, {int4("dayofweek(ts)")} AS day_of_week, {int4("hour(ts)")} AS hour_of_day
FROM events
"""
_STATEMENTS["C12_day_name"] = "SELECT o_orderkey, dayname(o_orderdate) AS day_name FROM orders"
_STATEMENTS["C13_safe_ratio_pct"] = f"""
SELECT l_orderkey, {pct("a", "b")} AS pct FROM (
  SELECT l_orderkey, coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'R'), 0) AS a,
         coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 0) AS b
  FROM lineitem GROUP BY l_orderkey)
"""
# Both operands in units of 1/10,000: price / 1000 with four decimals, tax / 10.
_STATEMENTS["C13_ratio_of_long_decimals"] = f"""
SELECT l_orderkey, l_linenumber, {pct("tax", "fine")} AS pct, {two_places("fine", "tax", 100)} AS quotient
FROM (SELECT l_orderkey, l_linenumber,
             CAST(round(CAST(l_extendedprice AS DECIMAL(18,4)) * 10) AS BIGINT) AS fine,
             CAST(round(CAST(l_tax AS DECIMAL(18,3)) * 1000) AS BIGINT) AS tax FROM lineitem)
"""
_STATEMENTS["C13_ratio_of_doubles"] = """
SELECT l_orderkey, l_linenumber, round(round(l_tax / nullif(l_discount, 0), 9), 2) AS quotient FROM lineitem
"""
_NEAR_A_TIE = "n * CAST(100000000000 AS HUGEINT) + 499999996"
_LARGE = hundredths("n + CAST(90071992547409931 AS HUGEINT)", "100", 100)
_STATEMENTS["C13_ratio_near_ties"] = f"""
SELECT l_orderkey, l_linenumber,
       {two_places(_NEAR_A_TIE, "CAST(100000000000 AS HUGEINT)", 100)} AS below,
       {two_places("-(n * 1000 + 5)", "1000", 100)} AS tie,
       {two_places(_NEAR_A_TIE, "CAST(100000000000 AS HUGEINT)", 100)} AS below_as_double,
       CAST({_LARGE} // 100 AS VARCHAR) || '.' || lpad(CAST({_LARGE} % 100 AS VARCHAR), 2, '0') AS large,
       {pct("n", "CAST(90071992547409931 AS HUGEINT)")} AS small_pct
FROM (SELECT l_orderkey, l_linenumber, l_orderkey * 10 + l_linenumber AS n FROM lineitem)
"""
_STATEMENTS["C14_late_flag"] = f"""
SELECT order_id, CAST(coalesce(order_delivered_customer_date > order_estimated_delivery_date,
                               false) AS INTEGER) AS is_late
FROM raw_orders
"""
_STATEMENTS["C15_fault_flags"] = """
SELECT order_id, seller_id, is_late, is_seller_late, is_carrier_late FROM milestones
"""
_STATEMENTS["C16_display_label"] = """
SELECT product_id, replace(category_english, '_', ' ') AS label FROM dim_products
"""
_STATEMENTS["C17_route_label"] = (
    "SELECT seller_id, state || ' ➔ ' || city AS route FROM dim_sellers"
)

# --- Joins
_STATEMENTS["J1_inner_join"] = """
SELECT o.order_id, o.customer_id, o.order_status, c.customer_unique_id
FROM raw_orders o JOIN raw_customers c ON o.customer_id = c.customer_id
"""
_STATEMENTS["J1_inner_join_salted"] = f"""
SELECT seller_state, count(*) AS n_lines, {big("sum(l_orderkey)")} AS order_sum
FROM lineitem JOIN raw_sellers ON seller_id = l_suppkey GROUP BY seller_state
"""
_STATEMENTS["J2_composite_join"] = f"""
SELECT d.order_id, d.seller_id, d.is_late, {iso_ts("i.shipping_limit")} AS shipping_limit
FROM fact_deliveries d JOIN (
  SELECT order_id, seller_id, max(shipping_limit_date) AS shipping_limit
  FROM raw_items GROUP BY 1, 2
) i ON d.order_id = i.order_id AND d.seller_id = i.seller_id
"""
_STATEMENTS["J3_join_aggregated"] = f"""
SELECT o.order_id, o.order_status, {dbl("coalesce(i.p, 0)")} AS total_price,
       coalesce(i.n, 0) AS n_items
FROM raw_orders o LEFT JOIN (
  SELECT order_id, sum(price) AS p, count(*) AS n FROM raw_items GROUP BY 1
) i ON o.order_id = i.order_id
"""
_STATEMENTS["J4_spine_join"] = f"""
SELECT {iso(month("purchase_timestamp"))} AS order_month,
       count(*) FILTER (WHERE order_status = 'delivered') AS delivered_orders,
       count(*) FILTER (WHERE order_status = 'shipped') AS shipped_orders,
       count(*) FILTER (WHERE order_status = 'canceled') AS canceled_orders
FROM fact_orders GROUP BY 1
"""
_STATEMENTS["J5_lookup_with_default"] = """
SELECT p.product_category_name, p.product_id,
       coalesce(t.product_category_name_english, 'unknown') AS product_category_name_english
FROM raw_products p LEFT JOIN raw_translation t
  ON p.product_category_name = t.product_category_name
"""
_STATEMENTS["J6_left_anti"] = """
SELECT o.order_id, o.customer_id FROM raw_orders o
LEFT JOIN (SELECT DISTINCT order_id FROM raw_items) i ON o.order_id = i.order_id
WHERE i.order_id IS NULL
"""
_STATEMENTS["J7_not_exists"] = """
SELECT c.customer_id, c.customer_state FROM raw_customers c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.customer_id AND o.o_orderstatus = 'P')
"""
_STATEMENTS["J8_star_join"] = f"""
SELECT m.order_id, m.seller_id, s.state AS seller_state, c.state AS customer_state,
       {iso_ts("m.carrier_handover_timestamp")} AS carrier_handover_timestamp,
       {iso_ts("m.shipping_limit_timestamp")} AS shipping_limit_timestamp,
       m.is_seller_late, m.is_carrier_late
FROM milestones m
JOIN dim_sellers s ON m.seller_id = s.seller_id
JOIN dim_customers c ON m.customer_unique_id = c.customer_unique_id
"""
_STATEMENTS["J9_scalar_subquery"] = f"""
SELECT order_id,
       CAST(datesub('day', purchase_timestamp,
            (SELECT max(purchase_timestamp) FROM fact_orders)) AS INTEGER) AS age_days,
       {pct("total_payment * 100000", "(SELECT sum(total_payment) * 100 FROM fact_orders)")}
         AS share_per_mille_pct
FROM fact_orders
"""

# --- Aggregation, distinct and windows
_STATEMENTS["A1_hash_aggregate"] = f"""
SELECT l_returnflag, l_linestatus, count(*) AS n_lines,
       {dbl("sum(CAST(l_extendedprice AS DECIMAL(12,2)))")} AS sum_price,
       {two_places("sum(l_quantity)", "count(l_quantity)", 100)} AS avg_quantity,
       {iso_ts("min(l_shipdate)")} AS first_ship, {iso_ts("max(l_shipdate)")} AS last_ship
FROM lineitem GROUP BY 1, 2
"""
_STATEMENTS["A2_filtered_aggregate"] = f"""
SELECT {iso(month("o_orderdate"))} AS month, count(*) AS n_orders,
       count(*) FILTER (WHERE o_orderstatus = 'F') AS n_delivered,
       count(*) FILTER (WHERE o_totalprice > 250000) AS n_large
FROM orders GROUP BY 1
"""
_STATEMENTS["A3_count_distinct"] = """
SELECT o_orderpriority, count(DISTINCT o_custkey) AS n_customers FROM orders GROUP BY 1
"""
_STATEMENTS["A4_count_non_null"] = """
SELECT order_status, count(order_delivered_carrier_date) AS handed_over,
       count(order_delivered_customer_date) AS delivered
FROM raw_orders GROUP BY 1
"""
_STATEMENTS["A5_having"] = """
SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1 HAVING count(*) > 12
"""
_STATEMENTS["A6_select_distinct"] = f"""
SELECT DISTINCT customer_unique_id, {iso(month("purchase_timestamp"))} AS order_month
FROM fact_orders
"""
_STATEMENTS["A7_keep_latest"] = f"""
SELECT o_custkey, {iso_ts("o_orderdate")} AS o_orderdate, o_orderkey, o_orderstatus
FROM (SELECT *, row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1
"""
_STATEMENTS["A8_keep_any"] = f"""
SELECT l_orderkey, l_suppkey, {iso_ts("l_shipdate")} AS l_shipdate, l_returnflag
FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_suppkey ORDER BY l_shipdate, l_returnflag) AS rn FROM lineitem)
WHERE rn = 1
"""
_STATEMENTS["A9_group_by_ordinal"] = f"""
SELECT {iso(month("o_orderdate"))} AS order_month, o_orderstatus, count(*) AS n_orders
FROM orders GROUP BY 1, 2
"""
_STATEMENTS["A10_nested_average"] = f"""
SELECT l_returnflag, {two_places("sum(mean_t)", "count(*) * 10000000000", 1)}
  AS avg_of_order_averages
FROM (
  SELECT l_returnflag, l_orderkey,
         {hundredths("sum(l_quantity)", "count(l_quantity)", 1_000_000_000_000)} AS mean_t
  FROM lineitem GROUP BY 1, 2)
GROUP BY 1
"""
_STATEMENTS["W1_lag"] = f"""
SELECT {iso("month")} AS month, n_orders,
       {dbl("lag(n_orders) OVER (ORDER BY month)")} AS previous_orders
FROM (SELECT {month("o_orderdate")} AS month, count(*) AS n_orders FROM orders GROUP BY 1)
"""
_STATEMENTS["W2_row_number"] = f"""
SELECT o_custkey, o_orderkey, {iso_ts("o_orderdate")} AS o_orderdate,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS order_num
FROM orders
"""
_STATEMENTS["W2_row_number_hot_keys"] = f"""
SELECT seller_id, order_id, {iso_ts("purchase_timestamp")} AS purchase_timestamp,
       row_number() OVER (PARTITION BY seller_id ORDER BY purchase_timestamp, order_id)
         AS delivery_num
FROM fact_deliveries
"""
_STATEMENTS["W3_ntile"] = f"""
SELECT o_orderkey, o_totalprice,
       {int4("ntile(4) OVER (ORDER BY o_totalprice, o_orderkey)")} AS tile_asc,
       {int4("ntile(7) OVER (ORDER BY o_totalprice DESC, o_orderkey)")} AS tile_desc
FROM orders
"""
_STATEMENTS["W4_share_of_total"] = f"""
SELECT order_status, n_orders, {dbl("revenue")} AS revenue,
       {pct("n_orders", "sum(n_orders) OVER ()")} AS order_share_pct,
       {pct("revenue * 100", "sum(revenue) OVER () * 100")} AS revenue_share_pct
FROM (SELECT order_status, count(*) AS n_orders, sum(total_payment) AS revenue
      FROM fact_orders GROUP BY 1)
"""
_ROLLING = """
  SELECT order_month, revenue_c, total_orders,
         sum(revenue_c) OVER last_12 AS lr, sum(total_orders) OVER last_12 AS lo,
         sum(revenue_c) OVER before_12 AS pr, sum(total_orders) OVER before_12 AS po
  FROM ceo_base
  WINDOW last_12 AS (ORDER BY order_month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW),
         before_12 AS (ORDER BY order_month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)"""
_STATEMENTS["W5_rolling_sums"] = f"""
SELECT {iso("order_month")} AS order_month, {dbl("revenue_c")} / 100 AS total_revenue, total_orders,
       {dbl("lr")} / 100 AS ltm_total_revenue, {big("lo")} AS ltm_total_orders,
       {dbl("pr")} / 100 AS prior_ltm_total_revenue, {dbl("po")} AS prior_ltm_total_orders
FROM ({_ROLLING})
"""

# --- Sort, limit, set operations
_STATEMENTS["O1_order_by"] = f"""
SELECT o_orderkey, o_orderstatus, {iso_ts("o_orderdate")} AS o_orderdate
FROM orders ORDER BY o_orderstatus, orders.o_orderdate DESC, o_orderkey
"""
_STATEMENTS["O1_places_in_order"] = f"""
SELECT o_orderkey, o_orderstatus, {iso_ts("o_orderdate")} AS o_orderdate,
       row_number() OVER (ORDER BY o_orderstatus NULLS LAST, orders.o_orderdate DESC NULLS FIRST, o_orderkey) AS place
FROM orders
"""
_STATEMENTS["O2_top_k"] = """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15
"""
_STATEMENTS["O3_latest_rows"] = _ceo(tail="ORDER BY order_month DESC LIMIT 10")
_STATEMENTS["U1_union_all"] = f"""
SELECT order_id, {iso_ts("purchase_timestamp")} AS ts, 'placed' AS event FROM fact_orders
UNION ALL
SELECT order_id, {iso_ts("delivered_customer_timestamp")}, 'arrived' FROM fact_orders
WHERE delivered_customer_timestamp IS NOT NULL
"""

# --- Star schema and analytic plans
_STATEMENTS["P1_dim_customers"] = "SELECT * FROM dim_customers"
_STATEMENTS["P2_dim_products"] = f"""
SELECT product_id, category_english, {dbl("weight_g")} AS weight_g,
       {dbl("length_cm")} AS length_cm, {dbl("height_cm")} AS height_cm,
       {dbl("width_cm")} AS width_cm
FROM dim_products
"""
_STATEMENTS["P3_dim_sellers"] = "SELECT * FROM dim_sellers"
_STATEMENTS["P4_fact_orders"] = f"""
SELECT order_id, customer_unique_id, order_status,
       {iso_ts("purchase_timestamp")} AS purchase_timestamp,
       {iso_ts("approved_timestamp")} AS approved_timestamp,
       {iso_ts("delivered_carrier_timestamp")} AS delivered_carrier_timestamp,
       {iso_ts("delivered_customer_timestamp")} AS delivered_customer_timestamp,
       {iso_ts("estimated_delivery_timestamp")} AS estimated_delivery_timestamp,
       {dbl("total_price")} AS total_price, {dbl("total_freight")} AS total_freight,
       {dbl("total_payment")} AS total_payment
FROM fact_orders
"""
_STATEMENTS["P5_fact_deliveries"] = f"""
SELECT order_id, seller_id, customer_unique_id,
       {iso_ts("purchase_timestamp")} AS purchase_timestamp,
       {iso_ts("delivered_customer_timestamp")} AS delivered_customer_timestamp,
       {iso_ts("estimated_delivery_timestamp")} AS estimated_delivery_timestamp,
       {dbl("actual_h")} / 100 AS actual_delivery_days,
       {dbl("estimated_h")} / 100 AS estimated_delivery_days,
       {dbl("difference_h")} / 100 AS days_difference, is_late
FROM fact_deliveries
"""
_STATEMENTS["P6_ceo_monthly"] = _ceo()
_STATEMENTS["P7_ops_monthly"] = _OPS
_STATEMENTS["P8_marketing_monthly"] = f"""
SELECT {iso("order_month")} AS order_month, new_customers_acquired, total_orders,
       repeat_order_share_pct, avg_review_score FROM marketing_monthly
"""
_STATEMENTS["P9_rfm_segmentation"] = f"""
SELECT customer_unique_id, raw_recency_days, raw_frequency, {dbl("raw_monetary")} AS raw_monetary,
       {int4("r_score")} AS r_score, {int4("f_score")} AS f_score, {int4("m_score")} AS m_score,
       rfm_segment
FROM rfm_segments
"""
_STATEMENTS["P10_rfm_summary"] = f"""
SELECT rfm_segment, n AS customer_count, {pct("n", "sum(n) OVER ()")} AS customer_share_pct,
       {dbl("revenue")} AS total_revenue,
       {pct("revenue * 100", "sum(revenue) OVER () * 100")} AS revenue_share_pct,
       {two_places("revenue * 100", "n", 1)} AS aov
FROM (SELECT rfm_segment, count(*) AS n, sum(raw_monetary) AS revenue
      FROM rfm_segments GROUP BY 1)
"""
_STATEMENTS["P11_cohort_retention"] = f"""
SELECT {iso("cohort_month")} AS cohort_month, cohort_size, cohort_index, active_customers,
       retention_pct FROM cohorts
"""
_STATEMENTS["P12_delivery_root_cause"] = f"SELECT {_ROUTE} FROM root_cause"
_STATEMENTS["P13_worst_routes"] = f"SELECT {_ROUTE} FROM worst ORDER BY {_WORST_ORDER}"
_STATEMENTS["P13_worst_routes_top10"] = f"""
SELECT {_ROUTE} FROM worst ORDER BY {_WORST_ORDER} LIMIT 10
"""
_STATEMENTS["P14_time_patterns"] = f"""
SELECT day_of_week, day_name, hour_of_day, order_count, {dbl("revenue")} AS total_revenue,
       {pct("order_count", "sum(order_count) OVER ()")} AS order_share_pct
FROM patterns
"""
_STATEMENTS["P15_peak_hours"] = f"""
SELECT hour_of_day, {big("n")} AS total_orders, {pct("n", "sum(n) OVER ()")} AS share_pct
FROM (SELECT hour_of_day, sum(order_count) AS n FROM patterns GROUP BY 1)
ORDER BY n DESC, hour_of_day LIMIT 5
"""
_STATEMENTS["P16_weekday_distribution"] = f"""
SELECT day_name, {big("n")} AS total_orders, {pct("n", "sum(n) OVER ()")} AS share_pct
FROM (SELECT day_of_week, day_name, sum(order_count) AS n FROM patterns GROUP BY 1, 2)
"""
_STATEMENTS["P17_geo_revenue"] = f"""
SELECT state, {dbl("r")} AS revenue,
       {pct("r * 100", "(SELECT sum(total_payment) * 100 FROM valid_orders)")} AS revenue_share_pct
FROM (SELECT state, sum(total_payment) AS r
      FROM valid_orders JOIN dim_customers USING (customer_unique_id) GROUP BY ALL)
ORDER BY r DESC, state LIMIT 10
"""
_STATEMENTS["P18_category_performance"] = f"""
SELECT category_english, {dbl("sum(price)")} AS revenue,
       {two_places("sum(review_score)", "count(review_score)", 100)} AS avg_review_score,
       count(DISTINCT order_id) AS total_orders
FROM raw_items JOIN dim_products USING (product_id) SEMI JOIN valid_orders USING (order_id)
LEFT JOIN raw_reviews USING (order_id)
GROUP BY category_english ORDER BY sum(price) DESC, category_english LIMIT 15
"""
_STATEMENTS["P19_payment_trends"] = f"""
SELECT {iso("order_month")} AS order_month, payment_type, transaction_count, payment_value
FROM trends
"""

# --- Dashboard figures
_STATEMENTS["D1_ltm_growth"] = f"""
SELECT {iso("order_month")} AS order_month, {dbl("lr")} / 100 AS ltm_revenue,
       {big("lo")} AS ltm_orders, {dbl("pr")} / 100 AS prior_ltm_revenue,
       {dbl("po")} AS prior_ltm_orders,
       {pct("lr - pr", "pr")} AS ltm_revenue_growth_pct,
       {pct("lo - po", "po")} AS ltm_orders_growth_pct
FROM ({_ROLLING})
"""
_STATEMENTS["D2_aov_growth"] = f"""
SELECT {iso("order_month")} AS order_month, avg_order_value AS aov,
       {pct("aov_h - lag(aov_h) OVER w", "lag(aov_h) OVER w")} AS aov_growth_pct
FROM ceo_monthly WINDOW w AS (ORDER BY ceo_monthly.order_month)
"""
_STATEMENTS["D2_aov_growth_exact"] = f"""
SELECT {iso("month")} AS order_month, round(aov, 2) AS aov,
       CASE WHEN before > 0 THEN round((aov - before) / before * 100, 2)
            WHEN before IS NOT NULL THEN 0.0 END AS aov_growth_pct
FROM (
  SELECT order_month AS month, total_revenue / greatest(1, total_orders) AS aov,
         lag(total_revenue / greatest(1, total_orders)) OVER (ORDER BY order_month) AS before
  FROM ceo_monthly)
"""
_STATEMENTS["D3_point_change_ops"] = f"""
SELECT {iso("order_month")} AS order_month, total_shipments, total_delivered, avg_delivery_days,
       otd_pct, late_delivery_rate_pct, {_change("otd_h")} AS otd_pct_change,
       {_change("days_h")} AS avg_delivery_days_change,
       {_change("late_h")} AS late_delivery_rate_pct_change
FROM ops_monthly WINDOW w AS (ORDER BY ops_monthly.order_month)
"""
_STATEMENTS["D3_point_change_marketing"] = f"""
SELECT {iso("order_month")} AS order_month, new_customers_acquired, total_orders,
       repeat_order_share_pct, avg_review_score,
       {_change("repeat_h")} AS repeat_order_share_pct_change,
       {_change("score_h")} AS avg_review_score_change
FROM marketing_monthly WINDOW w AS (ORDER BY marketing_monthly.order_month)
"""
_NEW = "new_customers_acquired"
_STATEMENTS["D4_acquisition_growth"] = f"""
SELECT {iso("order_month")} AS order_month, {_NEW},
       {pct(f"{_NEW} - lag({_NEW}) OVER w", f"lag({_NEW}) OVER w")} AS acquisition_growth_pct
FROM marketing_monthly WINDOW w AS (ORDER BY marketing_monthly.order_month)
"""
_STATEMENTS["D4_acquisition_growth_at_least_one"] = f"""
SELECT {iso("month")} AS order_month, n AS {_NEW},
       CASE WHEN before IS NOT NULL THEN {pct("n - before", "greatest(1, before)")} END
         AS acquisition_growth_pct
FROM (SELECT order_month AS month, {_NEW} AS n, lag({_NEW}) OVER (ORDER BY order_month) AS before
      FROM marketing_monthly)
"""
_STATEMENTS["D5_active_month"] = _ceo("WHERE order_month = DATE '1998-08-01'")
_STATEMENTS["D5_active_month_fallback"] = _ceo(tail="ORDER BY order_month DESC LIMIT 1 OFFSET 1")
_STATEMENTS["D6_month_range"] = (
    _OPS + "WHERE ops_monthly.order_month BETWEEN DATE '1996-01-01' AND DATE '1998-08-01'"
)
_STATEMENTS["D7_primary_driver"] = """
SELECT seller_state, customer_state,
       CASE WHEN carrier_fault_share_pct > 60 THEN 'Carrier Delays' ELSE 'Slow Sellers' END
         AS primary_driver
FROM root_cause
"""
_STATEMENTS["D8_cohort_curve"] = f"""
SELECT {int4("i")} AS cohort_index, coalesce(retention_pct, 0.0) AS retention_pct
FROM (SELECT unnest(range(1, 1 + greatest(12, (
        SELECT max(cohort_index) FROM cohorts WHERE cohort_month = DATE '1995-01-01')))) AS i)
LEFT JOIN (SELECT cohort_index, retention_pct FROM cohorts
           WHERE cohort_month = DATE '1995-01-01') ON cohort_index = i
"""
_STATEMENTS["D9_payment_pivot"] = f"""
SELECT {iso("order_month")} AS order_month,
       coalesce(sum(payment_value) FILTER (WHERE payment_type = 'A'), 0.0) AS "A",
       coalesce(sum(payment_value) FILTER (WHERE payment_type = 'N'), 0.0) AS "N",
       coalesce(sum(payment_value) FILTER (WHERE payment_type = 'R'), 0.0) AS "R"
FROM trends
WHERE trends.order_month BETWEEN DATE '1996-01-01' AND DATE '1998-08-01' GROUP BY trends.order_month
"""
_STATEMENTS["D10_sla_trend"] = f"""
SELECT {iso("order_month")} AS order_month, avg_delivery_days, CAST(1300 AS INTEGER) AS sla_days,
       avg_delivery_days > 1300 AS breached
FROM ops_monthly
WHERE ops_monthly.order_month BETWEEN DATE '1996-01-01' AND DATE '1998-08-01'
"""
_STATEMENTS["D11_top_routes"] = f"""
SELECT seller_state || ' ➔ ' || customer_state AS route, {_ROUTE},
       CASE WHEN carrier_fault_share_pct > 60 THEN 'Carrier Delays' ELSE 'Slow Sellers' END
         AS primary_driver
FROM worst ORDER BY {_WORST_ORDER} LIMIT 8
"""
_STATEMENTS["D11_top_routes_five"] = f"""
SELECT seller_state || ' ➔ ' || customer_state AS route, {_ROUTE},
       CASE WHEN carrier_fault_share_pct > 60 THEN 'Carrier Delays' ELSE 'Slow Sellers' END
         AS primary_driver
FROM worst ORDER BY {_WORST_ORDER} LIMIT 5
"""
_STATEMENTS["D12_delta_direction"] = f"""
SELECT {iso("order_month")} AS order_month,
       CASE WHEN otd_h - lag(otd_h) OVER w >= 0 THEN 'up'
            WHEN otd_h - lag(otd_h) OVER w < 0 THEN 'down' END AS otd_direction,
       CASE WHEN days_h - lag(days_h) OVER w >= 0 THEN 'down'
            WHEN days_h - lag(days_h) OVER w < 0 THEN 'up' END AS days_direction
FROM ops_monthly WINDOW w AS (ORDER BY ops_monthly.order_month)
"""

ORACLES: dict[str, str] = {name: _expand(sql) for name, sql in _STATEMENTS.items()}
