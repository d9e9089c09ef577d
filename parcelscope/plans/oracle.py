"""Independent SQL formulations of every registered query, for DuckDB.

The driver tables are registered as views (``orders``, ``lineitem``,
``customer`` ...).  ``BASE`` re-derives the canonical clean tables from them
with the same integer rules as ``sources/adapter.py`` + the cleaning step, but
written directly in SQL (no string round trip), and each query is then written
the way the dashboard states it (joins at item grain, ``count(DISTINCT ...)``,
``FILTER``), not the way the Spark plan computes it.
"""

from __future__ import annotations

# Fixed values, stated again here so that a change in the engine shows as a difference.
ON_TIME_LABEL, LATE_LABEL = "On Time", "Late"
CARRIER_BEFORE_APPROVED = "carrier_before_approved"
CUSTOMER_BEFORE_CARRIER = "customer_before_carrier"
BOTH_REASONS = "carrier_before_approved AND customer_before_carrier"
LAT_RANGE, LNG_RANGE = (-35.0, 5.0), (-75.0, -30.0)
STATUS_MAP = {"F": "delivered", "O": "shipped", "P": "canceled"}
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card"]
ORIGINS = ["organic_search", "paid_search", "social", "email", "direct_traffic"]
SEGMENTS = ["home_decor", "health_beauty", "car_accessories", "computers"]
LEAD_TYPES = ["online_medium", "online_big", "industry"]
UNTRANSLATED_BRANDS = ["Brand#3", "Brand#7"]
DAY_CASE = ("CASE WHEN dd <= 5 THEN '0-5 Days' WHEN dd <= 10 THEN '6-10 Days' WHEN dd <= 15 THEN '11-15 Days' "
            "WHEN dd <= 20 THEN '16-20 Days' WHEN dd <= 25 THEN '21-25 Days' ELSE '>25 Days' END")
WEIGHT_CASE = ("CASE WHEN p.product_weight_g < 500 THEN '< 0.5 kg' WHEN p.product_weight_g < 1000 THEN '0.5 - 1 kg' "
               "WHEN p.product_weight_g < 5000 THEN '1 - 5 kg' ELSE '> 5 kg' END")
STAGE_NAMES = ((1, "Payment Approval"), (2, "Seller Processing"), (3, "Delivery to Customer"))


def _pick(expr: str, values: list[str]) -> str:
    """``values[expr]`` for ``expr`` in 0..n-1 (the last value catches the rest)."""
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values[:-1]))
    return f"CASE {expr} {whens} ELSE '{values[-1]}' END"


def _in_box(lat: str = "geolocation_lat", lng: str = "geolocation_lng") -> str:
    return (f"coalesce({lat} BETWEEN {LAT_RANGE[0]} AND {LAT_RANGE[1]} "
            f"AND {lng} BETWEEN {LNG_RANGE[0]} AND {LNG_RANGE[1]}, false)")


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


STATUS_CASE = ("CASE o_orderstatus " + " ".join(f"WHEN '{c}' THEN '{w}'" for c, w in STATUS_MAP.items())
               + " ELSE '' END")

BASE = f"""
o_t1 AS (
  SELECT o_orderkey AS k, o_custkey AS custkey,
         {STATUS_CASE} AS status,
         o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS purchase
  FROM orders),
o_t2 AS (
  SELECT *, CASE WHEN k % 101 = 0 THEN NULL
                 ELSE purchase + to_seconds(60 * ((k * 31) % 4320)) END AS approved
  FROM o_t1),
o_t3 AS (
  SELECT *, CASE WHEN k % 97 = 0 THEN NULL
                 ELSE coalesce(approved, purchase) + to_seconds(60 * ((k * 137) % 14400 - 720)) END AS carrier
  FROM o_t2),
o_t4 AS (
  SELECT *, CASE WHEN k % 89 = 0 THEN NULL
                 ELSE coalesce(carrier, purchase) + to_seconds(60 * ((k * 53) % 36000 - 180)) END AS customer,
            CASE WHEN k % 103 = 0 THEN NULL
                 ELSE purchase + to_seconds(86400 * (12 + k % 20)) END AS estimated
  FROM o_t3),
o_all AS (
  SELECT CAST(k AS VARCHAR) AS order_id, CAST(custkey AS VARCHAR) AS customer_id, status AS order_status,
         purchase AS order_purchase_timestamp, approved AS order_approved_at,
         carrier AS order_delivered_carrier_date, customer AS order_delivered_customer_date,
         estimated AS order_estimated_delivery_date,
         coalesce(carrier < approved, false) AS cba, coalesce(customer < carrier, false) AS cbc
  FROM o_t4),
o_clean AS (SELECT * EXCLUDE (cba, cbc) FROM o_all WHERE NOT (cba OR cbc)),
o_rejected AS (
  SELECT * EXCLUDE (cba, cbc),
         CASE WHEN cba AND cbc THEN '{BOTH_REASONS}'
              WHEN cbc THEN '{CUSTOMER_BEFORE_CARRIER}'
              ELSE '{CARRIER_BEFORE_APPROVED}' END AS reject_reason
  FROM o_all WHERE cba OR cbc),
items AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
         l_shipdate AS shipping_limit_date,
         l_extendedprice AS price, CAST(l_quantity AS DOUBLE) * 0.25 AS freight_value
  FROM lineitem),
o_typed AS (SELECT * EXCLUDE (cba, cbc) FROM o_all),
pay AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, 1 AS payment_sequential,
         {_pick(f"o_orderkey % {len(PAYMENT_TYPES)}", PAYMENT_TYPES)} AS payment_type,
         CAST(CASE WHEN o_orderkey % 71 = 0 THEN 0 ELSE 1 + o_orderkey % 12 END AS INTEGER) AS payment_installments,
         CASE WHEN o_orderkey % 83 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice END AS payment_value
  FROM orders),
mql_t AS (
  SELECT 'mql_' || CAST(s_suppkey AS VARCHAR) AS mql_id,
         printf('2018-%02d-%02d', 1 + s_suppkey % 12, 1 + s_suppkey % 28) AS first_contact_date,
         'lp_' || CAST(s_suppkey % 7 AS VARCHAR) AS landing_page_id,
         CASE WHEN s_suppkey % 40 = 0 THEN ''
              ELSE {_pick(f"s_suppkey % {len(ORIGINS)}", ORIGINS)} END AS origin
  FROM supplier),
deals AS (
  SELECT 'mql_' || CAST(s_suppkey AS VARCHAR) AS mql_id, CAST(s_suppkey AS VARCHAR) AS seller_id,
         'sdr_' || CAST(s_suppkey % 4 AS VARCHAR) AS sdr_id, 'sr_' || CAST(s_suppkey % 6 AS VARCHAR) AS sr_id,
         printf('2018-%02d-%02d 00:00:00', 1 + s_suppkey % 12, 1 + s_suppkey % 28) AS won_date,
         {_pick(f"s_suppkey % {len(SEGMENTS)}", SEGMENTS)} AS business_segment,
         {_pick(f"s_suppkey % {len(LEAD_TYPES)}", LEAD_TYPES)} AS lead_type,
         CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'cat' END AS lead_behaviour_profile,
         CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'True' END AS has_company,
         CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'False' END AS has_gtin,
         CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE '5-20' END AS average_stock,
         CASE WHEN s_suppkey % 7 = 0 THEN 'manufacturer' ELSE 'reseller' END AS business_type,
         CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE CAST(s_suppkey % 200 AS DOUBLE) END
           AS declared_product_catalog_size,
         CAST((s_suppkey % 10) * 1000 AS DOUBLE) AS declared_monthly_revenue
  FROM supplier WHERE s_suppkey % 3 = 0),
cust AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
         lpad(CAST(c_custkey % 10000 AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
         'city_' || CAST(c_custkey % 3 AS VARCHAR) AS customer_city,
         coalesce(n_name, '') AS customer_state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
sell AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
         lpad(CAST(s_suppkey % 10000 AS VARCHAR), 5, '0') AS seller_zip_code_prefix,
         'city_' || CAST(s_suppkey % 3 AS VARCHAR) AS seller_city,
         coalesce(n_name, '') AS seller_state
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
prod AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
         CASE WHEN p_partkey % 61 = 0 THEN '' ELSE p_brand END AS product_category_name,
         CASE WHEN p_partkey % 61 = 0 THEN NULL ELSE CAST(length(p_name) AS INTEGER) END AS product_name_lenght,
         CASE WHEN p_partkey % 61 = 0 THEN NULL ELSE CAST(length(p_type) * 10 AS INTEGER) END
           AS product_description_lenght,
         CASE WHEN p_partkey % 61 = 0 THEN NULL ELSE CAST(1 + p_partkey % 5 AS INTEGER) END AS product_photos_qty,
         CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) * 125.0 END AS product_weight_g,
         CAST(p_size + 10 AS DOUBLE) AS product_length_cm,
         CAST(p_size % 25 AS DOUBLE) AS product_height_cm,
         CAST(5 + p_partkey % 30 AS DOUBLE) AS product_width_cm
  FROM part),
ct AS (
  SELECT DISTINCT p_brand AS product_category_name,
         replace(p_brand, 'Brand#', 'brand_') AS product_category_name_english
  FROM part WHERE p_brand NOT IN ({_quoted(UNTRANSLATED_BRANDS)})),
rev_k AS (SELECT o_orderkey AS k, o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS purchase FROM orders),
rev_1 AS (
  SELECT 'rv' || CAST(k AS VARCHAR) AS review_id, k,
         CASE WHEN k % 43 = 0 THEN NULL ELSE CAST(1 + (k * 7) % 5 AS INTEGER) END AS review_score,
         purchase + to_seconds(86400 * (10 + k % 15)) AS created
  FROM rev_k WHERE k % 11 <> 0
  UNION ALL
  SELECT 'rw' || CAST(k AS VARCHAR), k, CAST(1 + (k * 3) % 5 AS INTEGER),
         purchase + to_seconds(86400 * (20 + k % 9))
  FROM rev_k WHERE k % 37 = 0),
rev AS (
  SELECT review_id, CAST(k AS VARCHAR) AS order_id, review_score,
         CASE WHEN k % 5 = 0 THEN 'titulo' ELSE '' END AS review_comment_title,
         CASE WHEN k % 3 = 0 THEN 'comentario ' || CAST(k AS VARCHAR) ELSE '' END AS review_comment_message,
         date_trunc('day', created) AS review_creation_date,
         created + to_seconds(3600 * (k % 72)) AS review_answer_timestamp
  FROM rev_1),
geo_raw AS (
  SELECT c_custkey AS c, c_nationkey FROM customer
  UNION ALL
  SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey % 4 = 0),
geo_typed AS (
  SELECT lpad(CAST(c % 30 AS VARCHAR), 5, '0') AS geolocation_zip_code_prefix,
         CASE WHEN c % 150 = 149 THEN NULL ELSE CAST(-38 + c % 50 AS DOUBLE) END AS geolocation_lat,
         CAST(-78 + c % 75 AS DOUBLE) AS geolocation_lng,
         'city_' || CAST(c % 3 AS VARCHAR) AS geolocation_city,
         CAST(c_nationkey AS VARCHAR) AS geolocation_state
  FROM geo_raw),
geo_dedup AS (SELECT DISTINCT * FROM geo_typed),
geo_clean AS (
  SELECT * FROM geo_dedup
  WHERE {_in_box()}),
geo_rejected AS (
  SELECT * FROM geo_dedup
  WHERE NOT {_in_box()}),
dlv AS (SELECT * FROM o_clean WHERE order_status = 'delivered')
"""


def with_base(sql: str) -> str:
    return f"WITH {BASE.strip()}\n{sql.strip()}"


H = "date_diff('hour', {a}, {b})"
D = "date_diff('day', {a}, {b})"
P, A, C, CU, E = ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                  "order_delivered_customer_date", "order_estimated_delivery_date")


def h(a: str, b: str, t: str = "") -> str:
    p = f"{t}." if t else ""
    return H.format(a=p + a, b=p + b)


def d(a: str, b: str, t: str = "") -> str:
    p = f"{t}." if t else ""
    return D.format(a=p + a, b=p + b)


def rate(num: str, den: str) -> str:
    """Percentage rounded to 2 places; a zero denominator gives NULL (the engine's rule)."""
    return f"round(CAST({num} AS DOUBLE) * 100.0 / NULLIF(CAST({den} AS DOUBLE), 0), 2)"


LATE = f"{CU} > {E}"
ON_TIME = f"{CU} <= {E}"


def metric_sql(since: str, min_state: int, min_freight: int, min_seller: int, min_category: int,
               trend_periods: tuple[int, int]) -> dict[str, str]:
    q: dict[str, str] = {}
    day_case, weight_case = DAY_CASE, WEIGHT_CASE
    (n1, s1), (n2, s2), (n3, s3) = STAGE_NAMES
    on, late = ON_TIME_LABEL, LATE_LABEL
    q["q1a_delivery_stats"] = f"""
SELECT round(avg(x) / 24, 2) AS avg_days,
       round(quantile_cont(x, 0.5) / 24, 2) AS median_days,
       round(quantile_cont(x, 0.9) / 24, 2) AS p90_days
FROM (SELECT {h(P, CU)} AS x FROM dlv WHERE {P} IS NOT NULL AND {CU} IS NOT NULL)"""
    q["q1b_delivery_histogram"] = f"""
SELECT {day_case} AS delivery_time,
       count(*) AS total_orders
FROM (SELECT {d(P, CU)} AS dd FROM dlv WHERE {P} IS NOT NULL AND {CU} IS NOT NULL)
GROUP BY 1"""
    q["q1c_on_time_counts"] = f"""
SELECT count(*) AS total_orders,
       count(*) FILTER (WHERE {ON_TIME}) AS on_time_orders,
       count(*) FILTER (WHERE {LATE}) AS late_orders
FROM dlv WHERE {CU} IS NOT NULL AND {E} IS NOT NULL"""
    q["q1d_on_time_rates"] = f"""
SELECT {rate(f"count(*) FILTER (WHERE {ON_TIME})", "count(*)")} AS on_time_rate,
       {rate(f"count(*) FILTER (WHERE {LATE})", "count(*)")} AS late_rate
FROM dlv WHERE {CU} IS NOT NULL AND {E} IS NOT NULL"""

    def monthly_avg(lower: str) -> str:
        return f"""
SELECT CAST(date_trunc('month', {P}) AS DATE) AS month, round(avg({d(P, CU)}), 2) AS avg_delivery_days
FROM dlv WHERE {P} IS NOT NULL AND {CU} IS NOT NULL {lower}
GROUP BY 1 ORDER BY 1"""

    since_cond = f"AND {P} >= TIMESTAMP '{since}'"
    q["q2a_monthly_delivery"] = monthly_avg(since_cond)
    q["q2b_monthly_on_time"] = f"""
SELECT CAST(date_trunc('month', {P}) AS DATE) AS month,
       {rate(f"count(*) FILTER (WHERE {ON_TIME})", "count(*)")} AS on_time_rate
FROM dlv WHERE {CU} IS NOT NULL AND {E} IS NOT NULL {since_cond}
GROUP BY 1 ORDER BY 1"""
    q["q2c_monthly_delivery_all"] = monthly_avg("")
    q["q2d_monthly_on_time"] = q["q2b_monthly_on_time"]
    q["q2e_estimate_vs_actual"] = f"""
SELECT round(avg({d(P, E)}), 2) AS avg_estimated_days, round(avg({d(P, CU)}), 2) AS avg_actual_days FROM dlv"""
    q["estimate_gap"] = f"""
SELECT round(avg({d(P, E)}), 2) AS avg_estimated_days, round(avg({d(P, CU)}), 2) AS avg_actual_days,
       round(avg({d(P, E)}) - avg({d(P, CU)}), 2) AS gap_days FROM dlv"""
    q["q2f_days_early"] = f"SELECT round(avg({d(CU, E)}), 2) AS avg_days_early FROM dlv"

    status = f"CASE WHEN o.{CU} <= o.{E} THEN '{on}' ELSE '{late}' END"
    q["q3a_review_by_status"] = f"""
SELECT {status} AS delivery_status, round(avg(r.review_score), 2) AS avg_review_score, count(*) AS total_orders
FROM dlv o JOIN rev r ON o.order_id = r.order_id
WHERE r.review_score IS NOT NULL
GROUP BY 1"""
    q["q3b_review_rows"] = f"""
SELECT o.order_id AS order_id, r.review_score AS review_score, {status} AS delivery_status
FROM dlv o JOIN rev r ON o.order_id = r.order_id
WHERE r.review_score IS NOT NULL"""
    q["q4a_stage_lead_time"] = f"""
SELECT {n1} AS sort_order, '{s1}' AS stage, round(avg({h(P, A)}) / 24, 2) AS avg_days
FROM dlv WHERE {P} IS NOT NULL AND {A} IS NOT NULL
UNION ALL
SELECT {n2}, '{s2}', round(avg({h(A, C)}) / 24, 2)
FROM dlv WHERE {A} IS NOT NULL AND {C} IS NOT NULL
UNION ALL
SELECT {n3}, '{s3}', round(avg({h(C, CU)}) / 24, 2)
FROM dlv WHERE {C} IS NOT NULL AND {CU} IS NOT NULL
ORDER BY sort_order"""
    q["q4b_stage_by_status"] = f"""
, dd AS (
  SELECT CASE WHEN {ON_TIME} THEN '{on}' ELSE '{late}' END AS st,
         {h(P, A)} AS pay, {h(A, C)} AS sel, {h(C, CU)} AS lgs
  FROM dlv WHERE {P} IS NOT NULL AND {A} IS NOT NULL AND {C} IS NOT NULL AND {CU} IS NOT NULL)
SELECT '{s1}' AS stage, round(avg(pay) FILTER (WHERE st = '{on}') / 24, 2) AS on_time_days,
       round(avg(pay) FILTER (WHERE st = '{late}') / 24, 2) AS late_days FROM dd
UNION ALL
SELECT '{s2}', round(avg(sel) FILTER (WHERE st = '{on}') / 24, 2),
       round(avg(sel) FILTER (WHERE st = '{late}') / 24, 2) FROM dd
UNION ALL
SELECT '{s3}', round(avg(lgs) FILTER (WHERE st = '{on}') / 24, 2),
       round(avg(lgs) FILTER (WHERE st = '{late}') / 24, 2) FROM dd"""
    q["q5a_state_delivery"] = f"""
SELECT c.customer_state AS customer_state, round(avg({h(P, CU, 'o')}) / 24, 2) AS avg_delivery_days,
       count(*) AS total_delivered_orders
FROM dlv o JOIN cust c ON o.customer_id = c.customer_id
WHERE o.{P} IS NOT NULL AND o.{CU} IS NOT NULL
GROUP BY c.customer_state HAVING count(*) >= {min_state}
ORDER BY avg_delivery_days DESC"""
    late_o = f"o.{CU} > o.{E}"
    q["q5b_state_late_rate"] = f"""
SELECT c.customer_state AS customer_state, count(*) AS total_delivered_orders,
       count(*) FILTER (WHERE {late_o}) AS late_deliveries,
       {rate(f"count(*) FILTER (WHERE {late_o})", "count(*)")} AS late_delivery_rate
FROM dlv o JOIN cust c ON o.customer_id = c.customer_id
WHERE o.{CU} IS NOT NULL AND o.{E} IS NOT NULL
GROUP BY c.customer_state HAVING count(*) >= {min_state}
ORDER BY late_delivery_rate DESC"""
    q["q5c_state_freight"] = f"""
SELECT c.customer_state AS customer_state, round(avg(i.freight_value), 2) AS avg_freight_cost,
       count(*) AS total_items_shipped
FROM items i JOIN dlv o ON i.order_id = o.order_id JOIN cust c ON o.customer_id = c.customer_id
GROUP BY c.customer_state HAVING count(*) >= {min_freight}
ORDER BY avg_freight_cost DESC"""
    late_id = f"CASE WHEN {late_o} THEN o.order_id END"
    seller_late = f"""
FROM items i JOIN dlv o ON i.order_id = o.order_id
WHERE o.{CU} IS NOT NULL AND o.{E} IS NOT NULL
GROUP BY i.seller_id HAVING count(DISTINCT o.order_id) >= {min_seller}"""
    q["q6a_seller_late_rate"] = f"""
SELECT i.seller_id AS seller_id, count(DISTINCT o.order_id) AS total_delivered_orders,
       count(DISTINCT {late_id}) AS late_deliveries,
       {rate(f"count(DISTINCT {late_id})", "count(DISTINCT o.order_id)")} AS late_delivery_rate
{seller_late}
ORDER BY late_delivery_rate DESC, seller_id LIMIT 20"""
    q["q6b_seller_processing"] = f"""
SELECT i.seller_id AS seller_id, count(DISTINCT o.order_id) AS total_delivered_orders,
       round(avg({h(A, C, 'o')}) / 24, 2) AS avg_processing_days
FROM items i JOIN dlv o ON i.order_id = o.order_id
WHERE o.{A} IS NOT NULL AND o.{C} IS NOT NULL
GROUP BY i.seller_id HAVING count(DISTINCT o.order_id) >= {min_seller}
ORDER BY avg_processing_days DESC NULLS LAST, seller_id LIMIT 20"""
    q["q6c_seller_scatter"] = f"""
SELECT i.seller_id AS seller_id, count(DISTINCT o.order_id) AS total_orders,
       {rate(f"count(DISTINCT {late_id})", "count(DISTINCT o.order_id)")} AS late_delivery_rate
{seller_late}"""
    cat_from = """
FROM items i JOIN dlv o ON i.order_id = o.order_id JOIN prod p ON i.product_id = p.product_id
LEFT JOIN ct ON p.product_category_name = ct.product_category_name"""
    q["q7a_category_delivery"] = f"""
SELECT coalesce(ct.product_category_name_english, '') AS product_category,
       round(avg({h(P, CU, 'o')}) / 24, 2) AS avg_delivery_days, count(*) AS total_items_sold
{cat_from}
GROUP BY 1 HAVING count(*) >= {min_category}
ORDER BY avg_delivery_days DESC NULLS LAST, product_category LIMIT 10"""
    q["q7b_weight_delivery"] = f"""
SELECT {weight_case} AS weight_category,
       round(avg({h(P, CU, 'o')}) / 24, 2) AS avg_delivery_days, count(*) AS total_items_sold
FROM items i JOIN dlv o ON i.order_id = o.order_id JOIN prod p ON i.product_id = p.product_id
GROUP BY 1 ORDER BY avg_delivery_days DESC"""
    q["q7c_category_late_rate"] = f"""
SELECT coalesce(ct.product_category_name_english, '') AS product_category, count(*) AS total_items_sold,
       count(*) FILTER (WHERE {late_o}) AS late_deliveries,
       {rate(f"count(*) FILTER (WHERE {late_o})", "count(*)")} AS late_delivery_rate
{cat_from}
GROUP BY 1 HAVING count(*) >= {min_category}
ORDER BY late_delivery_rate DESC, product_category LIMIT 10"""
    state_from = f"""
FROM dlv o JOIN items i ON o.order_id = i.order_id JOIN cust c ON o.customer_id = c.customer_id
WHERE o.{P} IS NOT NULL AND o.{CU} IS NOT NULL AND i.freight_value IS NOT NULL
GROUP BY c.customer_state"""
    q["q8a_state_delivery_freight"] = f"""
SELECT c.customer_state AS customer_state, round(avg({h(P, CU, 'o')}) / 24, 2) AS avg_delivery_days,
       round(avg(i.freight_value), 2) AS avg_freight_cost, count(*) AS total_orders
{state_from}
ORDER BY avg_delivery_days DESC"""
    q["q8b_state_late_freight"] = f"""
SELECT c.customer_state AS customer_state, count(*) AS total_orders,
       {rate(f"count(*) FILTER (WHERE {late_o})", f"count({late_o})")} AS late_delivery_rate,
       round(avg(i.freight_value), 2) AS avg_freight_cost
{state_from}
ORDER BY late_delivery_rate DESC"""

    def trend(base: str, value: str, periods: int) -> str:
        return f"""
, m AS ({q[base].strip()})
SELECT m.month AS month, m.{value} AS value, p.{value} AS prev_value,
       {rate(f"m.{value} - p.{value}", f"p.{value}")} AS change_pct
FROM m LEFT JOIN m p ON p.month = m.month - INTERVAL {periods} MONTH ORDER BY m.month"""
    q["trend_delivery_days"] = trend("q2a_monthly_delivery", "avg_delivery_days", trend_periods[0])
    q["trend_on_time_rate"] = trend("q2b_monthly_on_time", "on_time_rate", trend_periods[1])
    return q


def finish(q: dict[str, str]) -> dict[str, str]:
    """Prefix every statement with the shared base CTEs."""
    out = {}
    for k, s in q.items():
        s = s.strip()
        if s.startswith(","):
            out[k] = f"WITH {BASE.strip()}\n{s}"
        else:
            out[k] = with_base(s)
    return out


# --- cleaning outputs and data-quality profiles ------------------------------------------

def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# canonical table -> (clean CTE, typed-before-quarantine CTE, raw row-count source)
CTE = {
    "orders": ("o_clean", "o_typed", "orders"),
    "order_items": ("items", "items", "lineitem"),
    "sellers": ("sell", "sell", "supplier"),
    "customers": ("cust", "cust", "customer"),
    "geolocation": ("geo_clean", "geo_typed", "geo_raw"),
    "order_reviews": ("rev", "rev", "rev"),
    "products": ("prod", "prod", "part"),
    "category_translation": ("ct", "ct", "ct"),
    "order_payments": ("pay", "pay", "orders"),
    "closed_deals": ("deals", "deals", "deals"),
    "mql": ("mql_t", "mql_t", "supplier"),
}
REJECTED_CTE = {"orders": "o_rejected", "geolocation": "geo_rejected"}


def _is_null(col: str, is_text: bool) -> str:
    return f"({col} IS NULL OR {col} = '')" if is_text else f"{col} IS NULL"


def _as_null(col: str, is_text: bool) -> str:
    return f"nullif({col}, '')" if is_text else col


def _listed(numbers) -> str:
    return ", ".join(str(n) for n in numbers)


def _audit_sql(rows: str) -> str:
    return f"""
, a AS ({rows})
SELECT table_name, rows_before, rows_after, rows_rejected,
       rows_before - rows_after - rows_rejected AS rows_duplicate, rows_before - rows_after AS rows_dropped,
       CASE WHEN rows_before > 0
            THEN round(CAST(rows_before - rows_after AS DOUBLE) * 100.0 / CAST(rows_before AS DOUBLE), 2)
            ELSE 0.0 END AS dropped_pct
FROM a"""


# Tables with unreadable cells: name -> (CTE, number of the rule, remainders modulo 97 that are rejected).
MALFORMED = {
    "order_items": ("items", "CAST(order_id AS BIGINT) + order_item_id", (0, 1, 2, 3, 4, 5)),
    "order_reviews": ("rev", "CAST(order_id AS BIGINT)", (0,)),
    "products": ("prod", "CAST(product_id AS BIGINT)", (0,)),
    "order_payments": ("pay", "CAST(order_id AS BIGINT)", (0, 1, 2, 3)),
}
MALFORMED_SQL = {
    "order_items_rejected": """
, m AS (SELECT *, (CAST(order_id AS BIGINT) + order_item_id) % 97 AS m FROM items)
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date,
       CASE WHEN m IN (0, 4) THEN NULL WHEN m = 5 THEN CAST(1e30 AS DOUBLE) ELSE price END AS price,
       CASE WHEN m IN (1, 2) THEN NULL ELSE freight_value END AS freight_value,
       CASE WHEN m IN (0, 4) THEN 'null_in_required:price' WHEN m IN (1, 2) THEN 'null_in_required:freight_value'
            WHEN m = 3 THEN 'non_integer:order_item_id' ELSE 'out_of_range:price' END AS reject_reason
FROM m WHERE m BETWEEN 0 AND 5""",
    "order_reviews_rejected": """
SELECT * REPLACE (CAST(3 AS INTEGER) AS review_score), 'non_integer:review_score' AS reject_reason
FROM rev WHERE CAST(order_id AS BIGINT) % 97 = 0""",
    "products_rejected": """
SELECT * REPLACE (CAST(2 AS INTEGER) AS product_photos_qty), 'non_integer:product_photos_qty' AS reject_reason
FROM prod WHERE CAST(product_id AS BIGINT) % 97 = 0""",
    "order_payments_rejected": """
, m AS (SELECT *, CAST(order_id AS BIGINT) % 97 AS m FROM pay)
SELECT order_id, payment_sequential, payment_type,
       CAST(CASE WHEN m = 1 THEN 1 ELSE payment_installments END AS INTEGER) AS payment_installments,
       CASE WHEN m IN (0, 2) THEN NULL WHEN m = 3 THEN CAST(1e29 AS DOUBLE) ELSE payment_value END AS payment_value,
       CASE WHEN m = 1 THEN 'non_integer:payment_installments' WHEN m = 3 THEN 'out_of_range:payment_value'
            ELSE 'null_in_required:payment_value' END AS reject_reason
FROM m WHERE m BETWEEN 0 AND 3""",
}


def check_sql(schemas) -> dict[str, str]:
    from pyspark.sql import types as T

    def text_cols(name):
        return [(f.name, isinstance(f.dataType, T.StringType)) for f in schemas[name].fields]

    q: dict[str, str] = {}
    for name, (clean, _, _) in CTE.items():
        q[f"clean_{name}"] = f"SELECT * FROM {clean}"
    for name, rej in REJECTED_CTE.items():
        q[f"{name}_rejected"] = f"SELECT * FROM {rej}"

    q |= MALFORMED_SQL
    q["etl_audit_malformed"] = _audit_sql(_union([
        f"SELECT '{name}' AS table_name, count(*) AS rows_before, count(*) FILTER (WHERE NOT bad) AS rows_after, "
        f"count(*) FILTER (WHERE bad) AS rows_rejected FROM (SELECT ({k}) % 97 IN ({_listed(bad)}) AS bad FROM {cte})"
        for name, (cte, k, bad) in MALFORMED.items()]))

    audit = []
    for name, (clean, _, src) in CTE.items():
        rej = REJECTED_CTE.get(name)
        rej_n = f"(SELECT count(*) FROM {rej})" if rej else "CAST(0 AS BIGINT)"
        audit.append(f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {src}) AS rows_before, "
                     f"(SELECT count(*) FROM {clean}) AS rows_after, {rej_n} AS rows_rejected")
    q["etl_audit"] = _audit_sql(_union(audit))

    q["e01_profile_tables"] = _union([
        f"SELECT '{name}' AS table_name, count(*) AS n_rows, {len(schemas[name].fields)} AS n_cols FROM {typed}"
        for name, (_, typed, _) in CTE.items()])
    q["e03_profile_length"] = _union([
        "SELECT 'customers' AS table_name, 'customer_zip_code_prefix' AS column_name, "
        "CAST(min(length(z)) AS INTEGER) AS min_length, CAST(max(length(z)) AS INTEGER) AS max_length "
        "FROM (SELECT CAST(c_custkey % 10000 AS VARCHAR) AS z FROM customer)",
        "SELECT 'geolocation', 'geolocation_zip_code_prefix', CAST(min(length(z)) AS INTEGER), "
        "CAST(max(length(z)) AS INTEGER) FROM (SELECT CAST(c % 30 AS VARCHAR) AS z FROM geo_raw)"])
    q["e04_distinct_review_scores"] = "SELECT DISTINCT review_score FROM rev"

    nulls = []
    for name in CTE:
        typed = CTE[name][1]
        for col, is_text in text_cols(name):
            cond = _is_null(col, is_text)
            nulls.append(
                f"SELECT '{name}' AS table_name, '{col}' AS column_name, "
                f"count(*) FILTER (WHERE {cond}) AS null_count, "
                f"round(coalesce(CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) * 100.0 "
                f"/ CAST(count(*) AS DOUBLE), 0.0), 2) AS null_pct FROM {typed}")
    q["e05_profile_nulls"] = _union(nulls)
    q["e06_profile_nulls_ranked"] = f", n AS ({_union(nulls)}) SELECT * FROM n WHERE null_count > 0"
    q["e07_nulls_by_status"] = f"""
SELECT nullif(order_status, '') AS order_status,
       count(*) FILTER (WHERE {A} IS NULL) AS {A}_nulls,
       count(*) FILTER (WHERE {C} IS NULL) AS {C}_nulls,
       count(*) FILTER (WHERE {CU} IS NULL) AS {CU}_nulls
FROM o_typed GROUP BY 1"""
    q["e08_missing_category_rows"] = """
SELECT product_id, CAST(NULL AS VARCHAR) AS product_category_name, product_name_lenght,
       product_description_lenght, product_photos_qty, product_weight_g, product_height_cm, product_width_cm
FROM prod WHERE product_category_name = ''"""
    q["e08_missing_weight_rows"] = """
SELECT product_id, nullif(product_category_name, '') AS product_category_name, product_weight_g,
       product_height_cm, product_width_cm
FROM prod WHERE product_weight_g IS NULL"""
    q["e09_missing_impact"] = """
SELECT count(*) AS fact_rows FROM items i JOIN prod p ON i.product_id = p.product_id
WHERE p.product_category_name = ''"""
    q["e10_sample_columns"] = """
SELECT nullif(has_company, '') AS has_company, nullif(has_gtin, '') AS has_gtin,
       nullif(average_stock, '') AS average_stock, declared_product_catalog_size
FROM deals ORDER BY mql_id LIMIT 20"""

    deal_cols = [(c, t) for c, t in text_cols("closed_deals") if c in VALUE_COUNT_DEAL_COLS]
    q["e11_value_counts_deals"] = _union([
        f"SELECT '{c}' AS column_name, CAST({_as_null(c, t)} AS VARCHAR) AS value, count(*) AS count "
        f"FROM deals GROUP BY 2" for c, t in deal_cols])
    q["e11_value_counts_origin"] = (
        "SELECT 'origin' AS column_name, nullif(origin, '') AS value, count(*) AS count FROM mql_t GROUP BY 2")

    q["e12_duplicate_census"] = _union([
        f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {CTE[name][1]}) AS total_rows, "
        f"(SELECT count(*) FROM (SELECT DISTINCT * FROM {CTE[name][1]})) AS distinct_rows, "
        f"(SELECT count(*) FROM {CTE[name][1]}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {CTE[name][1]})) "
        f"AS duplicate_rows" for name in CTE])
    gcols = [c for c, _ in text_cols("geolocation")]
    q["e13_duplicate_groups"] = f"""
SELECT {', '.join(gcols)}, count(*) AS count FROM geo_typed
GROUP BY ALL HAVING count(*) > 1
ORDER BY count DESC, {', '.join(c + ' NULLS FIRST' for c in gcols)} LIMIT 20"""

    def rule(table: str, cte: str, name: str, pred: str) -> str:
        return (f"SELECT '{table}' AS table_name, '{name}' AS rule, "
                f"count(*) FILTER (WHERE coalesce({pred}, false)) AS violations FROM {cte}")
    q["e14_range_checks"] = _union([
        rule("order_items", "items", "price_or_freight", "price <= 0 OR freight_value < 0"),
        rule("order_payments", "pay", "value_or_installments", "payment_value <= 0 OR payment_installments <= 0"),
        rule("products", "prod", "weight_or_dimensions",
             "product_weight_g <= 0 OR product_length_cm <= 0 OR product_height_cm <= 0 OR product_width_cm <= 0"),
        rule("geolocation", "geo_typed", "outside_box",
             f"geolocation_lat < {LAT_RANGE[0]} OR geolocation_lat > {LAT_RANGE[1]} "
             f"OR geolocation_lng < {LNG_RANGE[0]} OR geolocation_lng > {LNG_RANGE[1]}"),
        rule("order_reviews", "rev", "score_out_of_range", "review_score < 1 OR review_score > 5"),
    ])
    q["e14_violating_items"] = "SELECT * FROM items WHERE price <= 0 OR freight_value < 0"
    q["e15_violating_payments"] = "SELECT * FROM pay WHERE payment_value <= 0 OR payment_installments <= 0"
    q["e16_violating_products"] = ("SELECT * FROM prod WHERE product_weight_g <= 0 OR product_length_cm <= 0 "
                                   "OR product_height_cm <= 0 OR product_width_cm <= 0")
    q["e17_violating_geolocation"] = ("SELECT * FROM geo_typed WHERE geolocation_lat < -35 OR geolocation_lat > 5 "
                                      "OR geolocation_lng < -75 OR geolocation_lng > -30")
    q["e18_violating_reviews"] = "SELECT * FROM rev WHERE review_score < 1 OR review_score > 5"
    q["e19_order_violations"] = f"""
SELECT count(*) FILTER (WHERE {A} < {P}) AS approved_before_purchase,
       count(*) FILTER (WHERE {C} < {A}) AS carrier_before_approved,
       count(*) FILTER (WHERE {CU} < {C}) AS customer_before_carrier
FROM o_typed"""
    gap = f"(SELECT order_status, date_diff('second', {C}, {A}) AS s FROM o_typed WHERE {C} < {A})"
    q["e20_violation_gap_stats"] = f"""
SELECT min(s) AS min_seconds, max(s) AS max_seconds, avg(s) AS avg_seconds FROM {gap}"""
    q["e21_violations_by_status"] = f"SELECT order_status, count(*) AS count FROM {gap} GROUP BY 1"
    q["e22_violation_gap_buckets"] = f"""
SELECT count(s) AS total, count(*) FILTER (WHERE s < 300) AS under_5_min,
       count(*) FILTER (WHERE s BETWEEN 300 AND 3600) AS from_5_min_to_1_hour,
       count(*) FILTER (WHERE s BETWEEN 3600 AND 86400) AS from_1_hour_to_1_day,
       count(*) FILTER (WHERE s > 86400) AS over_1_day
FROM {gap}"""
    q["e23_dist_status"] = "SELECT nullif(order_status, '') AS order_status, count(*) AS count FROM o_typed GROUP BY 1"
    q["e24_dist_seller_state"] = ("SELECT nullif(seller_state, '') AS seller_state, count(*) AS count FROM sell "
                                  "GROUP BY 1 ORDER BY count DESC, seller_state NULLS FIRST LIMIT 10")
    q["e25_dist_customer_state"] = ("SELECT nullif(customer_state, '') AS customer_state, count(*) AS count FROM cust "
                                    "GROUP BY 1 ORDER BY count DESC, customer_state NULLS FIRST LIMIT 10")
    q["e26_items_per_order"] = """
SELECT min(n) AS min_items, max(n) AS max_items, avg(n) AS avg_items
FROM (SELECT order_id, count(*) AS n FROM items GROUP BY order_id)"""
    q["e27_dist_review_score"] = "SELECT review_score, count(*) AS count FROM rev GROUP BY 1"
    return q


VALUE_COUNT_DEAL_COLS = ("business_segment", "lead_type", "lead_behaviour_profile", "has_company", "has_gtin",
                         "average_stock", "business_type", "declared_product_catalog_size")
