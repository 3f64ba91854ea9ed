"""Named sub-queries; a query takes the ones it mentions, and theirs, along.

Raw tables come from the given tables by the rules of FIXTURES.md. Money is
DECIMAL(12,2) until the final SELECT, ratios are DOUBLE.
"""

from __future__ import annotations

import re

FRAGMENTS: dict[str, str] = {}


def add(name: str, sql: str) -> None:
    FRAGMENTS[name] = sql.strip()


def with_fragments(select: str) -> str:
    """``WITH`` every fragment the statement needs, in order of definition."""
    needed: set[str] = set()
    todo = [select]
    while todo:
        text = todo.pop()
        for name in FRAGMENTS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(FRAGMENTS[name])
    parts = [f"{name} AS (\n{sql}\n)" for name, sql in FRAGMENTS.items() if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + select.strip()


# Columns fitted by the detector are compared at fewer places than the usual six.
DIGITS = {
    "intercept": 3,
    **{c: 4 for c in ("spread", "scale", "forecast", "expected_value", "average_forecast_value", "lower_bound", "upper_bound")},
    **{f"effect_{d}": 4 for d in range(1, 8)},
}


def rounded(expression: str, name: str | None = None) -> str:
    """Adding zero removes a negative zero."""
    return f"(round(CAST({expression} AS DOUBLE), {DIGITS.get(name or expression, 6)}) + 0)"


def over(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0))"


def mean(value: str, where: str | None = None) -> str:
    keep = f" FILTER (WHERE {where})" if where else ""
    return f"(CAST(sum({value}){keep} AS DOUBLE) / nullif(count({value}){keep}, 0))"


def n_if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def channel(source: str) -> str:
    word = r"""[^ \t\n\r!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>]*[ \t\n\r!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>]?"""
    titled = (
        f"array_to_string(list_transform(regexp_extract_all(lower(trim({source})), '{word}'), "
        "lambda w: upper(w[1]) || w[2:]), '')"
    )
    return f"""CASE lower(trim({source}))
        WHEN 'search' THEN 'Search' WHEN 'adwords' THEN 'Search'
        WHEN 'display' THEN 'Display' WHEN 'youtube' THEN 'Display'
        WHEN 'facebook' THEN 'Facebook' WHEN 'email' THEN 'Email' WHEN 'organic' THEN 'Organic'
        ELSE coalesce({titled}, 'Unknown') END"""


def nth(key: str, values: list[str | None]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {key} {arms} END"


# -- raw tables -----------------------------------------------------------------

add(
    "raw_users",
    f"""
SELECT c_custkey AS id, c_name AS first_name, ' Family ' || (c_custkey % 100) AS last_name,
       CASE WHEN c_custkey % 103 <> 102 THEN lower(c_name) || '@Example.com ' END AS email,
       CASE WHEN c_custkey % 50 <> 49 THEN if(c_custkey % 101 = 100, 130, 15 + c_custkey % 60) END AS age,
       if(c_custkey % 2 = 0, ' f', 'M') AS gender,
       CASE WHEN c_custkey % 40 <> 39 THEN n_name END AS state,
       c_custkey || ' Main Street ' AS street_address,
       CAST(10000 + c_custkey % 90000 AS VARCHAR) AS postal_code,
       'City ' || (c_custkey % 70) AS city, r_name AS country,
       CAST(c_custkey % 181 - 90 AS DOUBLE) AS latitude,
       CAST(c_custkey % 361 - 180 AS DOUBLE) AS longitude,
       {nth("c_custkey % 9", ["Search", " adwords ", "Display", "YouTube", "Facebook", "Email", "Organic", "referral-site", None])} AS traffic_source,
       TIMESTAMP '2016-01-01' + to_days(CAST(c_custkey % 365 AS INTEGER)) AS created_at
FROM customer, nation, region
WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey
""",
)
add(
    "raw_orders",
    f"""
SELECT *,
       CASE WHEN plain IN ('SHIPPED', 'COMPLETE', 'RETURNED') THEN created_at + to_days(1) END AS shipped_at,
       CASE WHEN plain IN ('COMPLETE', 'RETURNED')
            THEN created_at + to_days(CAST(2 + order_id % 7 AS INTEGER)) END AS delivered_at,
       CASE WHEN plain = 'RETURNED' THEN created_at + to_days(12) END AS returned_at
FROM (
  SELECT *, upper(trim(status)) AS plain FROM (
    SELECT o_orderkey AS order_id,
           if(o_orderkey % 199 = 198, -o_custkey - 1, o_custkey - if(o_custkey % 20 = 19, 1, 0)) AS user_id,
           CASE WHEN o_orderkey % 307 = 306 THEN 'On hold ' WHEN o_orderstatus = 'F' THEN ' Complete'
                WHEN o_orderstatus = 'O' THEN if(o_orderkey % 2 = 0, 'Shipped', 'complete')
                ELSE {nth("o_orderkey % 3", ["Cancelled", "Returned", "Processing"])} END AS status,
           if(o_custkey % 2 = 0, 'f ', 'm') AS gender,
           o_orderdate + to_days(8217) + to_seconds((o_orderkey * 7919) % 86400) AS created_at,
           1 + o_orderkey % 4 AS num_of_item
    FROM orders))
""",
)
add(
    "raw_order_items",
    """
SELECT *,
       CASE WHEN plain IN ('SHIPPED', 'COMPLETE', 'RETURNED') THEN created_at + to_days(1) END AS shipped_at,
       CASE WHEN plain IN ('COMPLETE', 'RETURNED') THEN created_at + to_days(3) END AS delivered_at,
       CASE WHEN plain = 'RETURNED' THEN created_at + to_days(12) END AS returned_at
FROM (
  SELECT *, id AS inventory_item_id, upper(trim(status)) AS plain FROM (
    SELECT CAST(CAST('0x' || left(md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey,
                    CAST(l_shipdate AS DATE), l_returnflag, l_linestatus,
                    CAST(round(l_extendedprice * 100) AS BIGINT))), 16) AS UBIGINT)
                % 9223372036854775808::UBIGINT AS BIGINT) AS id,
           if(l_orderkey % 311 = 310, -l_orderkey, l_orderkey) AS order_id, l_suppkey AS user_id, l_partkey AS product_id,
           CASE l_returnflag || l_linestatus WHEN 'RF' THEN 'Returned' WHEN 'RO' THEN 'Cancelled'
                WHEN 'AO' THEN ' shipped ' WHEN 'NO' THEN 'Processing' ELSE 'Complete' END AS status,
           l_shipdate + to_days(8217) + to_seconds((l_orderkey * 7919) % 86400) AS created_at,
           l_extendedprice AS sale_price
    FROM lineitem))
""",
)
add(
    "raw_products",
    """
SELECT p_partkey AS id, p_retailprice * if(p_partkey % 89 = 88, 36, 18) AS cost, p_type AS category,
       CASE p_partkey % 100 WHEN 99 THEN '  ' WHEN 98 THEN NULL ELSE p_name END AS name,
       p_brand AS brand, p_retailprice * if(p_partkey % 83 = 82, 0, 30) AS retail_price,
       if(p_partkey % 2 = 0, 'Men', 'women ') AS department, 'SKU-' || (p_partkey - if(p_partkey % 97 = 96, 1, 0)) AS sku,
       p_partkey % (SELECT count(*) FROM supplier) AS distribution_center_id
FROM part
""",
)
add(
    "raw_inventory_items",
    """
SELECT i.inventory_item_id AS id, i.product_id, i.created_at - to_days(30) AS created_at,
       CASE WHEN i.status <> 'Cancelled' THEN i.created_at END AS sold_at, p.cost,
       p.category AS product_category, p.name AS product_name, p.brand AS product_brand,
       p.retail_price AS product_retail_price, p.department AS product_department, p.sku AS product_sku,
       p.distribution_center_id AS product_distribution_center_id
FROM raw_order_items i JOIN raw_products p ON p.id = i.product_id
""",
)
add(
    "raw_distribution_centers",
    """
SELECT s_suppkey AS id, ' ' || s_name AS name, CAST(s_suppkey % 181 - 90 AS DOUBLE) AS latitude,
       CAST(s_suppkey % 361 - 180 AS DOUBLE) AS longitude
FROM supplier
""",
)
add(
    "raw_events",
    f"""
SELECT event_id AS id, CASE WHEN user_id % 10 <> 9 THEN user_id END AS user_id,
       if(user_id % 29 = 28, 1, event_id + 1) AS sequence_number,
       user_id || '-' || CAST(ts AS DATE) || '-' || (hour(ts) // 12) AS session_id,
       ts - to_days(CAST(30 * ((user_id // 6) % 12) AS INTEGER)) AS created_at,
       '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS ip_address,
       'City ' || (user_id % 70) || ' ' AS city, 'State ' || (user_id % 25) AS state,
       CAST(10000 + user_id % 90000 AS VARCHAR) AS postal_code,
       {nth("user_id % 5", ["Chrome", "Firefox", "Safari", " Edge", None])} AS browser,
       {nth("user_id % 6", ["Adwords", "YouTube", "Facebook", "Email", "Organic", None])} AS traffic_source,
       '/' || event_type || '/' || (event_id % 1000) AS uri,
       CASE event_type WHEN 'signup' THEN ' Home '
            WHEN 'view' THEN if(event_id % 2 = 0, 'product', 'department')
            WHEN 'click' THEN if(event_id % 2 = 0, 'product', 'cart')
            WHEN 'purchase' THEN 'Purchase'
            ELSE if(event_id % 4 = 0, 'cancel', 'cart') END AS event_type
FROM events
""",
)
_STATE = nth(
    "doc_id % 7",
    ["PENDING_REVIEW", "PENDING_REVIEW", "PENDING_REVIEW", "APPROVED", "APPROVED", "REJECTED", "NEEDS_REVISION"],
)
add(
    "history",
    f"""
SELECT 'summary-' || (doc_id - if(doc_id % 50 = 49, 1, 0)) AS summary_id,
       CASE WHEN doc_id % 59 <> 58 THEN DATE '2023-12-31' + CAST(doc_id % 3 AS INTEGER) END AS period_start_date,
       DATE '2024-01-30' - if(doc_id % 40 = 39, 60, 0) AS period_end_date,
       CASE WHEN doc_id % 61 <> 60 THEN 'evidence-template-1' END AS model_name,
       if(doc_id % 2 = 0, 'v2.0', 'v1.0') AS prompt_version,
       CASE WHEN doc_id % 71 <> 70 THEN 'v2.0' END AS input_version,
       sha256(text) AS input_hash,
       CASE WHEN doc_id % 53 <> 52 THEN 'Evidence: ' || text END AS prompt_text,
       CASE doc_id % 47 WHEN 45 THEN '   ' WHEN 46 THEN NULL ELSE text END AS generated_summary,
       TIMESTAMP '2024-02-01' + to_seconds(doc_id) AS generated_at,
       CASE WHEN doc_id % 14 <> 13 THEN {_STATE} END AS review_status,
       CASE WHEN doc_id % 7 IN (3, 4, 5) THEN 'Reviewer ' || (doc_id % 5) END AS reviewed_by,
       CASE WHEN doc_id % 7 IN (3, 4, 5) THEN TIMESTAMP '2024-03-01' + to_seconds(doc_id) END AS reviewed_at,
       CASE WHEN doc_id % 7 IN (3, 4, 5) THEN 'checked against the evidence' END AS review_notes
FROM documents
""",
)
add(
    "decisions",
    f"""
SELECT doc_id AS decision_id, 'summary-' || (doc_id - if(doc_id % 50 = 49, 1, 0)) AS summary_id,
       {nth("doc_id % 5", ["APPROVED", "APPROVED", "REJECTED", "REJECTED", "MAYBE"])} AS decision,
       if(doc_id % 17 = 16, '  ', ' Reviewer ' || lang) AS reviewer,
       CASE WHEN doc_id % 19 <> 18 THEN 'batch note ' || source END AS notes,
       doc_id % 23 <> 22 AS evidence_checked,
       if(doc_id % 11 = 10, 'PENDING_REVIEW', {_STATE}) AS seen_status,
       CASE WHEN doc_id % 7 IN (3, 4, 5) AND doc_id % 13 <> 12
            THEN TIMESTAMP '2024-03-01' + to_seconds(doc_id) END AS seen_reviewed_at,
       TIMESTAMP '2024-04-01' + to_seconds(doc_id) AS submitted_at
FROM documents
""",
)

# -- staging --------------------------------------------------------------------

add(
    "stg_users",
    """
SELECT id AS user_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
       lower(trim(email)) AS email, age, upper(trim(gender)) AS gender, trim(state) AS state,
       trim(street_address) AS street_address, trim(postal_code) AS postal_code, trim(city) AS city,
       trim(country) AS country, latitude, longitude, trim(traffic_source) AS acquisition_source,
       created_at AS account_created_at
FROM raw_users
""",
)
add(
    "stg_orders",
    """
SELECT order_id, user_id, upper(trim(status)) AS order_status, upper(trim(gender)) AS customer_gender,
       created_at AS order_created_at, shipped_at, delivered_at, returned_at, num_of_item AS item_count
FROM raw_orders
""",
)
add(
    "stg_order_items",
    """
SELECT id AS order_item_id, order_id, user_id, product_id, inventory_item_id,
       upper(trim(status)) AS order_item_status, created_at AS order_item_created_at,
       shipped_at, delivered_at, returned_at, CAST(sale_price AS DECIMAL(12, 2)) AS sale_price
FROM raw_order_items SEMI JOIN stg_orders USING (order_id)
""",
)
add(
    "stg_order_items_rejected",
    """
SELECT id AS order_item_id, order_id, user_id, product_id, inventory_item_id, status AS order_item_status,
       created_at AS order_item_created_at, CAST(sale_price AS DECIMAL(12, 2)) AS sale_price,
       'ORDER_ID_NOT_FOUND' AS rejection_reason, TIMESTAMP '2024-06-01' AS rejected_at
FROM raw_order_items r
WHERE NOT EXISTS (FROM stg_orders o WHERE o.order_id = r.order_id)
""",
)
add(
    "stg_products",
    """
SELECT id AS product_id, if(coalesce(trim(name), '') = '', 'Unknown Product', trim(name)) AS product_name,
       coalesce(trim(name), '') = '' AS is_product_name_missing, trim(category) AS product_category,
       trim(brand) AS product_brand, upper(trim(department)) AS product_department, trim(sku) AS product_sku,
       CAST(cost AS DECIMAL(12, 2)) AS product_cost, CAST(retail_price AS DECIMAL(12, 2)) AS retail_price,
       distribution_center_id
FROM raw_products
""",
)
add(
    "stg_inventory_items",
    """
SELECT id AS inventory_item_id, product_id, created_at AS inventory_created_at, sold_at,
       CAST(cost AS DECIMAL(12, 2)) AS inventory_cost, trim(product_category) AS product_category,
       trim(product_name) AS product_name, trim(product_brand) AS product_brand,
       CAST(product_retail_price AS DECIMAL(12, 2)) AS retail_price,
       upper(trim(product_department)) AS product_department, trim(product_sku) AS product_sku,
       product_distribution_center_id AS distribution_center_id
FROM raw_inventory_items
""",
)
add(
    "stg_distribution_centers",
    """
SELECT id AS distribution_center_id, trim(name) AS distribution_center_name, latitude, longitude
FROM raw_distribution_centers
""",
)
add(
    "stg_events",
    """
SELECT id AS event_id, user_id, sequence_number AS event_sequence_number, trim(session_id) AS session_id,
       created_at AS event_created_at, sha256(ip_address) AS ip_address_hash, trim(city) AS city,
       trim(state) AS state, trim(postal_code) AS postal_code, trim(browser) AS browser,
       trim(traffic_source) AS traffic_source, trim(uri) AS page_uri, lower(trim(event_type)) AS event_type,
       user_id IS NOT NULL AS is_authenticated_event
FROM raw_events
""",
)

# -- orders and sessions ----------------------------------------------------------

add(
    "int_customer_orders",
    f"""
SELECT o.order_id, any_value(o.user_id) AS user_id, any_value(o.order_status) AS order_status,
       any_value(o.order_created_at) AS order_created_at, any_value(o.shipped_at) AS shipped_at,
       any_value(o.delivered_at) AS delivered_at, any_value(o.returned_at) AS returned_at,
       count(i.order_item_id) AS item_count, count(DISTINCT i.product_id) AS distinct_product_count,
       coalesce(sum(i.sale_price), 0) AS order_revenue, {mean("i.sale_price")} AS average_item_price,
       any_value(date_diff('day', o.order_created_at, o.delivered_at)) AS days_to_delivery,
       bool_or(o.returned_at IS NOT NULL) AS is_returned, bool_or(o.order_status = 'CANCELLED') AS is_cancelled
FROM stg_orders o LEFT JOIN stg_order_items i USING (order_id)
GROUP BY o.order_id
""",
)
add(
    "int_session_funnel",
    """
SELECT *, date_diff('second', session_started_at, session_ended_at) AS session_duration_seconds,
       CASE 1 WHEN reached_purchase THEN 'Purchase' WHEN reached_cart THEN 'Cart'
              WHEN reached_product THEN 'Product' WHEN reached_department THEN 'Department'
              WHEN reached_home THEN 'Home' ELSE 'Other' END AS deepest_funnel_stage,
       reached_purchase AS converted_session,
       if(reached_cart > reached_purchase, 1, 0) AS abandoned_cart_session,
       if(event_count = 1, 1, 0) AS bounced_session
FROM (
  SELECT session_id, max(user_id) AS user_id, max(traffic_source) AS traffic_source, max(browser) AS browser,
         min(event_created_at) AS session_started_at, max(event_created_at) AS session_ended_at,
         count(*) AS event_count, count(DISTINCT event_type) AS distinct_event_type_count,
         CAST(bool_or(event_type = 'home') AS INTEGER) AS reached_home,
         CAST(bool_or(event_type = 'department') AS INTEGER) AS reached_department,
         CAST(bool_or(event_type = 'product') AS INTEGER) AS reached_product,
         CAST(bool_or(event_type = 'cart') AS INTEGER) AS reached_cart,
         CAST(bool_or(event_type = 'purchase') AS INTEGER) AS reached_purchase,
         CAST(bool_or(event_type = 'cancel') AS INTEGER) AS reached_cancel
  FROM stg_events WHERE session_id IS NOT NULL GROUP BY session_id)
""",
)

# -- customers --------------------------------------------------------------------

add(
    "buyer_orders",
    "SELECT * FROM int_customer_orders WHERE order_status = 'COMPLETE'",
)
add(
    "dim_customer",
    f"""
SELECT u.user_id, u.first_name, u.last_name, u.email, u.age, u.gender, u.city, u.state, u.country,
       u.acquisition_source, u.account_created_at AS customer_created_at,
       coalesce(m.n, 0) AS total_order_count, coalesce(m.complete, 0) AS completed_order_count,
       coalesce(m.cancelled, 0) AS cancelled_order_count, coalesce(m.returned, 0) AS returned_order_count,
       coalesce(m.items, 0) AS total_items_ordered, coalesce(m.revenue, 0) AS lifetime_revenue,
       m.average_completed_order_value, m.first_order_at, m.last_order_at, m.age_of_last AS days_since_last_order,
       date_diff('day', u.account_created_at, TIMESTAMP '2024-01-25') AS customer_tenure_days,
       coalesce(m.n, 0) > 1 AS is_repeat_customer,
       CASE WHEN m.first_order_at IS NULL THEN 'Never Purchased' WHEN m.age_of_last <= 30 THEN 'Active'
            WHEN m.age_of_last <= 90 THEN 'At Risk' ELSE 'Inactive' END AS lifecycle_status
FROM stg_users u LEFT JOIN (
  SELECT user_id, count(DISTINCT order_id) AS n, {n_if("order_status = 'COMPLETE'")} AS complete,
         {n_if("order_status = 'CANCELLED'")} AS cancelled, {n_if("order_status = 'RETURNED'")} AS returned,
         sum(item_count) AS items, sum(order_revenue) FILTER (WHERE order_status = 'COMPLETE') AS revenue,
         {mean("order_revenue", "order_status = 'COMPLETE'")} AS average_completed_order_value,
         min(order_created_at) AS first_order_at, max(order_created_at) AS last_order_at,
         date_diff('day', max(order_created_at), TIMESTAMP '2024-01-25') AS age_of_last
  FROM int_customer_orders GROUP BY user_id) m USING (user_id)
""",
)
add(
    "mart_customer_rfm",
    f"""
SELECT *, recency_score || '' || frequency_score || monetary_score AS rfm_score,
       CASE WHEN least(recency_score, frequency_score, monetary_score) >= 4 THEN 'Champions'
            WHEN least(recency_score, frequency_score) >= 3 THEN 'Loyal Customers'
            WHEN recency_score >= 4 AND frequency_score <= 2 THEN 'New or Promising'
            WHEN recency_score <= 2 AND frequency_score >= 3 THEN 'At Risk'
            WHEN recency_score <= 2 THEN 'Hibernating' ELSE 'Needs Attention' END AS customer_segment
FROM (
  SELECT *, ntile(5) OVER (ORDER BY recency_days DESC, user_id) AS recency_score,
         ntile(5) OVER (ORDER BY frequency, user_id) AS frequency_score,
         ntile(5) OVER (ORDER BY monetary_value, user_id) AS monetary_score
  FROM (
    SELECT user_id, any_value(analysis_date) AS analysis_date,
           date_diff('day', CAST(max(order_created_at) AS DATE), any_value(analysis_date)) AS recency_days,
           count(DISTINCT order_id) AS frequency, sum(order_revenue) AS monetary_value,
           {mean("order_revenue")} AS average_order_value, min(order_created_at) AS first_completed_order_at,
           max(order_created_at) AS last_completed_order_at
    FROM buyer_orders, (SELECT CAST(max(order_created_at) AS DATE) + 1 AS analysis_date FROM buyer_orders)
    GROUP BY user_id))
""",
)
add(
    "mart_customer_360",
    """
SELECT sha256(CAST(c.user_id AS VARCHAR)) AS customer_key, c.age,
       CASE WHEN c.age IS NULL THEN 'Unknown' WHEN c.age < 20 THEN 'Under 20' WHEN c.age >= 60 THEN '60+'
            ELSE (c.age // 10 * 10) || '–' || (c.age // 10 * 10 + 9) END AS age_group,
       c.gender, c.city, c.state, c.country, c.acquisition_source, c.customer_created_at, c.total_order_count,
       c.completed_order_count, c.cancelled_order_count, c.returned_order_count, c.total_items_ordered,
       c.lifetime_revenue, c.average_completed_order_value, c.first_order_at, c.last_order_at,
       c.is_repeat_customer, r.analysis_date, r.recency_days, r.frequency, r.monetary_value, r.recency_score,
       r.frequency_score, r.monetary_score, r.rfm_score,
       coalesce(r.customer_segment, 'Never Purchased') AS customer_segment,
       CASE WHEN r.recency_days IS NULL THEN 'Never Purchased' WHEN r.recency_days <= 30 THEN 'Active'
            WHEN r.recency_days <= 90 THEN 'At Risk' ELSE 'Inactive' END AS engagement_status,
       coalesce(CAST(c.returned_order_count AS DOUBLE)
                / nullif(c.completed_order_count + c.returned_order_count, 0), 0) AS customer_return_rate,
       coalesce(CAST(c.cancelled_order_count AS DOUBLE) / nullif(c.total_order_count, 0), 0)
         AS customer_cancellation_rate
FROM dim_customer c LEFT JOIN mart_customer_rfm r USING (user_id)
""",
)
add(
    "mart_customer_segment_summary",
    f"""
SELECT *, {over("customer_count", "sum(customer_count) OVER ()")} AS customer_share,
       {over("total_revenue", "sum(total_revenue) OVER ()")} AS revenue_share,
       {over("repeat_customer_count", "customer_count")} AS repeat_customer_rate,
       map {{'Champions': 'Protect and reward', 'Loyal Customers': 'Cross-sell and increase order value',
            'New or Promising': 'Drive the second purchase', 'At Risk': 'Launch a targeted retention campaign',
            'Hibernating': 'Test a reactivation offer', 'Needs Attention': 'Increase personalized engagement',
            'Never Purchased': 'Improve first-purchase conversion'}}[customer_segment] AS recommended_action
FROM (
  SELECT customer_segment, count(*) AS customer_count, {n_if("is_repeat_customer")} AS repeat_customer_count,
         {n_if("engagement_status = 'Active'")} AS active_customer_count,
         {n_if("engagement_status = 'At Risk'")} AS at_risk_customer_count,
         {n_if("engagement_status = 'Inactive'")} AS inactive_customer_count,
         {n_if("engagement_status = 'Never Purchased'")} AS never_purchased_customer_count,
         sum(total_order_count) AS total_orders, sum(completed_order_count) AS completed_orders,
         sum(lifetime_revenue) AS total_revenue, {mean("lifetime_revenue")} AS average_customer_value,
         avg(average_completed_order_value) AS average_order_value, {mean("recency_days")} AS average_recency_days,
         avg(customer_return_rate) AS average_return_rate,
         avg(customer_cancellation_rate) AS average_cancellation_rate
  FROM mart_customer_360 GROUP BY customer_segment)
""",
)

# -- go-to-market -----------------------------------------------------------------

_VALUE = f"""
         sum(total_order_count) AS total_orders, sum(completed_order_count) AS completed_orders,
         sum(lifetime_revenue) AS total_revenue,
         {mean("lifetime_revenue")} AS average_revenue_per_acquired_customer,
         {mean("lifetime_revenue", "completed_order_count > 0")} AS average_revenue_per_purchasing_customer,
         avg(average_completed_order_value) AS average_order_value,
         avg(customer_return_rate) AS average_customer_return_rate,
         avg(customer_cancellation_rate) AS average_customer_cancellation_rate"""
add(
    "mart_acquisition_channel_performance",
    f"""
SELECT *, rank() OVER (ORDER BY total_revenue DESC NULLS FIRST) AS revenue_rank,
       rank() OVER (ORDER BY customer_conversion_rate DESC NULLS FIRST) AS conversion_rank
FROM (
  SELECT *, {over("purchasing_customer_count", "acquired_customer_count")} AS customer_conversion_rate,
         {over("repeat_customer_count", "purchasing_customer_count")} AS repeat_purchaser_rate,
         {over("active_customer_count", "purchasing_customer_count")} AS active_purchaser_rate,
         {over("total_revenue", "sum(total_revenue) OVER ()")} AS revenue_share
  FROM (
    SELECT {channel("acquisition_source")} AS acquisition_channel, count(*) AS acquired_customer_count,
           {n_if("completed_order_count > 0")} AS purchasing_customer_count,
           {n_if("completed_order_count > 1")} AS repeat_customer_count,
           {n_if("engagement_status = 'Active'")} AS active_customer_count,
           {n_if("engagement_status = 'At Risk'")} AS at_risk_customer_count,
           {n_if("engagement_status = 'Inactive'")} AS inactive_customer_count,{_VALUE}
    FROM mart_customer_360 GROUP BY 1))
""",
)
add(
    "regions",
    f"""
SELECT *, {over("purchasing_customer_count", "acquired_customer_count")} AS customer_conversion_rate,
       {over("repeat_purchaser_count", "purchasing_customer_count")} AS repeat_purchaser_rate,
       {over("total_revenue", "sum(total_revenue) OVER ()")} AS revenue_share,
       dense_rank() OVER (ORDER BY total_revenue DESC) AS global_revenue_rank,
       dense_rank() OVER (PARTITION BY country ORDER BY total_revenue DESC) AS state_revenue_rank_within_country
FROM (
  SELECT coalesce(country, 'Unknown') AS country, coalesce(state, 'Unknown') AS state,
         count(*) AS acquired_customer_count, {n_if("completed_order_count > 0")} AS purchasing_customer_count,
         {n_if("completed_order_count > 1")} AS repeat_purchaser_count,{_VALUE}
  FROM mart_customer_360 GROUP BY 1, 2)
""",
)
add(
    "mart_geographic_performance",
    f"""
SELECT r.*,
       CASE WHEN average_customer_return_rate > b.returns THEN 'Investigate product fit or fulfillment quality'
            WHEN customer_conversion_rate < b.conversion THEN 'Improve regional acquisition conversion'
            WHEN repeat_purchaser_rate < b.again THEN 'Develop regional retention campaigns'
            WHEN global_revenue_rank <= 10 THEN 'Protect and expand high-value market'
            ELSE 'Monitor market performance' END AS recommended_action
FROM regions r, (
  SELECT avg(average_customer_return_rate) AS returns,
         {over("sum(purchasing_customer_count)", "sum(acquired_customer_count)")} AS conversion,
         {over("sum(repeat_purchaser_count)", "sum(purchasing_customer_count)")} AS again
  FROM regions) b
""",
)
_SESSION_COUNTS = f"""
         {n_if("reached_product = 1")} AS product_sessions, {n_if("reached_cart = 1")} AS cart_sessions,
         {n_if("reached_purchase = 1")} AS purchase_sessions,
         {n_if("reached_product + reached_cart = 2")} AS product_to_cart_sessions,
         {n_if("reached_cart + reached_purchase = 2")} AS cart_to_purchase_sessions,
         sum(abandoned_cart_session) AS abandoned_cart_sessions, sum(bounced_session) AS bounced_sessions,
         {mean("session_duration_seconds")} AS average_session_duration_seconds,
         {mean("event_count")} AS average_events_per_session"""
_SESSION_RATES = f"""
       {over("purchase_sessions", "total_sessions")} AS session_conversion_rate,
       {over("product_to_cart_sessions", "product_sessions")} AS product_to_cart_rate,
       {over("cart_to_purchase_sessions", "cart_sessions")} AS cart_to_purchase_rate,
       {over("abandoned_cart_sessions", "cart_sessions")} AS cart_abandonment_rate,
       {over("bounced_sessions", "total_sessions")} AS bounce_rate"""
add(
    "mart_conversion_funnel",
    f"""
SELECT *, {over("product_sessions", "total_sessions")} AS product_view_rate,{_SESSION_RATES}
FROM (
  SELECT CAST(session_started_at AS DATE) AS session_date, {channel("traffic_source")} AS acquisition_channel,
         coalesce(browser, 'Unknown') AS browser, count(*) AS total_sessions,
         count(DISTINCT user_id) AS unique_users, sum(reached_home) AS home_sessions,
         sum(reached_department) AS department_sessions,{_SESSION_COUNTS}
  FROM int_session_funnel GROUP BY 1, 2, 3)
""",
)
add(
    "channel_sessions",
    f"""
SELECT acquisition_channel, acquired_customer_count, purchasing_customer_count, repeat_customer_count,
       total_orders, total_revenue, average_revenue_per_acquired_customer,
       average_revenue_per_purchasing_customer, average_order_value, customer_conversion_rate,
       repeat_purchaser_rate, revenue_share, s.* EXCLUDE (acquisition_channel),{_SESSION_RATES}
FROM mart_acquisition_channel_performance LEFT JOIN (
  SELECT {channel("traffic_source")} AS acquisition_channel, count(*) AS total_sessions,{_SESSION_COUNTS}
  FROM int_session_funnel GROUP BY 1) s USING (acquisition_channel)
""",
)
add(
    "mart_gtm_channel_summary",
    f"""
SELECT c.*, dense_rank() OVER (ORDER BY total_revenue DESC NULLS FIRST) AS revenue_rank,
       dense_rank() OVER (ORDER BY session_conversion_rate DESC NULLS FIRST) AS session_conversion_rank,
       CASE WHEN session_conversion_rate >= b.sessions AND repeat_purchaser_rate >= b.again
              THEN 'Scale high-performing channel'
            WHEN cart_abandonment_rate > b.abandoned THEN 'Investigate cart and checkout abandonment'
            WHEN customer_conversion_rate < b.customers
              THEN 'Improve acquisition targeting and landing experience'
            WHEN repeat_purchaser_rate < b.again THEN 'Strengthen retention and repeat-purchase campaigns'
            ELSE 'Monitor and test incremental improvements' END AS recommended_action
FROM channel_sessions c, (
  SELECT {over("sum(purchase_sessions)", "sum(total_sessions)")} AS sessions,
         {over("sum(abandoned_cart_sessions)", "sum(cart_sessions)")} AS abandoned,
         {over("sum(purchasing_customer_count)", "sum(acquired_customer_count)")} AS customers,
         {over("sum(repeat_customer_count)", "sum(purchasing_customer_count)")} AS again
  FROM channel_sessions) b
""",
)
add(
    "starts",
    """
SELECT user_id, CAST(date_trunc('month', min(order_created_at)) AS DATE) AS cohort_month
FROM buyer_orders GROUP BY user_id
""",
)
add(
    "mart_customer_cohort_retention",
    f"""
SELECT cohort_month, activity_month, date_diff('month', cohort_month, activity_month) AS months_since_first_purchase,
       z.cohort_size, active_customers, completed_orders, monthly_revenue,
       {over("active_customers", "z.cohort_size")} AS retention_rate,
       {over("monthly_revenue", "active_customers")} AS revenue_per_active_customer,
       sum(monthly_revenue) OVER (PARTITION BY cohort_month ORDER BY activity_month
                                  ROWS UNBOUNDED PRECEDING) AS cumulative_cohort_revenue
FROM (
  SELECT cohort_month, CAST(date_trunc('month', order_created_at) AS DATE) AS activity_month,
         count(DISTINCT user_id) AS active_customers, count(DISTINCT order_id) AS completed_orders,
         sum(order_revenue) AS monthly_revenue
  FROM buyer_orders JOIN starts USING (user_id) GROUP BY 1, 2)
JOIN (SELECT cohort_month, count(*) AS cohort_size FROM starts GROUP BY 1) z USING (cohort_month)
""",
)
_SOLD = "order_item_status = 'COMPLETE'"
add(
    "mart_product_performance",
    f"""
SELECT *, completed_revenue - completed_product_cost AS estimated_gross_profit,
       {over("completed_revenue - completed_product_cost", "completed_revenue")} AS estimated_gross_margin,
       {over("returned_units", "completed_units + returned_units")} AS product_return_rate,
       {over("cancelled_units", "ordered_units")} AS product_cancellation_rate,
       {over("completed_revenue", "completed_units")} AS revenue_per_completed_unit,
       dense_rank() OVER (ORDER BY completed_revenue DESC) AS revenue_rank,
       dense_rank() OVER (ORDER BY completed_revenue - completed_product_cost DESC) AS gross_profit_rank
FROM (
  SELECT p.product_id, p.product_name, p.product_brand, p.product_category, p.product_department,
         p.retail_price, p.product_cost, count(*) AS ordered_units,
         count(DISTINCT i.order_id) AS unique_orders, count(DISTINCT i.user_id) AS unique_customers,
         {n_if(_SOLD)} AS completed_units, {n_if("order_item_status = 'RETURNED'")} AS returned_units,
         {n_if("order_item_status = 'CANCELLED'")} AS cancelled_units,
         coalesce(sum(i.sale_price) FILTER (WHERE {_SOLD}), 0) AS completed_revenue,
         coalesce(sum(p.product_cost) FILTER (WHERE {_SOLD}), 0) AS completed_product_cost,
         {mean("i.sale_price", _SOLD)} AS average_selling_price
  FROM stg_order_items i JOIN stg_products p USING (product_id)
  GROUP BY ALL)
""",
)

# -- monitoring and detector --------------------------------------------------------

_DAILY = [
    "total_orders", "completed_orders", "cancelled_orders", "returned_orders", "completed_revenue",
    "total_sessions", "product_sessions", "cart_sessions", "purchase_sessions", "product_to_cart_sessions",
    "cart_to_purchase_sessions", "abandoned_cart_sessions", "bounced_sessions",
]
add(
    "mart_daily_business_kpis",
    f"""
SELECT *,{_SESSION_RATES},
       {over("completed_revenue", "completed_orders")} AS average_order_value,
       {over("cancelled_orders", "total_orders")} AS order_cancellation_rate,
       {over("returned_orders", "completed_orders + returned_orders")} AS order_return_rate
FROM (
  SELECT metric_date, acquisition_channel, {", ".join(f"coalesce({c}, 0) AS {c}" for c in _DAILY)}
  FROM (
    SELECT CAST(order_created_at AS DATE) AS metric_date, coalesce(c.channel, 'Unknown') AS acquisition_channel,
           count(DISTINCT order_id) AS total_orders, {n_if("order_status = 'COMPLETE'")} AS completed_orders,
           {n_if("order_status = 'CANCELLED'")} AS cancelled_orders,
           {n_if("order_status = 'RETURNED'")} AS returned_orders,
           sum(order_revenue) FILTER (WHERE order_status = 'COMPLETE') AS completed_revenue
    FROM int_customer_orders
    LEFT JOIN (SELECT user_id, {channel("acquisition_source")} AS channel FROM stg_users) c USING (user_id)
    GROUP BY 1, 2)
  FULL JOIN (
    SELECT session_date AS metric_date, acquisition_channel,
           {", ".join(f"sum({c}) AS {c}" for c in _DAILY[5:])}
    FROM mart_conversion_funnel GROUP BY 1, 2) USING (metric_date, acquisition_channel))
""",
)
_KPIS = {
    "COMPLETED_REVENUE": "completed_revenue",
    "TOTAL_ORDERS": "total_orders",
    "SESSION_CONVERSION_RATE": "session_conversion_rate",
    "CART_ABANDONMENT_RATE": "cart_abandonment_rate",
    "AVERAGE_ORDER_VALUE": "average_order_value",
}
add(
    "int_kpi_anomaly_input",
    f"""
SELECT acquisition_channel || '|' || metric_name AS series_key, acquisition_channel, metric_name,
       CAST(metric_date AS TIMESTAMP) AS metric_timestamp, metric_value,
       if(metric_date < (SELECT max(metric_date) - 30 FROM mart_daily_business_kpis), 'TRAIN', 'SCORE')
         AS dataset_split
FROM (UNPIVOT (SELECT metric_date, acquisition_channel,
                      {", ".join(f"CAST({c} AS DOUBLE) AS {k}" for k, c in _KPIS.items())}
               FROM mart_daily_business_kpis)
      ON {", ".join(_KPIS)} INTO NAME metric_name VALUE metric_value)
""",
)
for _split in ("train", "score"):
    add(
        f"kpi_{_split}",
        f"SELECT series_key, metric_timestamp, metric_value FROM int_kpi_anomaly_input "
        f"WHERE dataset_split = '{_split.upper()}'",
    )
_T = "CAST(date_diff('day', DATE '2020-01-01', CAST(metric_timestamp AS DATE)) AS DOUBLE)"
add(
    "trend",
    f"""
SELECT series_key, regr_slope(metric_value, {_T}) AS slope, regr_intercept(metric_value, {_T}) AS intercept,
       count(metric_value) AS train_rows
FROM kpi_train GROUP BY series_key
""",
)
add(
    "residuals",
    f"""
SELECT series_key, dayofweek(metric_timestamp) + 1 AS weekday,
       metric_value - (intercept + slope * {_T}) AS residual
FROM kpi_train JOIN trend USING (series_key)
""",
)
add(
    "weekday_effects",
    "SELECT series_key, weekday, avg(residual) AS effect FROM residuals GROUP BY ALL",
)
add(
    "kpi_detector_params",
    f"""
SELECT t.series_key, t.train_rows, t.slope, t.intercept, s.spread,
       (SELECT sqrt(avg(metric_value * metric_value)) FROM kpi_train k WHERE k.series_key = t.series_key) AS scale,
       {", ".join(f"coalesce((SELECT effect FROM weekday_effects w WHERE w.series_key = t.series_key AND w.weekday = {d}), 0) AS effect_{d}" for d in range(1, 8))}
FROM trend t LEFT JOIN (
  SELECT series_key, stddev_samp(residual - effect) AS spread
  FROM residuals JOIN weekday_effects USING (series_key, weekday) GROUP BY series_key) s USING (series_key)
""",
)
_ERF = (
    "1 - ((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t"
    " * exp(-x * x)"
)
add(
    "kpi_anomaly_results",
    f"""
SELECT series, ts, y, forecast, lower_bound, upper_bound, y NOT BETWEEN lower_bound AND upper_bound AS is_anomaly,
       0.5 + 0.5 * sign(distance) * ({_ERF}) AS percentile, distance
FROM (
  SELECT *, 1 / (1 + 0.3275911 * x) AS t FROM (
    SELECT *, abs(distance) / sqrt(2) AS x, forecast - 2.575829 * spread AS lower_bound,
           forecast + 2.575829 * spread AS upper_bound
    FROM (
      SELECT *, (y - forecast) / spread AS distance FROM (
        SELECT kpi_score.series_key AS series, metric_timestamp AS ts, metric_value AS y, spread,
               intercept + slope * {_T} + coalesce(effect, 0) AS forecast
        FROM kpi_score JOIN kpi_detector_params USING (series_key)
        LEFT JOIN (SELECT series_key, weekday - 1 AS weekday, effect FROM weekday_effects) w
          ON w.series_key = kpi_score.series_key AND w.weekday = dayofweek(metric_timestamp)
        WHERE train_rows >= 14 AND spread > 1e-7 * scale))))
""",
)

# -- governance ---------------------------------------------------------------------

add(
    "anomaly_standardized",
    """
SELECT series AS series_key, split_part(series, '|', 1) AS channel, split_part(series, '|', 2) AS metric_name,
       ts AS metric_timestamp, y AS actual_value, forecast AS expected_value, lower_bound, upper_bound,
       is_anomaly, percentile, distance
FROM kpi_anomaly_results
""",
)
add(
    "reporting_period",
    f"""
SELECT CAST(min(ts) AS DATE) AS period_start_date, CAST(max(ts) AS DATE) AS period_end_date,
       count(*) AS scored_observations, count(DISTINCT series) AS scored_kpis, {n_if("is_anomaly")} AS total_anomalies
FROM kpi_anomaly_results
""",
)


def places(expression: str, n: int) -> str:
    return f"CAST(round({expression}, {n}) AS DECIMAL(38, {n}))"


add(
    "kpi_rollup",
    f"""
SELECT series_key, channel, metric_name, {places(mean("CAST(actual_value AS DECIMAL(28, 10))"), 2)} AS average_actual_value,
       {places(mean("CAST(expected_value AS DECIMAL(28, 10))"), 2)} AS average_expected_value,
       {places("100 * (avg(actual_value) - avg(expected_value)) / nullif(abs(avg(expected_value)), 0)", 2)}
         AS variance_from_expected_pct,
       {places("arg_max(actual_value, metric_timestamp)", 2)} AS latest_actual_value,
       {places("arg_max(expected_value, metric_timestamp)", 2)} AS latest_expected_value,
       CAST(max(metric_timestamp) AS DATE) AS latest_metric_date, {n_if("is_anomaly")} AS anomaly_count,
       CASE WHEN metric_name = 'CART_ABANDONMENT_RATE' THEN 'LOWER_IS_BETTER'
            WHEN metric_name IN ('AVERAGE_ORDER_VALUE', 'COMPLETED_REVENUE', 'SESSION_CONVERSION_RATE',
                                 'TOTAL_ORDERS') THEN 'HIGHER_IS_BETTER'
            ELSE 'CONTEXT_DEPENDENT' END AS desired_direction
FROM anomaly_standardized GROUP BY series_key, channel, metric_name
""",
)
add(
    "ranked_anomalies",
    f"""
SELECT printf('ANOM-%04d', severity_rank) AS evidence_id, series_key, channel, metric_name,
       CAST(metric_timestamp AS DATE) AS metric_date, {places("actual_value", 2)} AS actual_value,
       {places("expected_value", 2)} AS expected_value, {places("lower_bound", 2)} AS lower_bound,
       {places("upper_bound", 2)} AS upper_bound, {places("distance", 4)} AS distance,
       {places("percentile", 6)} AS percentile,
       if(distance > 0, 'ABOVE_EXPECTED_RANGE', 'BELOW_EXPECTED_RANGE') AS anomaly_direction, severity_rank
FROM (SELECT *, row_number() OVER (ORDER BY abs(distance) DESC, metric_timestamp DESC, series_key) AS severity_rank
      FROM anomaly_standardized WHERE is_anomaly)
""",
)


def json_object(fields: dict[str, str], texts: set[str]) -> str:
    """JSON text with alphabetical keys; ``texts`` are the quoted values."""

    def value(key: str, column: str) -> str:
        quoted = f"""'"' || {column} || '"'""" if key in texts else f"CAST({column} AS VARCHAR)"
        return f"""'"{key}":' || coalesce({quoted}, 'null')"""

    return "'{' || " + " || ',' || ".join(value(k, fields[k]) for k in sorted(fields)) + " || '}'"


_KPI_JSON = json_object(
    {
        "series_key": "series_key", "channel": "channel", "metric_name": "metric_name",
        "average_actual": "average_actual_value", "average_expected": "average_expected_value",
        "variance_from_expected_pct": "variance_from_expected_pct", "latest_actual": "latest_actual_value",
        "latest_expected": "latest_expected_value", "latest_metric_date": "latest_metric_date",
        "anomaly_count": "anomaly_count", "desired_direction": "desired_direction",
    },
    {"series_key", "channel", "metric_name", "latest_metric_date", "desired_direction"},
)
_ANOMALY_JSON = json_object(
    {c: c for c in ("evidence_id", "severity_rank", "series_key", "channel", "metric_name", "metric_date",
                    "actual_value", "expected_value", "lower_bound", "upper_bound", "distance", "percentile")}
    | {"direction": "anomaly_direction"},
    {"evidence_id", "series_key", "channel", "metric_name", "metric_date", "direction"},
)
add(
    "kpi_facts",
    f"""
SELECT '[' || coalesce(string_agg({_KPI_JSON}, ',' ORDER BY channel, metric_name), '') || ']' AS kpi_facts
FROM kpi_rollup
""",
)
add(
    "top_anomaly_facts",
    f"""
SELECT '[' || coalesce(string_agg({_ANOMALY_JSON}, ',' ORDER BY severity_rank), '') || ']' AS anomaly_facts
FROM ranked_anomalies WHERE severity_rank <= 20
""",
)
add(
    "executive_summary_input",
    """
SELECT *, 'v2.0' AS input_version FROM reporting_period, kpi_facts, top_anomaly_facts
""",
)
