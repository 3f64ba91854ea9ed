"""One SQL statement per registered query."""

from __future__ import annotations

from oracle import checks
from oracle.fragments import _ANOMALY_JSON, n_if, rounded, with_fragments

ORACLE_SQL: dict[str, str] = {}

# The raw tables and their columns.
RAW_COLUMNS = {
    "distribution_centers": "id,name,latitude,longitude",
    "products": "id,cost,category,name,brand,retail_price,department,sku,distribution_center_id",
    "users": (
        "id,first_name,last_name,email,age,gender,state,street_address,postal_code,city,"
        "country,latitude,longitude,traffic_source,created_at"
    ),
    "orders": "order_id,user_id,status,gender,created_at,shipped_at,delivered_at,returned_at,num_of_item",
    "order_items": (
        "id,order_id,user_id,product_id,inventory_item_id,status,created_at,shipped_at,"
        "delivered_at,returned_at,sale_price"
    ),
    "inventory_items": (
        "id,product_id,created_at,sold_at,cost,product_category,product_name,product_brand,"
        "product_retail_price,product_department,product_sku,product_distribution_center_id"
    ),
    "events": (
        "id,user_id,sequence_number,session_id,created_at,ip_address,city,state,"
        "postal_code,browser,traffic_source,uri,event_type"
    ),
}


def query(name: str, select: str) -> None:
    ORACLE_SQL[name] = with_fragments(select)


def relation(name: str, reals: str = "", whole: str = "", source: str | None = None) -> None:
    """A fragment as it is, its reals rounded and its wider whole numbers as BIGINT."""
    swaps = [f"{rounded(c)} AS {c}" for c in reals.split()]
    swaps += [f"CAST({c} AS BIGINT) AS {c}" for c in whole.split()]
    replace = f" REPLACE ({', '.join(swaps)})" if swaps else ""
    query(name, f"SELECT *{replace} FROM {source or name}")


# -- staging ------------------------------------------------------------------------

relation("stg_users", "latitude longitude", "age")
relation("stg_orders")
relation("stg_order_items", "sale_price")
relation("stg_order_items_rejected", "sale_price")
relation("stg_products", "product_cost retail_price")
relation("stg_inventory_items", "inventory_cost retail_price")
relation("stg_distribution_centers", "latitude longitude")
relation("stg_events")

# -- customers and orders -------------------------------------------------------------

relation("int_customer_orders", "order_revenue average_item_price")
relation(
    "int_session_funnel",
    whole="reached_home reached_department reached_product reached_cart reached_purchase reached_cancel "
    "converted_session abandoned_cart_session bounced_session",
)
relation("dim_customer", "lifetime_revenue average_completed_order_value", "total_items_ordered")
relation("mart_customer_rfm", "monetary_value average_order_value")
relation(
    "mart_customer_360",
    "lifetime_revenue average_completed_order_value monetary_value customer_return_rate customer_cancellation_rate",
    "total_items_ordered",
)
relation(
    "mart_customer_segment_summary",
    "total_revenue average_customer_value average_order_value average_recency_days average_return_rate "
    "average_cancellation_rate customer_share revenue_share repeat_customer_rate",
    "total_orders completed_orders",
)

# -- go-to-market -----------------------------------------------------------------------

_VALUES = (
    "total_revenue average_revenue_per_acquired_customer average_revenue_per_purchasing_customer "
    "average_order_value customer_conversion_rate repeat_purchaser_rate revenue_share "
)
_CUSTOMER_RATES = "average_customer_return_rate average_customer_cancellation_rate "
_SESSION_RATES = (
    "session_conversion_rate product_to_cart_rate cart_to_purchase_rate cart_abandonment_rate bounce_rate "
)
_SESSION_MEANS = "average_session_duration_seconds average_events_per_session "
relation(
    "mart_acquisition_channel_performance",
    _VALUES + _CUSTOMER_RATES + "active_purchaser_rate",
    "total_orders completed_orders",
)
relation("mart_geographic_performance", _VALUES + _CUSTOMER_RATES, "total_orders completed_orders")
relation(
    "mart_conversion_funnel",
    _SESSION_RATES + _SESSION_MEANS + "product_view_rate",
    "home_sessions department_sessions abandoned_cart_sessions bounced_sessions",
)
relation(
    "mart_gtm_channel_summary",
    _VALUES + _SESSION_RATES + _SESSION_MEANS,
    "total_orders abandoned_cart_sessions bounced_sessions",
)
relation(
    "mart_customer_cohort_retention",
    "monthly_revenue retention_rate revenue_per_active_customer cumulative_cohort_revenue",
)
relation(
    "mart_product_performance",
    "retail_price product_cost completed_revenue completed_product_cost average_selling_price "
    "estimated_gross_profit estimated_gross_margin product_return_rate product_cancellation_rate "
    "revenue_per_completed_unit",
)

# -- monitoring and detector --------------------------------------------------------------

relation(
    "mart_daily_business_kpis",
    "completed_revenue average_order_value order_cancellation_rate order_return_rate " + _SESSION_RATES,
    "total_sessions product_sessions cart_sessions purchase_sessions product_to_cart_sessions "
    "cart_to_purchase_sessions abandoned_cart_sessions bounced_sessions",
)
relation("int_kpi_anomaly_input", "metric_value")
relation("kpi_train", "metric_value")
relation("kpi_score", "metric_value")
relation("kpi_detector_params", "slope intercept scale spread " + " ".join(f"effect_{d}" for d in range(1, 8)))
relation("kpi_anomaly_results", "y forecast lower_bound upper_bound percentile distance")
# Left out for want of a year of training rows, or of any spread.
_LEFT_OUT = """
FROM (SELECT DISTINCT series_key FROM kpi_score) LEFT JOIN kpi_detector_params USING (series_key)
WHERE coalesce(train_rows, 0) < 365 OR coalesce(spread, 0) <= 1e-7 * coalesce(scale, 0)
"""
query(
    "kpi_anomaly_exclusions",
    f"""
SELECT series_key, 'Skipped during anomaly scoring due to a series-specific ML error' AS exclusion_reason
{_LEFT_OUT}
""",
)

# -- ingest ---------------------------------------------------------------------------------

_DATED = ("users", "orders", "order_items", "events")


def _before_cutoff(table: str) -> str:
    return " WHERE CAST(created_at AS DATE) < DATE '2024-01-25'" if table in _DATED else ""


query(
    "snapshot_extract",
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS rows, CAST({len(RAW_COLUMNS[t].split(','))} AS BIGINT) AS column_count "
        f"FROM raw_{t}" + _before_cutoff(t)
        for t in RAW_COLUMNS
    ),
)
query(
    "extraction_manifest",
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS rows, '{RAW_COLUMNS[t]}' AS columns, "
        "'star-schema' AS source, DATE '2024-01-25' AS cutoff_date, '2024-06-01T00:00:00' AS extracted_at_utc "
        f"FROM raw_{t}" + _before_cutoff(t)
        for t in RAW_COLUMNS
    ),
)
query(
    "load_reconciliation",
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS expected, count(*) AS actual, true AS matches "
        f"FROM raw_{t}" + _before_cutoff(t)
        for t in RAW_COLUMNS
    ),
)
query(
    "preview_users",
    "SELECT id, first_name, last_name, country, traffic_source, created_at FROM raw_users ORDER BY id LIMIT 10",
)
query(
    "canonical_channel",
    """
SELECT traffic_source, CASE WHEN traffic_source IS NULL THEN 'Unknown'
         WHEN traffic_source IN ('Search', ' adwords ') THEN 'Search'
         WHEN traffic_source IN ('Display', 'YouTube') THEN 'Display'
         WHEN traffic_source = 'referral-site' THEN 'Referral-Site' ELSE traffic_source END AS channel,
       count(*) AS users
FROM raw_users GROUP BY ALL
""",
)

# -- governance -------------------------------------------------------------------------------

relation("anomaly_standardized", "actual_value expected_value lower_bound upper_bound percentile distance")
relation("reporting_period")
relation(
    "kpi_rollup",
    "average_actual_value average_expected_value variance_from_expected_pct latest_actual_value latest_expected_value",
)
relation("kpi_facts")
relation("ranked_anomalies", "actual_value expected_value lower_bound upper_bound distance percentile")
relation("top_anomaly_facts")
relation("executive_summary_input")

_EVIDENCE = """'{"kpi_facts":' || kpi_facts || ',"period_end_date":"' || period_end_date
  || '","period_start_date":"' || period_start_date || '","scored_kpis":' || scored_kpis
  || ',"scored_observations":' || scored_observations || ',"top_anomaly_facts":' || anomaly_facts
  || ',"total_anomalies":' || total_anomalies || '}'"""
_RULES = (
    "Report on the KPIs of an online store, from the JSON package after the word Evidence and nothing else. "
    "The package holds: period_start_date and period_end_date; scored_kpis and scored_observations; "
    "total_anomalies; kpi_facts with averages and latest values, actual and expected, of each channel and "
    "metric; top_anomaly_facts with the strongest unusual days, each under its evidence_id. "
    "Expected values and bounds come from a forecast. "
    "Write four parts. Overview: period, series and observations scored, unusual values found. "
    "Insights: up to five unusual days, one line each, with the value, its bounds and the evidence_id in brackets. "
    "Checks to make: three lines, each naming the day and series whose data should be verified. "
    "Note: what a forecast can not tell."
).replace("'", "''")
_PROMPT = f"""
SELECT period_start_date, period_end_date, input_version, sha256(evidence) AS input_hash,
       '{_RULES} Evidence: ' || evidence AS prompt_text
FROM (SELECT *, {_EVIDENCE} AS evidence FROM executive_summary_input)
"""
query("summary_prompt", _PROMPT)

_INSIGHT = """'- ' || channel || ' ' || metric_name || ' on ' || metric_date || ': ' || actual_value || ' is '
  || if(anomaly_direction = 'ABOVE_EXPECTED_RANGE', 'above', 'below') || ' the expected range ' || lower_bound
  || ' to ' || upper_bound || ', potentially '
  || if((anomaly_direction = 'ABOVE_EXPECTED_RANGE') = (metric_name <> 'CART_ABANDONMENT_RATE'),
        'favorable', 'unfavorable') || ' [' || evidence_id || ']'"""
_ACTION = """severity_rank || '. Verify the data behind ' || channel || ' ' || metric_name || ' on ' || metric_date
  || ' and look into possible drivers [' || evidence_id || ']'"""
_TEXT = f"""
SELECT total_anomalies,
       'Executive Performance Summary\nOverview: ' || scored_observations || ' observations of ' || scored_kpis
       || ' KPI series were scored from ' || coalesce(CAST(period_start_date AS VARCHAR), '?') || ' to '
       || coalesce(CAST(period_end_date AS VARCHAR), '?') || '. '
       || if(total_anomalies = 0, 'No anomalies were detected.',
             total_anomalies || ' unusual values were detected.\nInsights:\n'
             || (SELECT string_agg({_INSIGHT}, '\n' ORDER BY severity_rank) FROM ranked_anomalies
                 WHERE severity_rank <= 5)
             || '\nChecks to make:\n'
             || (SELECT string_agg({_ACTION}, '\n' ORDER BY severity_rank) FROM ranked_anomalies
                 WHERE severity_rank <= 3))
       || '\nNote: expected values are model forecasts; an unusual value is not a confirmed cause.'
         AS generated_summary
FROM executive_summary_input
"""
query("summary_text", _TEXT)
query(
    "summary_append",
    f"""
SELECT * FROM history
UNION ALL BY NAME
SELECT left(d, 8) || '-' || d[9:12] || '-' || d[13:16] || '-' || d[17:20] || '-' || d[21:] AS summary_id,
       period_start_date, period_end_date, 'evidence-template-1' AS model_name, 'v2.0' AS prompt_version,
       input_version, input_hash, prompt_text, generated_summary, TIMESTAMP '2024-06-01' AS generated_at,
       'PENDING_REVIEW' AS review_status
FROM (SELECT *, md5(input_hash || '|evidence-template-1|v2.0') AS d FROM ({_PROMPT}), ({_TEXT}))
WHERE (input_hash, 'evidence-template-1', 'v2.0') NOT IN (
  SELECT (input_hash, model_name, prompt_version) FROM history WHERE model_name IS NOT NULL)
""",
)
_QUEUE = (
    "SELECT summary_id, generated_summary, prompt_text, generated_at, period_start_date, period_end_date, "
    "review_status, reviewed_by, reviewed_at, review_notes FROM history"
)
query("review_queue", _QUEUE)
query("review_queue_by_status", _QUEUE + " WHERE review_status = 'PENDING_REVIEW'")
query(
    "approved_summaries",
    "SELECT * EXCLUDE (input_hash, prompt_text, review_status) FROM history WHERE review_status = 'APPROVED'",
)
_JUDGED = """
SELECT d.*, CASE WHEN NOT valid THEN 'INVALID_DECISION'
                 WHEN turn > 1 OR coalesce(matches, 0) <> 1 THEN 'RECORD_CHANGED_OR_NOT_UNIQUE' END AS reason
FROM (
  SELECT *, row_number() OVER (PARTITION BY valid, summary_id, seen_status, seen_reviewed_at
                               ORDER BY submitted_at, decision_id) AS turn
  FROM (SELECT *, coalesce(decision IN ('APPROVED', 'REJECTED') AND evidence_checked AND trim(reviewer) <> ''
                           AND trim(notes) <> '', false) AS valid FROM decisions)) d
LEFT JOIN (SELECT summary_id, review_status, reviewed_at, count(*) AS matches FROM history GROUP BY ALL) h
  ON h.summary_id = d.summary_id AND h.review_status = d.seen_status
 AND h.reviewed_at IS NOT DISTINCT FROM d.seen_reviewed_at
"""
query("review_conflicts", f"SELECT decision_id, summary_id, decision, reason FROM ({_JUDGED}) WHERE reason IS NOT NULL")
query(
    "apply_reviews",
    f"""
SELECT h.* REPLACE (coalesce(j.decision, h.review_status) AS review_status,
                    coalesce(trim(j.reviewer), h.reviewed_by) AS reviewed_by,
                    if(j.decision IS NULL, h.reviewed_at, TIMESTAMP '2024-06-01') AS reviewed_at,
                    coalesce(trim(j.notes), h.review_notes) AS review_notes)
FROM history h LEFT JOIN (SELECT * FROM ({_JUDGED}) WHERE reason IS NULL) j
  ON h.summary_id = j.summary_id AND h.review_status = j.seen_status
 AND h.reviewed_at IS NOT DISTINCT FROM j.seen_reviewed_at
""",
)
ORACLE_SQL["review_write_back"] = ORACLE_SQL["apply_reviews"]
# An older history, which had no review columns.
query(
    "history_migration",
    "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS reviewed_by, CAST(NULL AS TIMESTAMP) AS reviewed_at, "
    "CAST(NULL AS VARCHAR) AS review_notes) FROM history",
)

# -- supporting data ----------------------------------------------------------------------------

_CHOSEN_KPIS = f"""
SELECT acquisition_channel AS "Channel", metric_name, metric_timestamp, {rounded("metric_value")} AS metric_value
FROM int_kpi_anomaly_input
WHERE acquisition_channel IN ('Email', 'Search') AND metric_name = 'TOTAL_ORDERS'
"""
query("explore_kpis", _CHOSEN_KPIS)
query("explore_kpi_rows", f"SELECT count(*) AS row_count FROM ({_CHOSEN_KPIS})")
query(
    "explore_kpi_choices",
    """
SELECT DISTINCT 'channel' AS field, acquisition_channel AS choice FROM int_kpi_anomaly_input
UNION ALL
SELECT DISTINCT 'metric_name', metric_name FROM int_kpi_anomaly_input
""",
)
query(
    "explore_anomalies",
    f"""
SELECT channel, metric_name AS "KPI_Name", metric_timestamp, {rounded("actual_value")} AS actual_value,
       {rounded("distance")} AS distance
FROM anomaly_standardized WHERE is_anomaly AND metric_name = 'TOTAL_ORDERS'
""",
)

# -- validation -----------------------------------------------------------------------------------

_SCORED = (
    f"count(*) AS scored_rows, {n_if('is_anomaly')} AS anomalies_detected, "
    "min(ts) AS first_scoring_timestamp, max(ts) AS last_scoring_timestamp"
)
query("val_scoring_summary", f"SELECT {_SCORED}, count(DISTINCT series) AS scored_kpis FROM kpi_anomaly_results")
query(
    "val_by_series",
    f"SELECT series AS series_key, {_SCORED}, {rounded('avg(y)')} AS average_actual_value, "
    f"{rounded('avg(forecast)', 'average_forecast_value')} AS average_forecast_value FROM kpi_anomaly_results GROUP BY series",
)
query(
    "val_anomalies",
    "SELECT series_key, metric_timestamp, "
    + ", ".join(
        f"{rounded(c)} AS {c}"
        for c in ("actual_value", "expected_value", "lower_bound", "upper_bound", "percentile", "distance")
    )
    + " FROM anomaly_standardized WHERE is_anomaly",
)
query(
    "val_boundary",
    """
SELECT *, first_scoring_timestamp > last_training_timestamp AS valid_timestamp_boundary
FROM (SELECT max(metric_timestamp) AS last_training_timestamp FROM kpi_train),
     (SELECT min(ts) AS first_scoring_timestamp FROM kpi_anomaly_results)
""",
)
query(
    "val_boundary_by_series",
    """
SELECT *, first_scoring_timestamp > last_training_timestamp AS valid_timestamp_boundary
FROM (SELECT series_key, max(metric_timestamp) AS last_training_timestamp FROM kpi_train GROUP BY 1)
JOIN (SELECT series AS series_key, min(ts) AS first_scoring_timestamp FROM kpi_anomaly_results GROUP BY 1)
  USING (series_key)
""",
)
query(
    "val_excluded",
    f"""
SELECT series_key AS excluded_series_key, 'Series was skipped during ML scoring' AS exclusion_reason
{_LEFT_OUT}
""",
)
query(
    "val_duplicates",
    """
SELECT series AS series_key, ts AS metric_timestamp, count(*) AS duplicate_count
FROM (FROM kpi_anomaly_results UNION ALL FROM kpi_anomaly_results WHERE is_anomaly)
GROUP BY ALL HAVING duplicate_count > 1
""",
)
query(
    "val_invalid_results",
    """
SELECT count(*) - count(series) AS null_series_keys, count(*) - count(ts) AS null_timestamps,
       count(*) - count(y) AS null_actual_values, count(*) - count(forecast) AS null_forecasts,
       count(*) - count(lower_bound) AS null_lower_bounds, count(*) - count(upper_bound) AS null_upper_bounds,
       count(*) FILTER (WHERE lower_bound > upper_bound) AS invalid_bound_ranges
FROM kpi_anomaly_results
""",
)
query(
    "val_latest_summary",
    """
SELECT summary_id, period_start_date, period_end_date, model_name, prompt_version, input_version,
       generated_summary, generated_at, review_status
FROM history WHERE generated_at = (SELECT max(generated_at) FROM history)
""",
)
query(
    "val_summary_missing",
    """
SELECT count(*) AS total_summaries, count(*) FILTER (WHERE trim(generated_summary) = '') AS empty_summaries,
       count(*) - count(summary_id) AS missing_summary_ids, count(*) - count(generated_summary) AS null_summaries,
       count(*) - count(prompt_text) AS missing_prompts, count(*) - count(model_name) AS missing_model_names,
       count(*) - count(prompt_version) AS missing_prompt_versions,
       count(*) - count(input_version) AS missing_input_versions,
       count(*) - count(generated_at) AS missing_generation_timestamps,
       count(*) - count(review_status) AS missing_review_statuses
FROM history
""",
)
query(
    "val_summary_periods",
    """
SELECT count(*) - count(period_start_date) AS missing_start_dates,
       count(*) - count(period_end_date) AS missing_end_dates,
       count(*) FILTER (WHERE period_start_date > period_end_date) AS invalid_reporting_periods
FROM history
""",
)
query(
    "val_summary_duplicates",
    "SELECT summary_id, count(*) AS duplicate_count FROM history GROUP BY 1 HAVING count(*) > 1",
)
query("val_status_counts", "SELECT review_status, count(*) AS summary_count FROM history GROUP BY 1")
query(
    "val_bad_status",
    "SELECT * FROM history WHERE coalesce(review_status, '') NOT IN ('PENDING_REVIEW', 'APPROVED', 'REJECTED')",
)
query(
    "val_metadata_match",
    """
SELECT h.summary_id, h.period_start_date, h.period_end_date, h.input_version,
       e.period_start_date AS source_start_date, e.period_end_date AS source_end_date,
       'v2.0' AS source_input_version, h.period_start_date = e.period_start_date AS valid_start_date,
       h.period_end_date = e.period_end_date AS valid_end_date, h.input_version = 'v2.0' AS valid_input_version
FROM history h, reporting_period e
""",
)
query(
    "val_summary_length",
    "SELECT summary_id, length(generated_summary) AS summary_character_count, generated_at FROM history",
)

# -- quality checks ---------------------------------------------------------------------------------

_SOURCES = {
    "executive_summaries": "(SELECT * FROM history UNION ALL BY NAME SELECT * FROM new_summary)",
    "approved_executive_summaries": "(SELECT * FROM history WHERE review_status = 'APPROVED')",
}


def _source(name: str) -> str:
    return _SOURCES.get(name, name)


def _check(kind: str, relation: str, subject: str, violations: str) -> str:
    return (
        f"SELECT '{relation}' AS relation, '{subject}' AS subject, '{kind}' AS \"check\", violations "
        f"FROM ({violations})"
    )


def _repeated(relation: str, columns: str, filled: str = "") -> str:
    return (
        f"SELECT count(*) AS violations FROM (SELECT {columns} FROM {_source(relation)} {filled} "
        f"GROUP BY {columns} HAVING count(*) > 1)"
    )


def _checks(kind: str) -> str:
    if kind == "not_null":
        found = [
            (r, c, f"SELECT count(*) - count({c}) AS violations FROM {_source(r)}")
            for r, columns in checks.NOT_NULL.items()
            for c in columns.split()
        ]
    elif kind == "unique":
        found = [
            (r, c, _repeated(r, c, f"WHERE {c} IS NOT NULL"))
            for r, columns in checks.UNIQUE.items()
            for c in columns.split()
        ]
    elif kind == "unique_combination":
        found = [(r, subject, _repeated(r, columns)) for r, subject, columns in checks.TOGETHER]
    elif kind == "relationships":
        found = [
            (
                r,
                subject,
                f"SELECT count(*) AS violations FROM {_source(r)} child WHERE {c} IS NOT NULL AND NOT EXISTS "
                f"(FROM {_source(parent)} p WHERE p.{column} = child.{c})",
            )
            for r, subject, c, parent, column in checks.PARENTS
        ]
    else:
        found = [
            (r, subject, f"SELECT count(*) AS violations FROM {_source(r)} WHERE {wrong}")
            for k, r, subject, wrong in checks.WRONG
            if k == kind
        ]
    return " UNION ALL ".join(_check(kind, *f) for f in found)


_NEW_SUMMARY = ORACLE_SQL["summary_append"].rsplit("UNION ALL BY NAME", 1)[1]
for _key, _kind in {
    "check_unique": "unique",
    "check_not_null": "not_null",
    "check_accepted_values": "accepted_values",
    "check_relationships": "relationships",
    "check_accepted_range": "accepted_range",
    "check_expression": "expression_is_true",
    "check_unique_combination": "unique_combination",
}.items():
    _select = _checks(_kind)
    if "new_summary" in _select:
        _select = with_fragments(
            "SELECT * FROM (" + _select.replace("new_summary", f"({_NEW_SUMMARY})") + ")"
        )
        ORACLE_SQL[_key] = _select
    else:
        query(_key, _select)
