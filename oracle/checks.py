"""The declared checks as SQL knows them, kept apart from the package's own list."""

from __future__ import annotations

# Relation and columns.
UNIQUE = {
    "stg_order_items_rejected": "order_item_id",
    "stg_users": "user_id",
    "stg_orders": "order_id",
    "stg_order_items": "order_item_id",
    "stg_distribution_centers": "distribution_center_id",
    "stg_products": "product_id product_sku",
    "stg_inventory_items": "inventory_item_id",
    "stg_events": "event_id",
    "int_customer_orders": "order_id",
    "dim_customer": "user_id",
    "mart_customer_rfm": "user_id",
    "mart_customer_360": "customer_key",
    "mart_customer_segment_summary": "customer_segment",
    "mart_product_performance": "product_id",
    "executive_summaries": "summary_id",
    "approved_executive_summaries": "summary_id",
}

# Relation and columns.
NOT_NULL = {
    "stg_order_items_rejected": "order_item_id rejection_reason",
    "stg_users": "user_id email",
    "stg_orders": "order_id user_id",
    "stg_order_items": "order_item_id order_id user_id product_id inventory_item_id sale_price",
    "stg_distribution_centers": "distribution_center_id distribution_center_name latitude longitude",
    "stg_products": "product_id product_sku product_name retail_price distribution_center_id product_cost",
    "stg_inventory_items": "inventory_item_id product_id inventory_created_at distribution_center_id inventory_cost",
    "stg_events": "event_id session_id event_sequence_number event_created_at event_type is_authenticated_event",
    "int_customer_orders": "order_id user_id order_created_at order_revenue order_status",
    "dim_customer": (
        "user_id customer_created_at total_order_count completed_order_count cancelled_order_count "
        "returned_order_count lifetime_revenue lifecycle_status"
    ),
    "mart_customer_rfm": (
        "user_id analysis_date frequency recency_days monetary_value recency_score frequency_score "
        "monetary_score customer_segment"
    ),
    "mart_customer_360": (
        "customer_key total_order_count lifetime_revenue customer_return_rate customer_cancellation_rate "
        "customer_segment engagement_status"
    ),
    "mart_customer_segment_summary": (
        "customer_segment customer_count recommended_action total_orders total_revenue customer_share "
        "revenue_share repeat_customer_rate"
    ),
    "mart_customer_cohort_retention": (
        "cohort_month activity_month cohort_size active_customers months_since_first_purchase monthly_revenue "
        "retention_rate"
    ),
    "mart_product_performance": "product_id product_name ordered_units revenue_rank completed_revenue product_cancellation_rate",
    "mart_geographic_performance": (
        "country state acquired_customer_count recommended_action total_revenue customer_conversion_rate "
        "revenue_share"
    ),
    "kpi_anomaly_results": "series ts y forecast lower_bound upper_bound is_anomaly",
    "executive_summary_input": "period_start_date period_end_date scored_kpis total_anomalies kpi_facts anomaly_facts input_version",
    "executive_summaries": (
        "summary_id period_start_date period_end_date model_name prompt_version input_version prompt_text "
        "generated_summary generated_at review_status"
    ),
    "approved_executive_summaries": "summary_id generated_summary reviewed_by reviewed_at",
}

# Relation, subject and the condition of a wrong row.
WRONG = (
    (
        "accepted_values",
        "stg_order_items_rejected",
        "rejection_reason",
        "rejection_reason NOT IN ('ORDER_ID_NOT_FOUND')",
    ),
    (
        "accepted_values",
        "stg_orders",
        "order_status",
        "order_status NOT IN ('CANCELLED', 'COMPLETE', 'PROCESSING', 'RETURNED', 'SHIPPED')",
    ),
    (
        "accepted_values",
        "stg_order_items",
        "order_item_status",
        "order_item_status NOT IN ('CANCELLED', 'COMPLETE', 'PROCESSING', 'RETURNED', 'SHIPPED')",
    ),
    (
        "accepted_values",
        "stg_events",
        "event_type",
        "event_type NOT IN ('purchase', 'cart', 'product', 'department', 'home', 'cancel')",
    ),
    ("accepted_values", "stg_events", "is_authenticated_event", "is_authenticated_event NOT IN (TRUE, FALSE)"),
    (
        "accepted_values",
        "int_customer_orders",
        "order_status",
        "order_status NOT IN ('CANCELLED', 'COMPLETE', 'PROCESSING', 'RETURNED', 'SHIPPED')",
    ),
    (
        "accepted_values",
        "dim_customer",
        "lifecycle_status",
        "lifecycle_status NOT IN ('Never Purchased', 'Active', 'At Risk', 'Inactive')",
    ),
    ("accepted_values", "mart_customer_rfm", "recency_score", "recency_score NOT IN (1, 2, 3, 4, 5)"),
    ("accepted_values", "mart_customer_rfm", "frequency_score", "frequency_score NOT IN (1, 2, 3, 4, 5)"),
    ("accepted_values", "mart_customer_rfm", "monetary_score", "monetary_score NOT IN (1, 2, 3, 4, 5)"),
    (
        "accepted_values",
        "mart_customer_rfm",
        "customer_segment",
        "customer_segment NOT IN ('Champions', 'Loyal Customers', 'New or Promising', 'At Risk', "
        "'Hibernating', 'Needs Attention')",
    ),
    (
        "accepted_values",
        "mart_customer_360",
        "customer_segment",
        "customer_segment NOT IN ('Champions', 'Loyal Customers', 'New or Promising', 'At Risk', "
        "'Hibernating', 'Needs Attention', 'Never Purchased')",
    ),
    (
        "accepted_values",
        "mart_customer_360",
        "engagement_status",
        "engagement_status NOT IN ('Never Purchased', 'Active', 'At Risk', 'Inactive')",
    ),
    ("accepted_values", "kpi_anomaly_results", "is_anomaly", "is_anomaly NOT IN (TRUE, FALSE)"),
    (
        "accepted_values",
        "executive_summaries",
        "review_status",
        "review_status NOT IN ('PENDING_REVIEW', 'APPROVED', 'REJECTED')",
    ),
    (
        "accepted_values",
        "executive_summaries",
        "review_status",
        "review_status NOT IN ('PENDING_REVIEW', 'APPROVED', 'REJECTED', 'NEEDS_REVISION')",
    ),
    ("accepted_range", "stg_users", "age", "age < 0 OR age > 120"),
    ("accepted_range", "stg_orders", "item_count", "item_count < 1"),
    ("accepted_range", "stg_order_items", "sale_price", "sale_price <= 0"),
    ("accepted_range", "stg_distribution_centers", "latitude", "latitude < -90 OR latitude > 90"),
    ("accepted_range", "stg_distribution_centers", "longitude", "longitude < -180 OR longitude > 180"),
    ("accepted_range", "stg_products", "product_cost", "product_cost < 0"),
    ("accepted_range", "stg_products", "retail_price", "retail_price <= 0"),
    ("accepted_range", "stg_inventory_items", "inventory_cost", "inventory_cost < 0"),
    ("accepted_range", "stg_events", "event_sequence_number", "event_sequence_number < 1"),
    ("accepted_range", "int_customer_orders", "order_revenue", "order_revenue < 0"),
    ("accepted_range", "int_customer_orders", "item_count", "item_count < 0"),
    ("accepted_range", "int_customer_orders", "days_to_delivery", "days_to_delivery < 0"),
    ("accepted_range", "dim_customer", "total_order_count", "total_order_count < 0"),
    ("accepted_range", "dim_customer", "completed_order_count", "completed_order_count < 0"),
    ("accepted_range", "dim_customer", "cancelled_order_count", "cancelled_order_count < 0"),
    ("accepted_range", "dim_customer", "returned_order_count", "returned_order_count < 0"),
    ("accepted_range", "dim_customer", "lifetime_revenue", "lifetime_revenue < 0"),
    ("accepted_range", "mart_customer_rfm", "recency_days", "recency_days < 0"),
    ("accepted_range", "mart_customer_rfm", "monetary_value", "monetary_value < 0"),
    ("accepted_range", "mart_customer_rfm", "frequency", "frequency < 1"),
    ("accepted_range", "mart_customer_360", "total_order_count", "total_order_count < 0"),
    ("accepted_range", "mart_customer_360", "lifetime_revenue", "lifetime_revenue < 0"),
    (
        "accepted_range",
        "mart_customer_360",
        "customer_return_rate",
        "customer_return_rate < 0 OR customer_return_rate > 1",
    ),
    (
        "accepted_range",
        "mart_customer_360",
        "customer_cancellation_rate",
        "customer_cancellation_rate < 0 OR customer_cancellation_rate > 1",
    ),
    ("accepted_range", "mart_customer_segment_summary", "total_orders", "total_orders < 0"),
    ("accepted_range", "mart_customer_segment_summary", "total_revenue", "total_revenue < 0"),
    ("accepted_range", "mart_customer_segment_summary", "customer_share", "customer_share < 0 OR customer_share > 1"),
    ("accepted_range", "mart_customer_segment_summary", "revenue_share", "revenue_share < 0 OR revenue_share > 1"),
    (
        "accepted_range",
        "mart_customer_segment_summary",
        "repeat_customer_rate",
        "repeat_customer_rate < 0 OR repeat_customer_rate > 1",
    ),
    ("accepted_range", "mart_customer_segment_summary", "customer_count", "customer_count < 1"),
    (
        "accepted_range",
        "mart_customer_cohort_retention",
        "months_since_first_purchase",
        "months_since_first_purchase < 0",
    ),
    ("accepted_range", "mart_customer_cohort_retention", "monthly_revenue", "monthly_revenue < 0"),
    (
        "accepted_range",
        "mart_customer_cohort_retention",
        "retention_rate",
        "retention_rate < 0 OR retention_rate > 1",
    ),
    ("accepted_range", "mart_customer_cohort_retention", "cohort_size", "cohort_size < 1"),
    ("accepted_range", "mart_customer_cohort_retention", "active_customers", "active_customers < 1"),
    ("accepted_range", "mart_product_performance", "completed_revenue", "completed_revenue < 0"),
    (
        "accepted_range",
        "mart_product_performance",
        "product_cancellation_rate",
        "product_cancellation_rate < 0 OR product_cancellation_rate > 1",
    ),
    ("accepted_range", "mart_product_performance", "ordered_units", "ordered_units < 1"),
    (
        "accepted_range",
        "mart_product_performance",
        "product_return_rate",
        "product_return_rate < 0 OR product_return_rate > 1",
    ),
    ("accepted_range", "mart_product_performance", "revenue_rank", "revenue_rank < 1"),
    ("accepted_range", "mart_geographic_performance", "total_revenue", "total_revenue < 0"),
    (
        "accepted_range",
        "mart_geographic_performance",
        "customer_conversion_rate",
        "customer_conversion_rate < 0 OR customer_conversion_rate > 1",
    ),
    ("accepted_range", "mart_geographic_performance", "revenue_share", "revenue_share < 0 OR revenue_share > 1"),
    ("accepted_range", "mart_geographic_performance", "acquired_customer_count", "acquired_customer_count < 1"),
    (
        "accepted_range",
        "mart_geographic_performance",
        "repeat_purchaser_rate",
        "repeat_purchaser_rate < 0 OR repeat_purchaser_rate > 1",
    ),
    ("expression_is_true", "stg_products", "retail_price >= product_cost", "NOT (retail_price >= product_cost)"),
)

# Relation, column, parent relation and column.
PARENTS = (
    ("stg_orders", "user_id", "user_id", "stg_users", "user_id"),
    ("stg_order_items", "order_id", "order_id", "stg_orders", "order_id"),
    ("stg_order_items", "user_id", "user_id", "stg_users", "user_id"),
    ("stg_order_items", "product_id", "product_id", "stg_products", "product_id"),
    ("stg_order_items", "inventory_item_id", "inventory_item_id", "stg_inventory_items", "inventory_item_id"),
    ("stg_products", "distribution_center_id", "distribution_center_id", "stg_distribution_centers", "distribution_center_id"),
    ("stg_inventory_items", "product_id", "product_id", "stg_products", "product_id"),
    ("stg_inventory_items", "distribution_center_id", "distribution_center_id", "stg_distribution_centers", "distribution_center_id"),
    ("stg_events", "user_id", "user_id", "stg_users", "user_id"),
    ("int_customer_orders", "user_id", "user_id", "stg_users", "user_id"),
    ("dim_customer", "user_id", "user_id", "stg_users", "user_id"),
    ("mart_customer_rfm", "user_id", "user_id", "dim_customer", "user_id"),
)

# Relation and columns that are unique together.
TOGETHER = (
    ("stg_events", "session_id, event_sequence_number", "session_id, event_sequence_number"),
    ("mart_customer_cohort_retention", "cohort_month, activity_month", "cohort_month, activity_month"),
    ("mart_geographic_performance", "country, state", "country, state"),
)
