"""What every relation promises, by the kinds of ``operators.quality``."""

from __future__ import annotations

from storefront_analytics.operators.quality import Check, Range, Rules
from storefront_analytics.plans.customers import NEVER_PURCHASED, SEGMENTS
from storefront_analytics.plans.intermediate import EVENT_TYPES
from storefront_analytics.plans.staging import ORPHAN_REASON

# Accepted labels.
ORDER_STATUSES = ("CANCELLED", "COMPLETE", "PROCESSING", "RETURNED", "SHIPPED")
LIFECYCLE = ("Never Purchased", "Active", "At Risk", "Inactive")
SCORES = (1, 2, 3, 4, 5)
REVIEW_STATUSES = ("PENDING_REVIEW", "APPROVED", "REJECTED")
REVIEW_STATUSES_WITH_REVISION = (*REVIEW_STATUSES, "NEEDS_REVISION")

POSITIVE = Range(low=0, inclusive=False)
AT_LEAST_ONE = Range(low=1)
AT_LEAST_ZERO = Range(low=0)
SHARE = Range(0, 1)

# The promises themselves.
RULES = {
    "stg_order_items_rejected": Rules(
        keys=["order_item_id"],
        labels={"rejection_reason": [ORPHAN_REASON]},
    ),
    "stg_users": Rules(keys=["user_id"], not_null=["email"], ranges={"age": Range(0, 120)}),
    "stg_orders": Rules(
        keys=["order_id"],
        not_null=["user_id"],
        accepted={"order_status": ORDER_STATUSES},
        ranges={"item_count": AT_LEAST_ONE},
        parents={"user_id": ("stg_users", "user_id")},
    ),
    "stg_order_items": Rules(
        keys=["order_item_id"],
        not_null=["order_id", "user_id", "product_id", "inventory_item_id", "sale_price"],
        accepted={"order_item_status": ORDER_STATUSES},
        ranges={"sale_price": POSITIVE},
        parents={
            "order_id": ("stg_orders", "order_id"),
            "user_id": ("stg_users", "user_id"),
            "product_id": ("stg_products", "product_id"),
            "inventory_item_id": ("stg_inventory_items", "inventory_item_id"),
        },
    ),
    "stg_distribution_centers": Rules(
        keys=["distribution_center_id"],
        not_null=["distribution_center_name", "latitude", "longitude"],
        ranges={"latitude": Range(-90, 90), "longitude": Range(-180, 180)},
    ),
    "stg_products": Rules(
        keys=["product_id", "product_sku"],
        not_null=["product_name", "retail_price", "distribution_center_id"],
        amounts=["product_cost"],
        ranges={"retail_price": POSITIVE},
        parents={"distribution_center_id": ("stg_distribution_centers", "distribution_center_id")},
        expressions=["retail_price >= product_cost"],
    ),
    "stg_inventory_items": Rules(
        keys=["inventory_item_id"],
        not_null=["product_id", "inventory_created_at", "distribution_center_id"],
        amounts=["inventory_cost"],
        parents={
            "product_id": ("stg_products", "product_id"),
            "distribution_center_id": ("stg_distribution_centers", "distribution_center_id"),
        },
    ),
    "stg_events": Rules(
        keys=["event_id"],
        not_null=["session_id", "event_sequence_number", "event_created_at"],
        labels={"event_type": EVENT_TYPES, "is_authenticated_event": (True, False)},
        ranges={"event_sequence_number": AT_LEAST_ONE},
        parents={"user_id": ("stg_users", "user_id")},
        unique_together=[("session_id", "event_sequence_number")],
    ),
    "int_customer_orders": Rules(
        keys=["order_id"],
        not_null=["user_id", "order_created_at"],
        amounts=["order_revenue"],
        labels={"order_status": ORDER_STATUSES},
        ranges={"item_count": AT_LEAST_ZERO, "days_to_delivery": AT_LEAST_ZERO},
        parents={"user_id": ("stg_users", "user_id")},
    ),
    "dim_customer": Rules(
        keys=["user_id"],
        not_null=["customer_created_at"],
        amounts=[
            "total_order_count",
            "completed_order_count",
            "cancelled_order_count",
            "returned_order_count",
            "lifetime_revenue",
        ],
        labels={"lifecycle_status": LIFECYCLE},
        parents={"user_id": ("stg_users", "user_id")},
    ),
    "mart_customer_rfm": Rules(
        keys=["user_id"],
        not_null=["analysis_date", "frequency"],
        amounts=["recency_days", "monetary_value"],
        labels={
            "recency_score": SCORES,
            "frequency_score": SCORES,
            "monetary_score": SCORES,
            "customer_segment": SEGMENTS,
        },
        ranges={"frequency": AT_LEAST_ONE},
        parents={"user_id": ("dim_customer", "user_id")},
    ),
    "mart_customer_360": Rules(
        keys=["customer_key"],
        amounts=["total_order_count", "lifetime_revenue"],
        shares=["customer_return_rate", "customer_cancellation_rate"],
        labels={"customer_segment": (*SEGMENTS, NEVER_PURCHASED), "engagement_status": LIFECYCLE},
    ),
    "mart_customer_segment_summary": Rules(
        keys=["customer_segment"],
        not_null=["customer_count", "recommended_action"],
        amounts=["total_orders", "total_revenue"],
        shares=["customer_share", "revenue_share", "repeat_customer_rate"],
        ranges={"customer_count": AT_LEAST_ONE},
    ),
    "mart_customer_cohort_retention": Rules(
        not_null=["cohort_month", "activity_month", "cohort_size", "active_customers"],
        amounts=["months_since_first_purchase", "monthly_revenue"],
        shares=["retention_rate"],
        ranges={"cohort_size": AT_LEAST_ONE, "active_customers": AT_LEAST_ONE},
        unique_together=[("cohort_month", "activity_month")],
    ),
    "mart_product_performance": Rules(
        keys=["product_id"],
        not_null=["product_name", "ordered_units", "revenue_rank"],
        amounts=["completed_revenue"],
        shares=["product_cancellation_rate"],
        ranges={"ordered_units": AT_LEAST_ONE, "product_return_rate": SHARE, "revenue_rank": AT_LEAST_ONE},
    ),
    "mart_geographic_performance": Rules(
        not_null=["country", "state", "acquired_customer_count", "recommended_action"],
        amounts=["total_revenue"],
        shares=["customer_conversion_rate", "revenue_share"],
        ranges={"acquired_customer_count": AT_LEAST_ONE, "repeat_purchaser_rate": SHARE},
        unique_together=[("country", "state")],
    ),
    "kpi_anomaly_results": Rules(
        not_null=["series", "ts", "y", "forecast", "lower_bound", "upper_bound"],
        labels={"is_anomaly": (True, False)},
    ),
    "executive_summary_input": Rules(
        not_null=[
            "period_start_date",
            "period_end_date",
            "scored_kpis",
            "total_anomalies",
            "kpi_facts",
            "anomaly_facts",
            "input_version",
        ],
    ),
    "executive_summaries": Rules(
        keys=["summary_id"],
        not_null=[
            "period_start_date",
            "period_end_date",
            "model_name",
            "prompt_version",
            "input_version",
            "prompt_text",
            "generated_summary",
            "generated_at",
        ],
        labels={"review_status": REVIEW_STATUSES},
    ),
    "approved_executive_summaries": Rules(
        keys=["summary_id"],
        not_null=["generated_summary", "reviewed_by", "reviewed_at"],
    ),
}


def all_checks() -> list[Check]:
    """Every declared check. The history has a second, wider list of statuses."""
    wider = Check(
        "executive_summaries", "accepted_values", ("review_status",), values=REVIEW_STATUSES_WITH_REVISION
    )
    return [c for relation, rules in RULES.items() for c in rules.checks(relation)] + [wider]


def checks_of(kind: str) -> list[Check]:
    return [c for c in all_checks() if c.kind == kind]
