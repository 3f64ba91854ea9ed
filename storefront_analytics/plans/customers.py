"""Customer dimension, RFM scores, customer 360 and segment summary."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront_analytics.functions.columns import (
    count_rows,
    days_between,
    exact_mean,
    rate_or_zero,
    ratio,
    sum_when,
)
from storefront_analytics.operators.ranking import with_tiles
from storefront_analytics.sources.scratch import Stored

# Days since the last order up to which a customer counts as so.
ACTIVE_DAYS = 30
AT_RISK_DAYS = 90

# Labels.
NEVER_PURCHASED = "Never Purchased"
SEGMENTS = ("Champions", "Loyal Customers", "New or Promising", "At Risk", "Hibernating", "Needs Attention")
ACTION_BY_SEGMENT = {
    "Champions": "Protect and reward",
    "Loyal Customers": "Cross-sell and increase order value",
    "New or Promising": "Drive the second purchase",
    "At Risk": "Launch a targeted retention campaign",
    "Hibernating": "Test a reactivation offer",
    "Needs Attention": "Increase personalized engagement",
    "Never Purchased": "Improve first-purchase conversion",
}
RFM_TILES = 5


def _status(name: str) -> Column:
    return F.lower("order_status") == name


def customer_order_metrics(customer_orders: DataFrame) -> DataFrame:
    """Everything later steps need per customer, in one aggregation.

    Order ids are unique in the input, so plain counts stand for distinct ones
    and combine on the map side, however many orders one customer has.
    """
    complete = _status("complete")
    return customer_orders.groupBy("user_id").agg(
        count_rows().alias("total_order_count"),
        F.count_if(complete).alias("completed_order_count"),
        F.count_if(_status("cancelled")).alias("cancelled_order_count"),
        F.count_if(_status("returned")).alias("returned_order_count"),
        F.sum("item_count").alias("total_items_ordered"),
        sum_when(complete, F.col("order_revenue")).alias("lifetime_revenue"),
        exact_mean(F.when(complete, F.col("order_revenue"))).alias("average_completed_order_value"),
        F.min("order_created_at").alias("first_order_at"),
        F.max("order_created_at").alias("last_order_at"),
        F.min(F.when(complete, F.col("order_created_at"))).alias("first_completed_order_at"),
        F.max(F.when(complete, F.col("order_created_at"))).alias("last_completed_order_at"),
    )


def _recency_label(days: Column, never: Column) -> Column:
    return (
        F.when(never, F.lit(NEVER_PURCHASED))
        .when(days <= ACTIVE_DAYS, F.lit("Active"))
        .when(days <= AT_RISK_DAYS, F.lit("At Risk"))
        .otherwise(F.lit("Inactive"))
    )


def dim_customer(staged_users: DataFrame, metrics: DataFrame, as_of: date) -> DataFrame:
    """Every user with order metrics; ages are counted up to ``as_of``."""
    today = F.lit(as_of)
    users = staged_users.select(
        "user_id",
        "first_name",
        "last_name",
        "email",
        "age",
        "gender",
        "city",
        "state",
        "country",
        "acquisition_source",
        F.col("account_created_at").alias("customer_created_at"),
    )
    zero = F.lit(0)
    since_last = days_between(F.col("last_order_at"), today)
    return users.join(metrics, "user_id", "left").select(
        *users.columns,
        *[
            F.coalesce(c, zero).alias(c)
            for c in (
                "total_order_count",
                "completed_order_count",
                "cancelled_order_count",
                "returned_order_count",
                "total_items_ordered",
            )
        ],
        F.coalesce("lifetime_revenue", zero.cast("decimal(12,2)")).alias("lifetime_revenue"),
        "average_completed_order_value",
        "first_order_at",
        "last_order_at",
        since_last.alias("days_since_last_order"),
        days_between(F.col("customer_created_at"), today).alias("customer_tenure_days"),
        (F.coalesce("total_order_count", zero) >= 2).alias("is_repeat_customer"),
        _recency_label(since_last, F.col("first_order_at").isNull()).alias("lifecycle_status"),
    )


def rfm_segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    """Segment of three scores from 1 to 5; the first matching rule counts."""
    return (
        F.when((recency >= 4) & (frequency >= 4) & (monetary >= 4), F.lit("Champions"))
        .when((recency >= 3) & (frequency >= 3), F.lit("Loyal Customers"))
        .when((recency >= 4) & (frequency <= 2), F.lit("New or Promising"))
        .when((recency <= 2) & (frequency >= 3), F.lit("At Risk"))
        .when((recency <= 2) & (frequency <= 2), F.lit("Hibernating"))
        .otherwise(F.lit("Needs Attention"))
    )


def mart_customer_rfm(metrics: Stored) -> DataFrame:
    """RFM scores of customers with a completed order.

    ``metrics`` is the stored result of :func:`customer_order_metrics`. The
    analysis date is the day after the last completed order of the data set.
    """
    buyers = metrics.frame.filter(F.col("completed_order_count") > 0)
    day_after = buyers.agg(F.date_add(F.max("last_completed_order_at").cast("date"), 1).alias("analysis_date"))
    scored = with_tiles(
        buyers,
        "user_id",
        {
            "recency_score": F.unix_date(F.col("last_completed_order_at").cast("date")),  # the longest absence first
            "frequency_score": F.col("completed_order_count"),
            "monetary_score": F.col("lifetime_revenue"),
        },
        RFM_TILES,
    )
    scores = [F.col(c) for c in ("recency_score", "frequency_score", "monetary_score")]
    return scored.crossJoin(F.broadcast(day_after)).select(  # one row
        "user_id",
        "analysis_date",
        days_between(F.col("last_completed_order_at"), F.col("analysis_date")).alias("recency_days"),
        F.col("completed_order_count").alias("frequency"),
        F.col("lifetime_revenue").alias("monetary_value"),
        F.col("average_completed_order_value").alias("average_order_value"),
        "first_completed_order_at",
        "last_completed_order_at",
        *scores,
        F.concat(*[s.cast("string") for s in scores]).alias("rfm_score"),
        rfm_segment(*scores).alias("customer_segment"),
    )


def age_group(age: Column) -> Column:
    # Labels, the inner ones with an en dash.
    return (
        F.when(age < 20, F.lit("Under 20"))
        .when(age < 30, F.lit("20–29"))
        .when(age < 40, F.lit("30–39"))
        .when(age < 50, F.lit("40–49"))
        .when(age < 60, F.lit("50–59"))
        .when(age >= 60, F.lit("60+"))
        .otherwise(F.lit("Unknown"))
    )


def mart_customer_360(customers: DataFrame, rfm: DataFrame) -> DataFrame:
    """One row per customer under a digest of the id, without name or address."""
    scores = rfm.select(
        "user_id",
        F.lit(True).alias("_has_rfm"),
        "analysis_date",
        "recency_days",
        "frequency",
        "monetary_value",
        "recency_score",
        "frequency_score",
        "monetary_score",
        "rfm_score",
        "customer_segment",
    )
    completed, returned = F.col("completed_order_count"), F.col("returned_order_count")
    return customers.join(scores, "user_id", "left").select(
        F.sha2(F.col("user_id").cast("string"), 256).alias("customer_key"),
        "age",
        age_group(F.col("age")).alias("age_group"),
        "gender",
        "city",
        "state",
        "country",
        "acquisition_source",
        "customer_created_at",
        "total_order_count",
        "completed_order_count",
        "cancelled_order_count",
        "returned_order_count",
        "total_items_ordered",
        "lifetime_revenue",
        "average_completed_order_value",
        "first_order_at",
        "last_order_at",
        "is_repeat_customer",
        "analysis_date",
        "recency_days",
        "frequency",
        "monetary_value",
        "recency_score",
        "frequency_score",
        "monetary_score",
        "rfm_score",
        F.coalesce("customer_segment", F.lit(NEVER_PURCHASED)).alias("customer_segment"),
        _recency_label(F.col("recency_days"), F.col("_has_rfm").isNull()).alias("engagement_status"),
        rate_or_zero(returned, completed + returned).alias("customer_return_rate"),
        rate_or_zero(F.col("cancelled_order_count"), F.col("total_order_count")).alias("customer_cancellation_rate"),
    )


def segment_metrics(customer_360: DataFrame) -> DataFrame:
    engaged = F.col("engagement_status")
    return customer_360.groupBy("customer_segment").agg(
        count_rows().alias("customer_count"),
        F.count_if("is_repeat_customer").alias("repeat_customer_count"),
        F.count_if(engaged == "Active").alias("active_customer_count"),
        F.count_if(engaged == "At Risk").alias("at_risk_customer_count"),
        F.count_if(engaged == "Inactive").alias("inactive_customer_count"),
        F.count_if(engaged == NEVER_PURCHASED).alias("never_purchased_customer_count"),
        F.sum("total_order_count").alias("total_orders"),
        F.sum("completed_order_count").alias("completed_orders"),
        F.sum("lifetime_revenue").alias("total_revenue"),
        exact_mean(F.col("lifetime_revenue")).alias("average_customer_value"),
        F.avg("average_completed_order_value").alias("average_order_value"),
        exact_mean(F.col("recency_days")).alias("average_recency_days"),
        F.avg("customer_return_rate").alias("average_return_rate"),
        F.avg("customer_cancellation_rate").alias("average_cancellation_rate"),
    )


def mart_customer_segment_summary(segments: Stored) -> DataFrame:
    """Shares and the recommended action per segment, from :func:`segment_metrics`."""
    totals = segments.frame.agg(
        F.sum("customer_count").alias("_customers"), F.sum("total_revenue").alias("_revenue")
    )
    segment = F.col("customer_segment")
    action = F.lit(None).cast("string")
    for name, text in ACTION_BY_SEGMENT.items():
        action = F.when(segment == name, F.lit(text)).otherwise(action)
    return segments.frame.crossJoin(F.broadcast(totals)).select(  # one row
        *segments.frame.columns,
        ratio(F.col("customer_count"), F.col("_customers")).alias("customer_share"),
        ratio(F.col("total_revenue"), F.col("_revenue")).alias("revenue_share"),
        ratio(F.col("repeat_customer_count"), F.col("customer_count")).alias("repeat_customer_rate"),
        action.alias("recommended_action"),
    )
