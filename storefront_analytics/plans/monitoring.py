"""Daily KPIs per channel and their long form for the detector."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storefront_analytics.functions.channels import UNKNOWN_CHANNEL, canonical_channel
from storefront_analytics.functions.columns import count_rows, ratio, sum_when
from storefront_analytics.plans.gtm import session_rates
from storefront_analytics.sources.scratch import Stored

ORDER_MEASURES = ("total_orders", "completed_orders", "cancelled_orders", "returned_orders")
SESSION_MEASURES = (
    "total_sessions",
    "product_sessions",
    "cart_sessions",
    "purchase_sessions",
    "product_to_cart_sessions",
    "cart_to_purchase_sessions",
    "abandoned_cart_sessions",
    "bounced_sessions",
)

# Monitored KPIs and the column each one reads.
KPI_COLUMNS = {
    "COMPLETED_REVENUE": "completed_revenue",
    "TOTAL_ORDERS": "total_orders",
    "SESSION_CONVERSION_RATE": "session_conversion_rate",
    "CART_ABANDONMENT_RATE": "cart_abandonment_rate",
    "AVERAGE_ORDER_VALUE": "average_order_value",
}
SCORE_DAYS = 30


def mart_daily_business_kpis(customer_orders: DataFrame, staged_users: DataFrame, funnel: DataFrame) -> DataFrame:
    """Order and session measures per day and channel; either side may be absent."""
    channels = staged_users.select(
        "user_id", canonical_channel(F.col("acquisition_source")).alias("acquisition_channel")
    )
    state = F.lower("order_status")
    orders = (
        customer_orders.join(channels, "user_id", "left")
        .groupBy(
            F.col("order_created_at").cast("date").alias("metric_date"),
            F.coalesce("acquisition_channel", F.lit(UNKNOWN_CHANNEL)).alias("acquisition_channel"),
        )
        .agg(
            # Order ids are unique here, so rows are orders.
            count_rows().alias("total_orders"),
            F.count_if(state == "complete").alias("completed_orders"),
            F.count_if(state == "cancelled").alias("cancelled_orders"),
            F.count_if(state == "returned").alias("returned_orders"),
            sum_when(state == "complete", F.col("order_revenue")).alias("completed_revenue"),
        )
    )
    sessions = funnel.groupBy(F.col("session_date").alias("metric_date"), "acquisition_channel").agg(
        *[F.sum(c).alias(c) for c in SESSION_MEASURES]
    )
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in (*ORDER_MEASURES, *SESSION_MEASURES)]
    both = orders.join(sessions, ["metric_date", "acquisition_channel"], "full").select(
        "metric_date",
        "acquisition_channel",
        *counts[: len(ORDER_MEASURES)],
        F.coalesce("completed_revenue", F.lit(0).cast("decimal(12,2)")).alias("completed_revenue"),
        *counts[len(ORDER_MEASURES) :],
    )
    total, done, returned = (F.col(c) for c in ("total_orders", "completed_orders", "returned_orders"))
    return both.select(
        "*",
        *[rate.alias(name) for name, rate in session_rates().items()],
        ratio(F.col("completed_revenue"), done).alias("average_order_value"),
        ratio(F.col("cancelled_orders"), total).alias("order_cancellation_rate"),
        ratio(returned, done + returned).alias("order_return_rate"),
    )


def int_kpi_anomaly_input(daily: Stored, score_days: int = SCORE_DAYS) -> DataFrame:
    """KPIs in long form, split into TRAIN and the last ``score_days`` plus one.

    The unpivot reads the stored daily rows once. Revenue and order counts are
    never missing; a ratio without a base gives no row.
    """
    last = daily.frame.agg(F.date_sub(F.max("metric_date"), score_days).alias("_boundary"))
    pairs = [
        F.struct(F.lit(kpi).alias("metric_name"), F.col(c).cast("double").alias("metric_value"))
        for kpi, c in KPI_COLUMNS.items()
    ]
    long = daily.frame.select("metric_date", "acquisition_channel", F.inline(F.array(*pairs)))
    return (
        long.filter(F.col("metric_value").isNotNull())
        .crossJoin(F.broadcast(last))  # one row
        .select(
            F.concat("acquisition_channel", F.lit("|"), "metric_name").alias("series_key"),
            "acquisition_channel",
            "metric_name",
            F.col("metric_date").cast("timestamp_ntz").alias("metric_timestamp"),
            "metric_value",
            F.when(F.col("metric_date") < F.col("_boundary"), F.lit("TRAIN"))
            .otherwise(F.lit("SCORE"))
            .alias("dataset_split"),
        )
    )
