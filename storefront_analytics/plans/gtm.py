"""Go-to-market marts: channels, funnel, cohorts, regions, products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storefront_analytics.functions.channels import canonical_channel
from storefront_analytics.functions.columns import (
    count_rows,
    exact_mean,
    months_between_firsts,
    ratio,
    sum_when,
)
from storefront_analytics.operators.ranking import with_dense_ranks, with_ranks
from storefront_analytics.sources.scratch import Stored

# -- customers by a grouping -------------------------------------------------


def _customer_value_metrics() -> list[Column]:
    """Measures that the channel and the region mart share."""
    bought = F.col("completed_order_count") > 0
    revenue = F.col("lifetime_revenue")
    return [
        F.sum("total_order_count").alias("total_orders"),
        F.sum("completed_order_count").alias("completed_orders"),
        F.sum(revenue).alias("total_revenue"),
        exact_mean(revenue).alias("average_revenue_per_acquired_customer"),
        exact_mean(F.when(bought, revenue)).alias("average_revenue_per_purchasing_customer"),
        F.avg("average_completed_order_value").alias("average_order_value"),
        F.avg("customer_return_rate").alias("average_customer_return_rate"),
        F.avg("customer_cancellation_rate").alias("average_customer_cancellation_rate"),
    ]


def channel_metrics(customer_360: DataFrame) -> DataFrame:
    done, engaged = F.col("completed_order_count"), F.col("engagement_status")
    return customer_360.groupBy(canonical_channel(F.col("acquisition_source")).alias("acquisition_channel")).agg(
        count_rows().alias("acquired_customer_count"),
        F.count_if(done > 0).alias("purchasing_customer_count"),
        F.count_if(done >= 2).alias("repeat_customer_count"),
        F.count_if(engaged == "Active").alias("active_customer_count"),
        F.count_if(engaged == "At Risk").alias("at_risk_customer_count"),
        F.count_if(engaged == "Inactive").alias("inactive_customer_count"),
        *_customer_value_metrics(),
    )


def _channel_conversion() -> Column:
    return ratio(F.col("purchasing_customer_count"), F.col("acquired_customer_count"))


def _with_channel_rates(frame: DataFrame, channels: Stored, *more: str) -> DataFrame:
    buying = F.col("purchasing_customer_count")
    total = channels.frame.agg(F.sum("total_revenue").alias("_revenue"))
    return frame.crossJoin(F.broadcast(total)).select(  # one row
        *channels.frame.columns,
        _channel_conversion().alias("customer_conversion_rate"),
        ratio(F.col("repeat_customer_count"), buying).alias("repeat_purchaser_rate"),
        ratio(F.col("active_customer_count"), buying).alias("active_purchaser_rate"),
        ratio(F.col("total_revenue"), F.col("_revenue")).alias("revenue_share"),
        *more,
    )


def channel_rates(channels: Stored) -> DataFrame:
    """Rates and revenue share per channel, from :func:`channel_metrics`."""
    return _with_channel_rates(channels.frame, channels)


def mart_acquisition_channel_performance(channels: Stored) -> DataFrame:
    """Rates, revenue share and ranks per channel, from :func:`channel_metrics`."""
    ranks = {"revenue_rank": F.col("total_revenue"), "conversion_rank": _channel_conversion()}
    return _with_channel_rates(with_ranks(channels.frame, "acquisition_channel", ranks), channels, *ranks)


def region_metrics(customer_360: DataFrame) -> DataFrame:
    done = F.col("completed_order_count")
    return customer_360.groupBy(
        F.coalesce("country", F.lit("Unknown")).alias("country"),
        F.coalesce("state", F.lit("Unknown")).alias("state"),
    ).agg(
        count_rows().alias("acquired_customer_count"),
        F.count_if(done > 0).alias("purchasing_customer_count"),
        F.count_if(done >= 2).alias("repeat_purchaser_count"),
        *_customer_value_metrics(),
    )


# Recommended actions per region, first matching rule first.
REGION_ACTIONS = {
    "returns": "Investigate product fit or fulfillment quality",
    "conversion": "Improve regional acquisition conversion",
    "retention": "Develop regional retention campaigns",
    "top": "Protect and expand high-value market",
    "other": "Monitor market performance",
}
TOP_REGIONS = 10


def mart_geographic_performance(regions: Stored) -> DataFrame:
    """Rates, ranks and an action per region, from :func:`region_metrics`."""
    acquired, buying = F.col("acquired_customer_count"), F.col("purchasing_customer_count")
    repeat = F.col("repeat_purchaser_count")
    benchmark = regions.frame.agg(
        ratio(F.sum(buying), F.sum(acquired)).alias("_conversion"),
        ratio(F.sum(repeat), F.sum(buying)).alias("_repeat"),
        F.avg("average_customer_return_rate").alias("_returns"),
        F.sum("total_revenue").alias("_revenue"),
    )
    ranked = with_dense_ranks(regions.frame, {"global_revenue_rank": F.col("total_revenue")})
    in_country = Window.partitionBy("country").orderBy(F.col("total_revenue").desc_nulls_first())
    conversion, repeat_rate = ratio(buying, acquired), ratio(repeat, buying)
    action = (
        F.when(F.col("average_customer_return_rate") > F.col("_returns"), F.lit(REGION_ACTIONS["returns"]))
        .when(conversion < F.col("_conversion"), F.lit(REGION_ACTIONS["conversion"]))
        .when(repeat_rate < F.col("_repeat"), F.lit(REGION_ACTIONS["retention"]))
        .when(F.col("global_revenue_rank") <= TOP_REGIONS, F.lit(REGION_ACTIONS["top"]))
        .otherwise(F.lit(REGION_ACTIONS["other"]))
    )
    return ranked.crossJoin(F.broadcast(benchmark)).select(  # one row
        *regions.frame.columns,
        conversion.alias("customer_conversion_rate"),
        repeat_rate.alias("repeat_purchaser_rate"),
        ratio(F.col("total_revenue"), F.col("_revenue")).alias("revenue_share"),
        "global_revenue_rank",
        F.dense_rank().over(in_country).cast("bigint").alias("state_revenue_rank_within_country"),
        action.alias("recommended_action"),
    )


# -- sessions ----------------------------------------------------------------


def _session_counts() -> list[Column]:
    """Session measures that the daily funnel and the channel summary share."""
    product, cart, bought = (F.col(f"reached_{s}") == 1 for s in ("product", "cart", "purchase"))
    return [
        F.count_if(product).alias("product_sessions"),
        F.count_if(cart).alias("cart_sessions"),
        F.count_if(bought).alias("purchase_sessions"),
        F.count_if(product & cart).alias("product_to_cart_sessions"),
        F.count_if(cart & bought).alias("cart_to_purchase_sessions"),
        F.count_if(F.col("abandoned_cart_session") == 1).alias("abandoned_cart_sessions"),
        F.count_if(F.col("bounced_session") == 1).alias("bounced_sessions"),
        exact_mean(F.col("session_duration_seconds")).alias("average_session_duration_seconds"),
        exact_mean(F.col("event_count")).alias("average_events_per_session"),
    ]


def session_rates() -> dict[str, Column]:
    sessions, product, cart = F.col("total_sessions"), F.col("product_sessions"), F.col("cart_sessions")
    return {
        "session_conversion_rate": ratio(F.col("purchase_sessions"), sessions),
        "product_to_cart_rate": ratio(F.col("product_to_cart_sessions"), product),
        "cart_to_purchase_rate": ratio(F.col("cart_to_purchase_sessions"), cart),
        "cart_abandonment_rate": ratio(F.col("abandoned_cart_sessions"), cart),
        "bounce_rate": ratio(F.col("bounced_sessions"), sessions),
    }


def mart_conversion_funnel(sessions: DataFrame) -> DataFrame:
    """Sessions per start day, channel and browser."""
    daily = sessions.groupBy(
        F.col("session_started_at").cast("date").alias("session_date"),
        canonical_channel(F.col("traffic_source")).alias("acquisition_channel"),
        F.coalesce("browser", F.lit("Unknown")).alias("browser"),
    ).agg(
        count_rows().alias("total_sessions"),
        F.countDistinct("user_id").alias("unique_users"),
        F.count_if(F.col("reached_home") == 1).alias("home_sessions"),
        F.count_if(F.col("reached_department") == 1).alias("department_sessions"),
        *_session_counts(),
    )
    views = ratio(F.col("product_sessions"), F.col("total_sessions")).alias("product_view_rate")
    return daily.select("*", views, *[rate.alias(name) for name, rate in session_rates().items()])


# Recommended actions per channel, first matching rule first.
CHANNEL_ACTIONS = {
    "scale": "Scale high-performing channel",
    "abandonment": "Investigate cart and checkout abandonment",
    "acquisition": "Improve acquisition targeting and landing experience",
    "retention": "Strengthen retention and repeat-purchase campaigns",
    "other": "Monitor and test incremental improvements",
}


def channel_sessions(acquisition: DataFrame, sessions: DataFrame) -> DataFrame:
    """Customer measures per channel beside the channel's session funnel."""
    funnel = sessions.groupBy(canonical_channel(F.col("traffic_source")).alias("acquisition_channel")).agg(
        count_rows().alias("total_sessions"), *_session_counts()
    )
    customers = acquisition.select(
        "acquisition_channel",
        "acquired_customer_count",
        "purchasing_customer_count",
        "repeat_customer_count",
        "total_orders",
        "total_revenue",
        "average_revenue_per_acquired_customer",
        "average_revenue_per_purchasing_customer",
        "average_order_value",
        "customer_conversion_rate",
        "repeat_purchaser_rate",
        "revenue_share",
    )
    both = customers.join(funnel, "acquisition_channel", "left")
    return both.select("*", *[rate.alias(name) for name, rate in session_rates().items()])


def mart_gtm_channel_summary(combined: Stored) -> DataFrame:
    """Ranks and an action per channel, from :func:`channel_sessions`.

    A channel without sessions has no session rate and ranks first, as missing
    values sort first in descending order here.
    """
    benchmark = combined.frame.agg(
        ratio(F.sum("purchase_sessions"), F.sum("total_sessions")).alias("_session_conversion"),
        ratio(F.sum("abandoned_cart_sessions"), F.sum("cart_sessions")).alias("_abandonment"),
        ratio(F.sum("purchasing_customer_count"), F.sum("acquired_customer_count")).alias("_conversion"),
        ratio(F.sum("repeat_customer_count"), F.sum("purchasing_customer_count")).alias("_repeat"),
    )
    ranked = with_dense_ranks(
        combined.frame,
        {"revenue_rank": F.col("total_revenue"), "session_conversion_rank": F.col("session_conversion_rate")},
    )
    repeat = F.col("repeat_purchaser_rate")
    strong = (F.col("session_conversion_rate") >= F.col("_session_conversion")) & (repeat >= F.col("_repeat"))
    action = (
        F.when(strong, F.lit(CHANNEL_ACTIONS["scale"]))
        .when(F.col("cart_abandonment_rate") > F.col("_abandonment"), F.lit(CHANNEL_ACTIONS["abandonment"]))
        .when(F.col("customer_conversion_rate") < F.col("_conversion"), F.lit(CHANNEL_ACTIONS["acquisition"]))
        .when(repeat < F.col("_repeat"), F.lit(CHANNEL_ACTIONS["retention"]))
        .otherwise(F.lit(CHANNEL_ACTIONS["other"]))
    )
    return ranked.crossJoin(F.broadcast(benchmark)).select(  # one row
        *ranked.columns, action.alias("recommended_action")
    )


# -- cohorts -----------------------------------------------------------------


def mart_customer_cohort_retention(customer_orders: DataFrame) -> DataFrame:
    """Activity of each first-purchase cohort, month by month.

    Orders are first combined to one row per customer and month. The cohort is
    then the customer's earliest month, and the cohort's size is the number of
    customers active in that month, so neither needs a join.
    """
    month = F.trunc(F.col("order_created_at").cast("date"), "month")
    monthly = (
        customer_orders.filter(F.lower("order_status") == "complete")
        .groupBy("user_id", month.alias("activity_month"))
        .agg(count_rows().alias("orders"), F.sum("order_revenue").alias("revenue"))
        .filter(F.col("user_id").isNotNull())
    )
    first = F.min("activity_month").over(Window.partitionBy("user_id"))
    activity = (
        monthly.withColumn("cohort_month", first)
        .groupBy("cohort_month", "activity_month")
        .agg(
            count_rows().alias("active_customers"),
            F.sum("orders").alias("completed_orders"),
            F.sum("revenue").alias("monthly_revenue"),
        )
    )
    cohort = Window.partitionBy("cohort_month")
    so_far = cohort.orderBy("activity_month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own_month = F.col("activity_month") == F.col("cohort_month")
    size = F.max(F.when(own_month, F.col("active_customers"))).over(cohort)
    return activity.select(
        "cohort_month",
        "activity_month",
        months_between_firsts(F.col("cohort_month"), F.col("activity_month")).alias("months_since_first_purchase"),
        size.alias("cohort_size"),
        "active_customers",
        "completed_orders",
        "monthly_revenue",
        ratio(F.col("active_customers"), size).alias("retention_rate"),
        ratio(F.col("monthly_revenue"), F.col("active_customers")).alias("revenue_per_active_customer"),
        F.sum("monthly_revenue").over(so_far).alias("cumulative_cohort_revenue"),
    )


# -- products ----------------------------------------------------------------


def product_orders(staged_items: DataFrame) -> DataFrame:
    """Each product with each order that names it, once.

    Pairs are nearly as many as items, so a task that combines them before they
    move holds nothing but the two keys.
    """
    return staged_items.select("product_id", "order_id").distinct()


def product_metrics(per_order: Stored, staged_items: DataFrame, staged_products: DataFrame) -> DataFrame:
    """Units, demand and money per product, over items of existing orders.

    ``per_order`` is the result of :func:`product_orders`. Orders and customers
    are counted as distinct pairs with the product, each apart from the sums: pairs
    of a product come from all tasks, so what they are counted in is kept narrow.
    """
    kind, price = F.lower("order_item_status"), F.col("sale_price")
    sold = kind == "complete"
    summed = staged_items.groupBy("product_id").agg(
        count_rows().alias("ordered_units"),
        F.count_if(sold).alias("completed_units"),
        F.count_if(kind == "returned").alias("returned_units"),
        F.count_if(kind == "cancelled").alias("cancelled_units"),
        F.coalesce(F.sum(F.when(sold, price)), F.lit(0).cast("decimal(12,2)")).cast("decimal(32,2)").alias("completed_revenue"),
        F.count(F.when(sold, price)).alias("_priced"),
    )
    orders = per_order.frame.groupBy("product_id").agg(F.count("order_id").alias("orders"), F.lit(0).cast("bigint").alias("buyers"))
    buyers = staged_items.select("product_id", "user_id").distinct().groupBy("product_id")
    buyers = buyers.agg(F.lit(0).cast("bigint").alias("orders"), F.count("user_id").alias("buyers"))
    counted = orders.unionByName(buyers).groupBy("product_id")
    counted = counted.agg(F.sum("orders").alias("unique_orders"), F.sum("buyers").alias("unique_customers"))
    per_product = summed.join(counted, "product_id")
    completed = F.col("completed_units")
    return staged_products.join(per_product, "product_id").select(
        "product_id",
        "product_name",
        "product_brand",
        "product_category",
        "product_department",
        "retail_price",
        "product_cost",
        "ordered_units",
        "unique_orders",
        "unique_customers",
        "completed_units",
        "returned_units",
        "cancelled_units",
        "completed_revenue",
        (completed * F.coalesce("product_cost", F.lit(0))).cast("decimal(32,2)").alias("completed_product_cost"),
        ratio(F.col("completed_revenue"), F.col("_priced")).alias("average_selling_price"),
    )


def mart_product_performance(products: Stored) -> DataFrame:
    """Margins, rates and ranks per ordered product, from :func:`product_metrics`."""
    revenue, completed = F.col("completed_revenue"), F.col("completed_units")
    profit = revenue - F.col("completed_product_cost")
    ranked = with_dense_ranks(products.frame, {"revenue_rank": revenue, "gross_profit_rank": profit})
    return ranked.select(
        *products.frame.columns,
        profit.alias("estimated_gross_profit"),
        ratio(profit, revenue).alias("estimated_gross_margin"),
        ratio(F.col("returned_units"), completed + F.col("returned_units")).alias("product_return_rate"),
        ratio(F.col("cancelled_units"), F.col("ordered_units")).alias("product_cancellation_rate"),
        ratio(revenue, completed).alias("revenue_per_completed_unit"),
        "revenue_rank",
        "gross_profit_rank",
    )
