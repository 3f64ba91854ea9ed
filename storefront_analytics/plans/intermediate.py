"""Orders with their item metrics, and web sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront_analytics.functions.columns import count_rows, days_between, exact_mean, seconds_between
from storefront_analytics.sources.scratch import store

# Event types, deepest funnel stage first.
FUNNEL_STAGES = ("purchase", "cart", "product", "department", "home")
EVENT_TYPES = (*FUNNEL_STAGES, "cancel")


def int_customer_orders(staged_orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """One row per order with item count, products, revenue and flags.

    ``order_items`` may still hold orphans: orders are the preserved side, so
    their aggregates find no order here. That saves the semi join, and the
    items are combined before they are shuffled, so an order of any size is
    spread over the map side.
    """
    per_order = order_items.groupBy("order_id").agg(
        count_rows().alias("items"),
        F.countDistinct("product_id").alias("products"),
        F.sum("sale_price").alias("revenue"),
        exact_mean(F.col("sale_price")).alias("average_item_price"),
    )
    zero = F.lit(0)
    return staged_orders.join(per_order, "order_id", "left").select(
        "order_id",
        "user_id",
        "order_status",
        "order_created_at",
        "shipped_at",
        "delivered_at",
        "returned_at",
        F.coalesce("items", zero).alias("item_count"),
        F.coalesce("products", zero).alias("distinct_product_count"),
        F.coalesce("revenue", zero.cast("decimal(12,2)")).alias("order_revenue"),
        "average_item_price",
        days_between(F.col("order_created_at"), F.col("delivered_at")).alias("days_to_delivery"),
        F.col("returned_at").isNotNull().alias("is_returned"),
        F.coalesce(F.col("order_status") == "CANCELLED", F.lit(False)).alias("is_cancelled"),
    )


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _ordered_codes(events: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """The distinct texts of some columns, numbered in order: column, text, code.

    One scan of these columns; the texts are combined before they are moved,
    and sorted by range, so a column of many different texts does not end up in
    one task either.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("text")) for c in columns]))
    texts = events.select(pairs.alias("p")).select("p.*").filter(F.col("text").isNotNull()).distinct()
    ordered = texts.repartitionByRange("column", "text").sortWithinPartitions("column", "text")
    # Stored, since a range partitioning may differ between two evaluations.
    return store(ordered.withColumn("code", F.monotonically_increasing_id()), "text-codes").frame


def int_session_funnel(staged_events: DataFrame) -> DataFrame:
    """One row per web session with the stages it reached.

    One grouping by session over numbers only. Largest texts would need a
    sorting aggregation, so sources and browsers take part as codes in the
    order of the texts, which are looked up again afterwards. Event types that
    are not expected are counted apart: only such events move for that.
    """
    events = staged_events.filter(F.col("session_id").isNotNull())
    kind = F.lower("event_type")
    texts = ("traffic_source", "browser")
    codes = _ordered_codes(events, texts)
    coded = events
    for column in texts:
        own = codes.filter(F.col("column") == column)
        coded = coded.join(own.select(F.col("text").alias(column), F.col("code").alias(f"{column}_code")), column, "left")
    grouped = coded.groupBy("session_id").agg(
        F.max("user_id").alias("user_id"),
        *[F.max(f"{column}_code").alias(f"{column}_code") for column in texts],
        F.min("event_created_at").alias("session_started_at"),
        F.max("event_created_at").alias("session_ended_at"),
        count_rows().alias("event_count"),
        *[F.max(_flag(kind == t)).alias(f"reached_{t}") for t in EVENT_TYPES],
    )
    unexpected = events.filter(F.col("event_type").isNotNull() & ~F.col("event_type").isin(*EVENT_TYPES))
    others = unexpected.select("session_id", "event_type").distinct().groupBy("session_id").agg(count_rows().alias("others"))
    sessions = grouped.join(others, "session_id", "left").withColumn("other_types", F.coalesce("others", F.lit(0)))
    for column in texts:
        own = codes.filter(F.col("column") == column)
        sessions = sessions.join(own.select(F.col("code").alias(f"{column}_code"), F.col("text").alias(column)), f"{column}_code", "left")
    reached = {t: F.col(f"reached_{t}") for t in EVENT_TYPES}
    stage = None
    for t in FUNNEL_STAGES:
        label = F.lit(t.capitalize())
        stage = F.when(reached[t] == 1, label) if stage is None else stage.when(reached[t] == 1, label)
    return sessions.select(
        "session_id",
        "user_id",
        "traffic_source",
        "browser",
        "session_started_at",
        "session_ended_at",
        "event_count",
        (sum(reached.values(), F.lit(0)) + F.col("other_types")).alias("distinct_event_type_count"),
        *[f"reached_{t}" for t in ("home", "department", "product", "cart", "purchase", "cancel")],
        seconds_between(F.col("session_started_at"), F.col("session_ended_at")).alias("session_duration_seconds"),
        stage.otherwise(F.lit("Other")).alias("deepest_funnel_stage"),
        reached["purchase"].alias("converted_session"),
        _flag((reached["cart"] == 1) & (reached["purchase"] == 0)).alias("abandoned_cart_session"),
        _flag(F.col("event_count") == 1).alias("bounced_session"),
    )
