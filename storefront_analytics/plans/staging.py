"""Cleaned, typed and renamed raw tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront_analytics.functions.columns import MONEY

# Fixed values.
MISSING_PRODUCT_NAME = "Unknown Product"
ORPHAN_REASON = "ORDER_ID_NOT_FOUND"


def _text(name: str, alias: str | None = None) -> Column:
    return F.trim(F.col(name)).alias(alias or name)


def _upper(name: str, alias: str | None = None) -> Column:
    return F.upper(F.trim(F.col(name))).alias(alias or name)


def _money(name: str, alias: str | None = None) -> Column:
    return F.col(name).cast(MONEY).alias(alias or name)


def stg_users(users: DataFrame) -> DataFrame:
    return users.select(
        F.col("id").alias("user_id"),
        _text("first_name"),
        _text("last_name"),
        F.lower(F.trim("email")).alias("email"),
        "age",
        _upper("gender"),
        _text("state"),
        _text("street_address"),
        _text("postal_code"),
        _text("city"),
        _text("country"),
        "latitude",
        "longitude",
        _text("traffic_source", "acquisition_source"),
        F.col("created_at").alias("account_created_at"),
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id",
        "user_id",
        _upper("status", "order_status"),
        _upper("gender", "customer_gender"),
        F.col("created_at").alias("order_created_at"),
        "shipped_at",
        "delivered_at",
        "returned_at",
        F.col("num_of_item").alias("item_count"),
    )


def clean_order_items(order_items: DataFrame) -> DataFrame:
    """Item columns in their staged form, orphans included."""
    return order_items.select(
        F.col("id").alias("order_item_id"),
        "order_id",
        "user_id",
        "product_id",
        "inventory_item_id",
        _upper("status", "order_item_status"),
        F.col("created_at").alias("order_item_created_at"),
        "shipped_at",
        "delivered_at",
        "returned_at",
        _money("sale_price"),
    )


def orphan_order_ids(order_items: DataFrame, staged_orders: DataFrame) -> DataFrame:
    """Order ids that occur in items but not in orders.

    Only the ids are shuffled, once per distinct id and map task, so an order
    with very many items costs no more than any other.
    """
    ids = order_items.select("order_id").filter(F.col("order_id").isNotNull()).distinct()
    return ids.join(staged_orders.select("order_id"), "order_id", "left_anti")


def stg_order_items(order_items: DataFrame, orphans: DataFrame) -> DataFrame:
    """Items whose order exists.

    Dropping the orphans keeps the same rows as joining all orders. They are
    few as a rule, and Spark then sends them to the items by their stored size,
    so ``orphans`` should be a stored frame.
    """
    return (
        clean_order_items(order_items)
        .filter(F.col("order_id").isNotNull())
        .join(orphans, "order_id", "left_anti")
    )


def stg_order_items_rejected(
    order_items: DataFrame, orphans: DataFrame, rejected_at: datetime | None = None
) -> DataFrame:
    """Items without an order, null order ids included, status left as it came."""
    at = F.lit(rejected_at.isoformat(sep=" ")) if rejected_at else F.current_timestamp()
    # Items without an id need no join, in which they would all meet in one task.
    without = order_items.filter(F.col("order_id").isNull())
    return order_items.join(orphans, "order_id", "left_semi").unionByName(without).select(
        F.col("id").alias("order_item_id"),
        "order_id",
        "user_id",
        "product_id",
        "inventory_item_id",
        F.col("status").alias("order_item_status"),
        F.col("created_at").alias("order_item_created_at"),
        _money("sale_price"),
        F.lit(ORPHAN_REASON).alias("rejection_reason"),
        at.cast("timestamp_ntz").alias("rejected_at"),
    )


def stg_products(products: DataFrame) -> DataFrame:
    name = F.nullif(F.trim("name"), F.lit(""))
    return products.select(
        F.col("id").alias("product_id"),
        F.coalesce(name, F.lit(MISSING_PRODUCT_NAME)).alias("product_name"),
        name.isNull().alias("is_product_name_missing"),
        _text("category", "product_category"),
        _text("brand", "product_brand"),
        _upper("department", "product_department"),
        _text("sku", "product_sku"),
        _money("cost", "product_cost"),
        _money("retail_price"),
        "distribution_center_id",
    )


def stg_inventory_items(inventory_items: DataFrame) -> DataFrame:
    return inventory_items.select(
        F.col("id").alias("inventory_item_id"),
        "product_id",
        F.col("created_at").alias("inventory_created_at"),
        "sold_at",
        _money("cost", "inventory_cost"),
        _text("product_category"),
        _text("product_name"),
        _text("product_brand"),
        _money("product_retail_price", "retail_price"),
        _upper("product_department"),
        _text("product_sku"),
        F.col("product_distribution_center_id").alias("distribution_center_id"),
    )


def stg_distribution_centers(centers: DataFrame) -> DataFrame:
    return centers.select(
        F.col("id").alias("distribution_center_id"),
        _text("name", "distribution_center_name"),
        "latitude",
        "longitude",
    )


def stg_events(events: DataFrame) -> DataFrame:
    """Web events; the address is kept only as a digest."""
    return events.select(
        F.col("id").alias("event_id"),
        "user_id",
        F.col("sequence_number").alias("event_sequence_number"),
        _text("session_id"),
        F.col("created_at").alias("event_created_at"),
        F.sha2(F.col("ip_address"), 256).alias("ip_address_hash"),
        _text("city"),
        _text("state"),
        _text("postal_code"),
        _text("browser"),
        _text("traffic_source"),
        _text("uri", "page_uri"),
        F.lower(F.trim("event_type")).alias("event_type"),
        F.col("user_id").isNotNull().alias("is_authenticated_event"),
    )
