from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from storefront_analytics.plans import customers, gtm
from storefront_analytics.queries import open_storefront
from storefront_analytics.sources.scratch import store
from tests.conftest import at, rows


def order(i, user, status, when, price=None):
    return {"order_id": i, "user_id": user, "status": status, "created_at": at(when)}, (
        {"id": i, "order_id": i, "user_id": user, "product_id": 1, "status": status, "sale_price": price}
        if price is not None
        else None
    )


def with_orders(*pairs):
    return {"orders": [o for o, _ in pairs], "order_items": [i for _, i in pairs if i]}


def test_dim_customer(shop):
    store_ = shop(
        users=[{"id": i, "created_at": at("2024-01-01 12:00:00")} for i in (1, 2, 3)],
        **with_orders(
            order(1, 1, "Complete", "2024-01-20", 10.0),
            order(2, 1, "Cancelled", "2024-01-21", 5.0),
            order(3, 2, "Returned", "2023-11-20", 7.0),
        ),
    )
    one, two, three = rows(store_.dim_customer, "user_id")
    assert one["is_repeat_customer"] and one["lifetime_revenue"] == Decimal("10.00")
    assert (one["lifecycle_status"], one["days_since_last_order"], one["customer_tenure_days"]) == ("Active", 4, 24)
    assert two["lifecycle_status"] == "At Risk" and two["average_completed_order_value"] is None
    assert three["lifecycle_status"] == "Never Purchased" and three["total_order_count"] == 0
    assert three["days_since_last_order"] is None


def test_rfm_and_360(shop):
    # Seven buyers, all with one order: frequency ties are broken by user id.
    pairs = [order(i, i, "Complete", f"2024-01-{10 + i:02d}", 10.0 * i) for i in range(1, 8)]
    pairs += [order(20, 8, "Returned", "2024-01-09", 1.0), order(21, 8, "Cancelled", "2024-01-09")]
    store_ = shop(users=[{"id": i, "age": 10 * i} for i in range(1, 10)], **with_orders(*pairs))
    rfm = rows(store_.mart_customer_rfm, "user_id")
    assert [r["user_id"] for r in rfm] == list(range(1, 8))
    assert {r["analysis_date"] for r in rfm} == {date(2024, 1, 18)}
    assert [r["recency_days"] for r in rfm] == [7, 6, 5, 4, 3, 2, 1]
    assert [r["frequency_score"] for r in rfm] == [1, 1, 2, 2, 3, 4, 5]
    assert [r["recency_score"] for r in rfm] == [1, 1, 2, 2, 3, 4, 5]
    assert rfm[6]["rfm_score"] == "555" and rfm[6]["customer_segment"] == "Champions"
    assert rfm[0]["customer_segment"] == "Hibernating"
    by_age = {r["age"]: r for r in rows(store_.mart_customer_360)}
    assert [by_age[a]["age_group"] for a in (10, 20, 50, 60)] == ["Under 20", "20–29", "50–59", "60+"]
    returned_only, nobody = by_age[80], by_age[90]
    assert returned_only["customer_segment"] == "Never Purchased"
    assert returned_only["engagement_status"] == "Never Purchased"
    assert returned_only["customer_return_rate"] == 1.0 and returned_only["customer_cancellation_rate"] == 0.5
    assert nobody["customer_return_rate"] == 0.0 and nobody["recency_days"] is None
    summary = {r["customer_segment"]: r for r in rows(store_.mart_customer_segment_summary)}
    assert summary["Never Purchased"]["recommended_action"] == "Improve first-purchase conversion"
    assert sum(r["customer_share"] for r in summary.values()) == pytest.approx(1.0)


@pytest.mark.parametrize(
    "scores, segment",
    [
        ((5, 4, 4), "Champions"),
        ((5, 4, 3), "Loyal Customers"),
        ((3, 3, 1), "Loyal Customers"),
        ((4, 2, 5), "New or Promising"),
        ((2, 3, 5), "At Risk"),
        ((1, 2, 5), "Hibernating"),
        ((3, 2, 5), "Needs Attention"),
    ],
)
def test_segments(spark, scores, segment):
    from pyspark.sql import functions as F

    assert spark.range(1).select(customers.rfm_segment(*[F.lit(s) for s in scores])).first()[0] == segment


def test_cohort_with_a_gap(shop):
    store_ = shop(
        **with_orders(
            order(1, 1, "Complete", "2023-01-15", 10.0),
            order(2, 2, "Complete", "2023-01-20", 20.0),
            order(3, 1, "Complete", "2023-04-02", 5.0),
            order(4, 1, "Cancelled", "2023-02-02", 5.0),
            order(5, None, "Complete", "2023-01-02", 99.0),
        )
    )
    out = rows(store_.mart_customer_cohort_retention, "activity_month")
    assert [r["months_since_first_purchase"] for r in out] == [0, 3]
    assert [r["cohort_size"] for r in out] == [2, 2]
    assert [r["retention_rate"] for r in out] == [1.0, 0.5]
    assert [r["cumulative_cohort_revenue"] for r in out] == [Decimal("30.00"), Decimal("35.00")]


def test_channel_without_sessions_ranks_first(shop):
    store_ = shop(
        users=[{"id": 1, "traffic_source": "email"}, {"id": 2, "traffic_source": "partner"}],
        events=[{"id": 1, "session_id": "s", "event_type": "home", "traffic_source": "email", "created_at": at("2024-01-01")}],
        **with_orders(order(1, 1, "Complete", "2024-01-01", 5.0)),
    )
    by = {r["acquisition_channel"]: r for r in rows(store_.mart_gtm_channel_summary)}
    assert by["Partner"]["session_conversion_rate"] is None and by["Partner"]["session_conversion_rank"] == 1
    assert by["Email"]["session_conversion_rank"] == 2
    assert by["Email"]["recommended_action"] == "Scale high-performing channel"


def test_region_ranks_equal_the_window(shop):
    users = [{"id": i, "country": f"C{i % 2}", "state": f"S{i % 5}" if i % 7 else None} for i in range(1, 40)]
    pairs = [order(i, i, "Complete", "2024-01-01", float(i % 4)) for i in range(1, 40)]
    store_ = shop(users=users, **with_orders(*pairs))
    regions = store(gtm.region_metrics(store_.mart_customer_360), "regions")
    got = rows(gtm.mart_geographic_performance(regions), "country", "state")
    place = F.dense_rank().over(Window.orderBy(F.col("total_revenue").desc_nulls_first())).cast("bigint")
    want = rows(regions.frame.withColumn("place", place), "country", "state")
    assert [r["global_revenue_rank"] for r in got] == [r["place"] for r in want]
    assert any(r["state"] == "Unknown" for r in got)


def test_products(shop):
    items = [
        {"id": 1, "order_id": 1, "user_id": 1, "product_id": 1, "status": "Complete", "sale_price": 10.0},
        {"id": 2, "order_id": 1, "user_id": 1, "product_id": 1, "status": "Complete", "sale_price": 20.0},
        {"id": 3, "order_id": 2, "user_id": 2, "product_id": 1, "status": "Returned", "sale_price": 30.0},
        {"id": 4, "order_id": 2, "user_id": None, "product_id": 1, "status": "Cancelled", "sale_price": 30.0},
        {"id": 5, "order_id": 9, "user_id": 3, "product_id": 1, "status": "Complete", "sale_price": 99.0},
        {"id": 6, "order_id": 2, "user_id": 2, "product_id": 2, "status": "Processing", "sale_price": 5.0},
        {"id": 7, "order_id": 2, "user_id": 2, "product_id": 77, "status": "Complete", "sale_price": 5.0},
    ]
    store_ = shop(
        orders=[{"order_id": 1}, {"order_id": 2}],
        order_items=items,
        products=[{"id": 1, "cost": 4.0}, {"id": 2, "cost": 1.0}, {"id": 3, "cost": 1.0}],
    )
    one, two = rows(store_.mart_product_performance, "product_id")
    assert (one["ordered_units"], one["unique_orders"], one["unique_customers"]) == (4, 2, 2)
    assert (one["completed_units"], one["returned_units"], one["cancelled_units"]) == (2, 1, 1)
    assert one["completed_revenue"] == Decimal("30.00") and one["completed_product_cost"] == Decimal("8.00")
    assert one["average_selling_price"] == 15.0 and one["estimated_gross_margin"] == pytest.approx(22 / 30)
    assert one["product_return_rate"] == pytest.approx(1 / 3) and one["revenue_rank"] == 1
    assert two["estimated_gross_margin"] is None and two["product_return_rate"] is None


def test_products_of_orders_with_several_buyers(shop):
    def item(n, order, user, product=1):
        return {"id": n, "order_id": order, "user_id": user, "product_id": product, "status": "Complete", "sale_price": 2.0}

    items = [item(1, 1, 1), item(2, 1, 2), item(3, 1, 3), item(4, 2, 2), item(5, 3, None), item(6, 2, 2, 2), item(7, 1, None, 2)]
    store_ = shop(orders=[{"order_id": i} for i in (1, 2, 3)], order_items=items, products=[{"id": 1}, {"id": 2}])
    one, two = rows(store_.mart_product_performance, "product_id")
    assert (one["ordered_units"], one["unique_orders"], one["unique_customers"]) == (5, 3, 3)
    assert (two["ordered_units"], two["unique_orders"], two["unique_customers"]) == (2, 2, 1)


def test_items_are_exchanged_once_for_products(spark):
    store_ = open_storefront(spark, "/root/testdata/sf0.001")
    per_order = gtm.product_orders(store_.stg_order_items)
    plan = per_order._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange hashpartitioning(product_id") == 1
    metrics = gtm.product_metrics(store(per_order, "orders"), store_.stg_order_items, store_.stg_products)
    assert "Expand" not in metrics._jdf.queryExecution().executedPlan().toString()


def test_pairs_of_products_and_orders_hold_only_their_keys(spark):
    # A task combines about as many pairs as it has items: sums beside them fill its memory.
    store_ = open_storefront(spark, "/root/testdata/sf0.001")
    assert gtm.product_orders(store_.stg_order_items).columns == ["product_id", "order_id"]


def test_orphans_are_found_once(shop):
    items = [{"id": n, "order_id": n, "product_id": 1, "status": "Complete", "sale_price": 1.0} for n in (1, 2, None)]
    store_ = shop(orders=[{"order_id": 1}], order_items=items, products=[{"id": 1}])
    plans = [f._jdf.queryExecution().optimizedPlan().toString() for f in (store_.stg_order_items, store_.stg_order_items_rejected)]
    assert all("Aggregate" not in plan for plan in plans)  # they read the stored ids
    assert [r["ordered_units"] for r in rows(store_.mart_product_performance)] == [1]
    assert {r["order_id"] for r in rows(store_.stg_order_items_rejected)} == {2, None}


def test_daily_kpis_keep_both_sides(shop):
    store_ = shop(
        users=[{"id": 1, "traffic_source": "email"}],
        events=[{"id": 1, "session_id": "s", "event_type": "home", "traffic_source": "email", "created_at": at("2024-01-02")}],
        **with_orders(order(1, 1, "Complete", "2024-01-01", 5.0), order(2, 50, "Cancelled", "2024-01-01")),
    )
    by = {(r["metric_date"].day, r["acquisition_channel"]): r for r in rows(store_.mart_daily_business_kpis)}
    assert set(by) == {(1, "Email"), (1, "Unknown"), (2, "Email")}
    assert by[1, "Email"]["total_sessions"] == 0 and by[1, "Email"]["session_conversion_rate"] is None
    assert by[2, "Email"]["total_orders"] == 0 and by[2, "Email"]["completed_revenue"] == Decimal("0.00")
    assert by[1, "Unknown"]["average_order_value"] is None and by[1, "Unknown"]["order_cancellation_rate"] == 1.0
    long = rows(store_.int_kpi_anomaly_input)
    keys = {(r["metric_timestamp"].day, r["series_key"]) for r in long}
    assert (2, "Email|CART_ABANDONMENT_RATE") not in keys  # no carts, no row
    assert (2, "Email|SESSION_CONVERSION_RATE") in keys and (2, "Email|TOTAL_ORDERS") in keys
    assert {r["dataset_split"] for r in long} == {"SCORE"}


def test_split_boundary(shop):
    pairs = [order(1, 1, "Complete", "2024-01-31", 1.0), order(2, 1, "Complete", "2024-01-01", 1.0)]
    pairs += [order(3, 1, "Complete", "2023-12-31", 1.0)]
    split = {r["metric_timestamp"]: r["dataset_split"] for r in rows(shop(**with_orders(*pairs)).int_kpi_anomaly_input)}
    assert split == {at("2024-01-31"): "SCORE", at("2024-01-01"): "SCORE", at("2023-12-31"): "TRAIN"}
