from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from storefront_analytics.plans import staging
from tests.conftest import at, rows

DAY = at("2024-01-05 10:00:00")


def test_products(shop):
    out = rows(
        shop(
            products=[
                {"id": 1, "name": None, "department": " men", "cost": 1.005},
                {"id": 2, "name": ""},
                {"id": 3, "name": "  "},
                {"id": 4, "name": " Hat "},
            ]
        ).stg_products,
        "product_id",
    )
    assert [r["product_name"] for r in out] == ["Unknown Product"] * 3 + ["Hat"]
    assert [r["is_product_name_missing"] for r in out] == [True, True, True, False]
    assert out[0]["product_department"] == "MEN"


def test_users_and_events(shop):
    store = shop(
        users=[{"id": 1, "email": " A@B.Com ", "gender": "f "}],
        events=[{"id": 1, "ip_address": "10.0.0.1", "event_type": " Cart "}, {"id": 2, "user_id": 5}],
    )
    user = rows(store.stg_users)[0]
    assert (user["email"], user["gender"]) == ("a@b.com", "F")
    first, second = rows(store.stg_events, "event_id")
    assert first["event_type"] == "cart" and first["is_authenticated_event"] is False
    assert len(first["ip_address_hash"]) == 64 and second["is_authenticated_event"] is True


def test_orphan_items(shop):
    store = shop(
        orders=[{"order_id": 1, "created_at": DAY}],
        order_items=[
            {"id": 10, "order_id": 1, "status": " complete", "sale_price": 2.5},
            {"id": 11, "order_id": 2, "status": " complete", "sale_price": 2.5},
            {"id": 12, "order_id": None},
        ],
    )
    assert [r["order_item_id"] for r in rows(store.stg_order_items)] == [10]
    rejected = rows(store.stg_order_items_rejected, "order_item_id")
    assert [r["order_item_id"] for r in rejected] == [11, 12]
    assert rejected[0]["order_item_status"] == " complete"
    assert {r["rejection_reason"] for r in rejected} == {"ORDER_ID_NOT_FOUND"}
    assert rejected[0]["rejected_at"] == datetime(2024, 6, 1)


def test_customer_orders(shop):
    store = shop(
        orders=[
            {"order_id": 1, "status": "Complete", "created_at": at("2024-01-01 23:00:00"), "delivered_at": at("2024-01-02 01:00:00"), "num_of_item": 9},
            {"order_id": 2, "status": " cancelled ", "created_at": DAY, "returned_at": DAY},
            {"order_id": 3, "created_at": DAY},
        ],
        order_items=[
            {"id": 1, "order_id": 1, "product_id": 5, "sale_price": 1.10},
            {"id": 2, "order_id": 1, "product_id": 5, "sale_price": 2.20},
            {"id": 3, "order_id": 99, "product_id": 5, "sale_price": 7.0},
        ],
    )
    one, two, three = rows(store.int_customer_orders, "order_id")
    assert (one["item_count"], one["distinct_product_count"], one["order_revenue"]) == (2, 1, Decimal("3.30"))
    assert one["average_item_price"] == pytest.approx(1.65)
    assert one["days_to_delivery"] == 1  # two hours, one midnight
    assert (two["item_count"], two["order_revenue"], two["average_item_price"]) == (0, Decimal("0.00"), None)
    assert two["is_returned"] and two["is_cancelled"]
    assert three["is_cancelled"] is False


def event(i, session, kind, when="2024-01-05 10:00:00", **more):
    return {"id": i, "session_id": session, "event_type": kind, "created_at": at(when), **more}


def test_sessions(shop):
    store = shop(
        events=[
            event(1, "bounce", "home"),
            event(2, "cart", "cart", "2024-01-05 10:00:00.900", user_id=None, browser="A", traffic_source="x"),
            event(3, "cart", "home", "2024-01-05 10:00:01.100", user_id=3, browser="B"),
            event(4, "buy", "cart", user_id=7),
            event(5, "buy", "purchase", user_id=9),
            event(6, "odd", "scroll", browser="A"),
            event(7, "odd", "scroll", browser="B"),
            event(8, "odd", "zoom"),
            event(9, "odd", "cancel"),
            event(10, None, "home"),
        ]
    )
    by = {r["session_id"]: r for r in rows(store.int_session_funnel)}
    assert set(by) == {"bounce", "cart", "buy", "odd"}
    assert by["bounce"]["bounced_session"] == 1 and by["bounce"]["user_id"] is None
    assert by["bounce"]["deepest_funnel_stage"] == "Home"
    cart = by["cart"]
    assert cart["session_duration_seconds"] == 1  # 0.2 seconds, one boundary
    assert (cart["user_id"], cart["browser"], cart["traffic_source"]) == (3, "B", "x")
    assert cart["abandoned_cart_session"] == 1 and cart["converted_session"] == 0
    buy = by["buy"]
    assert buy["converted_session"] == 1 and buy["abandoned_cart_session"] == 0 and buy["user_id"] == 9
    assert buy["deepest_funnel_stage"] == "Purchase"
    assert by["odd"]["distinct_event_type_count"] == 3  # scroll, zoom, cancel
    assert by["odd"]["event_count"] == 4 and by["odd"]["deepest_funnel_stage"] == "Other"


def test_sessions_are_grouped_by_hash_over_numbers(shop):
    store = shop(events=[event(1, "a", "home", browser="B"), event(2, "a", "odd")])
    plan = store.int_session_funnel._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    grouped = [line for line in plan.split("\n") if "event_created_at" in line and "Exchange" in line]
    assert len(grouped) <= 1


def test_sessions_of_missing_texts(shop):
    store = shop(events=[event(1, "a", "home", browser=None, traffic_source=None), event(2, "b", None, browser="Ü"), event(3, "b", "Odd", browser="z")])
    by = {r["session_id"]: r for r in rows(store.int_session_funnel)}
    assert by["a"]["browser"] is None and by["a"]["traffic_source"] is None
    assert by["b"]["browser"] == "Ü" and by["b"]["distinct_event_type_count"] == 1
