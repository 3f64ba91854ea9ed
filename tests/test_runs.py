from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime

import pytest

from storefront_analytics.plans.storefront import RunSettings, Storefront
from storefront_analytics.queries import open_storefront
from storefront_analytics.session import check_session
from storefront_analytics.sources import scratch

FOLDER = "/root/testdata/sf0.001"
SETTINGS = RunSettings(as_of=date(2024, 1, 25), run_at=datetime(2024, 6, 1))


def test_split_dates_and_earlier_training(spark):
    first = open_storefront(spark, FOLDER, SETTINGS)
    assert first.kpi_train.count() > 0
    until = replace(SETTINGS, train_until=date(2020, 1, 1), score_since=date(2024, 1, 20))
    narrow = open_storefront(spark, FOLDER, until)
    assert str(narrow.kpi_train.agg({"metric_timestamp": "max"}).first()[0]) < "2020-01-01"
    assert str(narrow.kpi_score.agg({"metric_timestamp": "min"}).first()[0]) >= "2024-01-20"
    # Parameters of an earlier run score as that run did.
    stored = scratch.store(first.kpi_detector_params, "params").frame
    later = Storefront(first.raw, until, first.reviews, detector_params=stored)
    want = first.kpi_anomaly_results.filter("ts >= '2024-01-20'")
    columns = ["series", "ts", "forecast", "is_anomaly"]
    assert sorted(later.kpi_anomaly_results.select(*columns).collect()) == sorted(want.select(*columns).collect())


def test_rebuild_and_history(spark, tmp_path):
    target, history = f"file://{tmp_path}/marts", f"file://{tmp_path}/history"
    names = ("mart_daily_business_kpis", "kpi_anomaly_results", "executive_summary_input")
    for _ in range(2):
        out = open_storefront(spark, FOLDER, SETTINGS).build(target, names, history)
    assert spark.read.parquet(history).count() == 1  # the second build found it there
    assert out["mart_daily_business_kpis"].count() == 1787 and out["approved_executive_summaries"].count() == 0


def test_repeated_keys_fail_a_build(shop, tmp_path):
    store = shop(users=[{"id": 1}, {"id": 1}])
    with pytest.raises(ValueError, match="stg_users.user_id"):
        store.require_unique_keys()


def test_session_check(spark):
    check_session(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(ValueError, match="adaptive"):
            check_session(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_stored_tables_can_be_cleared(spark, shared_dir):
    before = {p.name for p in (shared_dir / "storefront").iterdir()} if (shared_dir / "storefront").exists() else set()
    kept, scratch._stored = scratch._stored, {}
    try:
        scratch.store(spark.range(3), "gone")
        assert scratch.clear(spark) == 1 and scratch.clear(spark) == 0
        first = scratch.store(spark.range(2), "kept").frame
        mark = scratch.stored_so_far(spark)
        scratch.store(spark.range(3), "between")
        final = scratch.store(spark.range(4), "final").frame
        assert scratch.clear(spark, mark, last=False) == 1
        assert first.count() == 2 and final.count() == 4
        assert scratch.clear(spark) == 2
    finally:
        scratch._stored = kept
    assert {p.name for p in (shared_dir / "storefront").iterdir()} == before
