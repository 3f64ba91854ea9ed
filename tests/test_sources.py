from __future__ import annotations

from datetime import date, datetime
from types import SimpleNamespace

import pytest

from pyspark.sql import functions as F

from storefront_analytics.functions.channels import canonical_channel
from storefront_analytics.sources import raw_tables, scratch, supporting_csv
from tests.conftest import at, rows


def test_canonical_channel(spark):
    cases = {
        " AdWords ": "Search",
        "search": "Search",
        "YOUTUBE": "Display",
        "Display": "Display",
        "facebook": "Facebook",
        "eMail": "Email",
        "Organic ": "Organic",
        None: "Unknown",
        "": "",
        "tiktok ads": "Tiktok Ads",
        "paid-social/EU": "Paid-Social/Eu",
    }
    frame = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r["s"]: r["c"] for r in frame.select("s", canonical_channel(F.col("s")).alias("c")).collect()}
    assert got == cases


def test_conform_matches_names_in_any_case_and_rejects_missing(spark):
    frame = spark.createDataFrame([(1, "a", 1.0, 2.0, "x")], "ID int, Name string, LATITUDE double, longitude double, extra string")
    out = raw_tables.conform(frame, "distribution_centers")
    assert out.columns == ["id", "name", "latitude", "longitude"]
    assert dict(out.dtypes)["id"] == "bigint"
    with pytest.raises(ValueError, match="longitude"):
        raw_tables.conform(frame.drop("longitude"), "distribution_centers")


def _tables(raw_table):
    small = {name: raw_table(name, [{"id": 1}]) for name in raw_tables.RAW_SCHEMAS if name != "orders"}
    small["orders"] = raw_table(
        "orders",
        [
            {"order_id": 1, "created_at": at("2025-12-31 23:59:59")},
            {"order_id": 2, "created_at": at("2026-01-01 00:00:00")},
            {"order_id": 3},
        ],
    )
    return small


def test_snapshot_load_and_reconciliation(spark, raw_table, tmp_path):
    folder, target = f"file://{tmp_path}/snapshot", f"file://{tmp_path}/raw"
    manifest = raw_tables.extract_snapshot(
        _tables(raw_table), folder, "unit", date(2026, 1, 1), datetime(2026, 1, 2)
    )
    by_table = {r["table"]: r for r in manifest.collect()}
    assert by_table["orders"]["rows"] == 1  # the later and the undated order are not in it
    assert by_table["users"]["rows"] == 0 and by_table["products"]["rows"] == 1
    assert by_table["orders"]["columns"] == raw_tables.raw_schema("orders").names
    assert by_table["orders"]["file_size_bytes"] > 0

    for name, row in by_table.items():  # counted while writing, as the files have it
        assert row["rows"] == spark.read.parquet(f"{folder}/{name}").count()

    loaded = raw_tables.load_snapshot(spark, folder, target)
    assert loaded["orders"].count() == 1
    again = raw_tables.load_snapshot(spark, folder, target)  # replaces, does not add
    assert again["orders"].count() == 1

    # A table that changed after the manifest was written fails the load.
    raw_table("users", [{"id": 5}]).write.mode("append").parquet(f"{folder}/users")
    with pytest.raises(RuntimeError, match="users"):
        raw_tables.load_snapshot(spark, folder, target)


def test_load_fails_without_a_table(spark, raw_table, tmp_path):
    folder = f"file://{tmp_path}/snapshot"
    tables = _tables(raw_table)
    tables.pop("events")
    raw_tables.extract_snapshot(tables, folder, "unit")
    with pytest.raises(Exception, match="events"):
        raw_tables.load_snapshot(spark, folder, f"file://{tmp_path}/raw")


def test_cutoff_reaches_the_scan(spark, raw_table, tmp_path):
    path = f"file://{tmp_path}/orders"
    raw_table("orders", [{"order_id": 1, "created_at": at("2025-01-01")}]).write.parquet(path)
    frame = raw_tables.before_cutoff(raw_tables.conform(spark.read.parquet(path), "orders"), "orders", date(2026, 1, 1))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(created_at" in plan


def test_preview_users(raw_table):
    users = raw_table("users", [{"id": i} for i in range(30, 0, -1)])
    assert [r["id"] for r in raw_tables.preview_users(users).collect()] == list(range(1, 11))


def test_supporting_csv(spark, tmp_path):
    path = f"file://{tmp_path}/kpis"
    frame = spark.createDataFrame(
        [("Search", "ORDERS", 1.0), ("Email", "ORDERS", 2.0), ("Email", None, 3.0)],
        "Channel string, metric_name string, value double",
    )
    supporting_csv.write_csv(frame, path)
    read = supporting_csv.read_csv(spark, path)
    assert supporting_csv.filter_columns(read) == {"channel": "Channel", "metric_name": "metric_name"}
    assert rows(supporting_csv.filter_choices(read)) == [
        {"field": "channel", "choice": "Email"},
        {"field": "channel", "choice": "Search"},
        {"field": "metric_name", "choice": "ORDERS"},
    ]
    assert supporting_csv.explore(read, {}).count() == 3
    assert supporting_csv.explore(read, {"channel": ["Email"], "metric_name": []}).count() == 2
    assert supporting_csv.explore(read, {"channel": ["Email"], "metric_name": ["ORDERS"]}).count() == 1


def test_scratch_uses_the_folder_of_the_session(spark, shared_dir):
    stored = scratch.store(spark.range(7), "seven")
    assert stored.rows == 7
    assert any(p.name.startswith("seven-") for p in (shared_dir / "storefront").iterdir())


def _session(master: str, **conf: str):
    """Only what the folder lookup asks a session for."""
    context = SimpleNamespace(master=master, applicationId="app-1", getConf=lambda: conf)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_scratch_without_a_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(_session("yarn"))
    local = scratch.shared_folder(_session("local[2]"))
    assert local.startswith("file:///") and scratch.shared_folder(_session("local[2]")) == local
    named = _session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/"})
    assert scratch.shared_folder(named) == "hdfs://shared"


def test_counts_of_an_extraction_need_no_second_scan(spark, raw_table, tmp_path, monkeypatch):
    scanned = []
    monkeypatch.setattr(raw_tables.F, "count", lambda c, real=raw_tables.F.count: scanned.append(c) or real(c))
    tables = {"orders": raw_table("orders", [{"order_id": i, "created_at": at("2024-01-01")} for i in range(40)]).repartition(7)}
    manifest = raw_tables.extract_snapshot(tables, f"file://{tmp_path}/s", "unit", date(2026, 1, 1))
    assert [r["rows"] for r in manifest.collect()] == [40]
    assert len(scanned) == 1  # the observed one
