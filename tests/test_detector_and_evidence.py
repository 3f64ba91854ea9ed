from __future__ import annotations

import json
import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from storefront_analytics.functions.columns import normal_cdf
from storefront_analytics.plans import detector, evidence, validation
from storefront_analytics.sources.scratch import store
from tests.conftest import rows

START = datetime(2023, 1, 1)
POINTS = "series_key string, metric_timestamp timestamp_ntz, metric_value double"
RESULTS = (
    "series string, ts timestamp_ntz, y double, forecast double, lower_bound double, upper_bound double, "
    "is_anomaly boolean, percentile double, distance double"
)


def day(n: int) -> datetime:
    return START + timedelta(days=n)


@pytest.fixture(scope="module")
def scored(spark):
    def value(n):  # a trend, a weekly wave and a little noise
        return 100 + 2 * n + (10 if day(n).weekday() == 5 else 0) + ((n * 37) % 5 - 2) * 0.5

    train = [("Email|TOTAL_ORDERS", day(n), float(value(n))) for n in range(70)]
    train += [("Flat|TOTAL_ORDERS", day(n), 3.0) for n in range(70)]
    train += [("Short|TOTAL_ORDERS", day(n), float(n % 3)) for n in range(13)]
    recent = [("Email|TOTAL_ORDERS", day(70 + n), float(value(70 + n)) + (60 if n == 3 else 0)) for n in range(7)]
    recent += [(s, day(70), 3.0) for s in ("Flat|TOTAL_ORDERS", "Short|TOTAL_ORDERS", "New|TOTAL_ORDERS")]
    train_df = spark.createDataFrame(train, POINTS)
    score_df = spark.createDataFrame(recent, POINTS)
    params = detector.kpi_detector_params(train_df)
    return train_df, score_df, params, detector.kpi_anomaly_results(score_df, params)


def test_normal_cdf(spark):
    zs = [-5.0, -1.0, 0.0, 0.3, 2.575829, 60.0]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select(normal_cdf(F.col("z"))).collect()
    for z, r in zip(zs, got):
        assert r[0] == pytest.approx(0.5 * (1 + math.erf(z / math.sqrt(2))), abs=2e-7)


def test_params_match_numpy(scored):
    import numpy as np

    train, _, params, _ = scored
    row = {r["series_key"]: r for r in rows(params)}["Email|TOTAL_ORDERS"]
    data = [r for r in rows(train, "metric_timestamp") if r["series_key"] == "Email|TOTAL_ORDERS"]
    t = np.array([(r["metric_timestamp"].date() - detector.EPOCH).days for r in data], dtype=float)
    y = np.array([r["metric_value"] for r in data])
    slope, intercept = np.polyfit(t, y, 1)
    assert row["slope"] == pytest.approx(slope) and row["intercept"] == pytest.approx(intercept)
    residual = y - (intercept + slope * t)
    days = np.array([r["metric_timestamp"].isoweekday() % 7 + 1 for r in data])
    effects = {d: residual[days == d].mean() for d in range(1, 8)}
    for d in range(1, 8):
        assert row[f"effect_{d}"] == pytest.approx(effects[d])
    rest = residual - np.array([effects[d] for d in days])
    assert row["spread"] == pytest.approx(rest.std(ddof=1))


def test_planted_outlier_and_exclusions(scored):
    train, score, _, results = scored
    got = rows(results, "ts")
    assert {r["series"] for r in got} == {"Email|TOTAL_ORDERS"}
    assert [r["ts"] for r in got if r["is_anomaly"]] == [day(73)]
    hit = got[3]
    assert hit["y"] > hit["upper_bound"] and hit["distance"] > 2.575829 and hit["percentile"] > 0.995
    excluded = rows(detector.kpi_anomaly_exclusions(score, results), "series_key")
    assert [r["series_key"] for r in excluded] == ["Flat|TOTAL_ORDERS", "New|TOTAL_ORDERS", "Short|TOTAL_ORDERS"]
    assert len(rows(validation.excluded_series(score, results))) == 3
    assert rows(validation.boundary(train, results))[0]["valid_timestamp_boundary"] is True
    assert rows(validation.duplicate_results(results.unionAll(results)))[0]["duplicate_count"] == 2
    assert set(rows(validation.invalid_results(results))[0].values()) == {0}


def test_weekday_never_trained_has_no_effect(spark):
    points = [("s", day(n), float(n % 4)) for n in range(60) if day(n).weekday() != 0]
    row = rows(detector.kpi_detector_params(spark.createDataFrame(points, POINTS)))[0]
    assert row["effect_2"] == 0.0  # Monday


def _long_series(spark, factor=1.0):
    rng = random.Random(5)
    points = [("noisy", day(n), factor * (100 + 0.3 * n + 5 * (n % 7) + rng.random())) for n in range(90)]
    points += [("flat", day(n), factor * 7.0) for n in range(90)]
    points += [("line", day(n), factor * (3.0 * n + 11.7)) for n in range(90)]
    points += [("gaps", day(n), None if n % 5 == 0 else factor * (n % 11)) for n in range(90)]
    points += [("once", day(0), factor), ("never", day(1), None)]
    return spark.createDataFrame(points, POINTS)


def test_merged_moments_equal_one_training(spark):
    whole = _long_series(spark)
    halves = [whole.filter(f"metric_timestamp < '{day(31)}'"), whole.filter(f"metric_timestamp >= '{day(31)}'")]
    stored = store(detector.kpi_moments(halves[0]), "moments").frame
    merged = detector.merged_moments(stored, detector.kpi_moments(halves[1]))
    got = rows(detector.params_of_moments(merged), "series_key")
    want = rows(detector.kpi_detector_params(whole), "series_key")
    assert [r["series_key"] for r in got] == ["flat", "gaps", "line", "never", "noisy", "once"]
    for a, b in zip(got, want):
        for k in b:
            assert a[k] == b[k] if isinstance(b[k], (str, int)) or b[k] is None else a[k] == pytest.approx(b[k], abs=1e-6)


def test_training_is_one_aggregation(spark):
    plan = detector.kpi_detector_params(_long_series(spark).repartition(3))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("covar_pop") <= 4 and "Join" not in plan  # partial and final
    assert plan.count("Exchange hashpartitioning(series_key") == 2  # to the moments, and seven rows per series


@pytest.mark.parametrize("factor", [1e-12, 1.0, 1e12])
def test_scaling_does_not_change_which_series_are_scored(spark, factor):
    frame = _long_series(spark, factor)
    results = detector.kpi_anomaly_results(frame.filter("metric_value is not null"), detector.kpi_detector_params(frame))
    assert {r["series"] for r in results.select("series").distinct().collect()} == {"noisy", "gaps"}


def _results(spark, data):
    return store(spark.createDataFrame(data, RESULTS), "results")


def _row(series, n, y=1.0, distance=0.0, forecast=1.0):
    outside = abs(distance) > 2.5
    low, high = (2.0, 3.0) if distance < 0 else (-1.0, 0.5)
    if not outside:
        low, high = 0.0, 2.0
    return (series, day(n), y, forecast, low, high, outside, 0.5, distance)


def test_package_without_anomalies(spark):
    package = evidence.executive_summary_input(_results(spark, [_row("Email|TOTAL_ORDERS", 1)]))
    row = package.withColumn("json", evidence.evidence_json(F.col("evidence_package"))).first()
    assert row["total_anomalies"] == 0 and row["anomaly_facts"] == []
    parsed = json.loads(row["json"])
    assert parsed["top_anomaly_facts"] == [] and parsed["kpi_facts"][0]["average_actual"] == 1.0
    assert list(parsed) == sorted(parsed) and list(parsed["kpi_facts"][0]) == sorted(parsed["kpi_facts"][0])


def test_package_keeps_inner_nulls_and_drops_outer_ones(spark):
    zero = _results(spark, [_row("Email|OTHER", 1, forecast=0.0)])
    package = evidence.executive_summary_input(zero)
    fact = json.loads(package.select(evidence.evidence_json(F.col("evidence_package"))).first()[0])["kpi_facts"][0]
    assert fact["variance_from_expected_pct"] is None and fact["desired_direction"] == "CONTEXT_DEPENDENT"
    nothing = evidence.executive_summary_input(_results(spark, []))
    parsed = json.loads(nothing.select(evidence.evidence_json(F.col("evidence_package"))).first()[0])
    assert "period_start_date" not in parsed and parsed["scored_observations"] == 0


def test_twenty_strongest_of_twenty_five(spark):
    data = [_row("A|TOTAL_ORDERS", n, distance=3.0 + n) for n in range(22)]
    # Same strength: the later day first, then the series name.
    data += [_row("B|TOTAL_ORDERS", 60, distance=-99.0), _row("A|TOTAL_ORDERS", 60, distance=99.0)]
    data += [_row("A|TOTAL_ORDERS", 61, distance=-99.0)]
    standardized = evidence.anomaly_standardized(_results(spark, data).frame)
    ranked = rows(evidence.ranked_anomalies(standardized), "severity_rank")
    assert len(ranked) == 25 and ranked[24]["evidence_id"] == "ANOM-0025"
    assert [(r["series_key"][0], r["metric_date"].day) for r in ranked[:3]] == [("A", 3), ("A", 2), ("B", 2)]
    assert [r["anomaly_direction"][:5] for r in ranked[:3]] == ["BELOW", "ABOVE", "BELOW"]
    facts = evidence.top_anomaly_facts(standardized).first()["anomaly_facts"]
    assert [f["evidence_id"] for f in facts] == [r["evidence_id"] for r in ranked[:20]]


def test_latest_values_and_variance(spark):
    data = [_row("E|COMPLETED_REVENUE", 1, y=10.0, forecast=8.0), _row("E|COMPLETED_REVENUE", 5, y=20.0, forecast=12.0)]
    row = rows(evidence.kpi_rollup(evidence.anomaly_standardized(_results(spark, data).frame)))[0]
    assert float(row["latest_actual_value"]) == 20.0 and float(row["latest_expected_value"]) == 12.0
    assert float(row["variance_from_expected_pct"]) == 50.0
    assert row["channel"] == "E" and row["metric_name"] == "COMPLETED_REVENUE"
