"""The evidence package: period, KPI facts and the strongest anomalies, in one row."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storefront_analytics.functions.columns import count_rows, exact_mean
from storefront_analytics.operators.ranking import with_positions
from storefront_analytics.sources.scratch import Stored

# Fixed values.
INPUT_VERSION = "v2.0"
TOP_ANOMALIES = 20
LOWER_IS_BETTER = ("CART_ABANDONMENT_RATE",)
HIGHER_IS_BETTER = ("AVERAGE_ORDER_VALUE", "COMPLETED_REVENUE", "SESSION_CONVERSION_RATE", "TOTAL_ORDERS")

# Fields of one KPI fact and of one anomaly fact.
KPI_FACT_FIELDS = {
    "series_key": "series_key",
    "channel": "channel",
    "metric_name": "metric_name",
    "average_actual": "average_actual_value",
    "average_expected": "average_expected_value",
    "variance_from_expected_pct": "variance_from_expected_pct",
    "latest_actual": "latest_actual_value",
    "latest_expected": "latest_expected_value",
    "latest_metric_date": "latest_metric_date",
    "anomaly_count": "anomaly_count",
    "desired_direction": "desired_direction",
}
ANOMALY_FACT_FIELDS = {
    "evidence_id": "evidence_id",
    "severity_rank": "severity_rank",
    "series_key": "series_key",
    "channel": "channel",
    "metric_name": "metric_name",
    "metric_date": "metric_date",
    "actual_value": "actual_value",
    "expected_value": "expected_value",
    "lower_bound": "lower_bound",
    "upper_bound": "upper_bound",
    "distance": "distance",
    "percentile": "percentile",
    "direction": "anomaly_direction",
}


def anomaly_standardized(results: DataFrame) -> DataFrame:
    key = F.col("series").cast("string")
    return results.select(
        key.alias("series_key"),
        F.split_part(key, F.lit("|"), F.lit(1)).alias("channel"),
        F.split_part(key, F.lit("|"), F.lit(2)).alias("metric_name"),
        F.col("ts").alias("metric_timestamp"),
        F.col("y").cast("double").alias("actual_value"),
        F.col("forecast").cast("double").alias("expected_value"),
        "lower_bound",
        "upper_bound",
        "is_anomaly",
        "percentile",
        "distance",
    )


def reporting_period(standardized: DataFrame) -> DataFrame:
    """One row: first and last day, rows, series and anomalies."""
    return standardized.agg(
        F.min("metric_timestamp").cast("date").alias("period_start_date"),
        F.max("metric_timestamp").cast("date").alias("period_end_date"),
        count_rows().alias("scored_observations"),
        F.countDistinct("series_key").alias("scored_kpis"),
        F.count_if("is_anomaly").alias("total_anomalies"),
    )


def _rounded(value: Column, places: int) -> Column:
    """Rounded and held as a decimal, so that JSON shows it in plain digits."""
    return F.round(value, places).cast(f"decimal(38,{places})")


def desired_direction(metric: Column) -> Column:
    return (
        F.when(metric.isin(*LOWER_IS_BETTER), F.lit("LOWER_IS_BETTER"))
        .when(metric.isin(*HIGHER_IS_BETTER), F.lit("HIGHER_IS_BETTER"))
        .otherwise(F.lit("CONTEXT_DEPENDENT"))
    )


def kpi_rollup(standardized: DataFrame) -> DataFrame:
    """One row per series: averages, variance from expected, latest values.

    The averages are sums of decimals: the same whatever the order of adding, as
    the digest of the evidence must not change between runs.
    """
    actual, expected = (exact_mean(F.col(c).cast("decimal(28,10)")) for c in ("actual_value", "expected_value"))
    return standardized.groupBy("series_key", "channel", "metric_name").agg(
        _rounded(actual, 2).alias("average_actual_value"),
        _rounded(expected, 2).alias("average_expected_value"),
        _rounded(100 * (actual - expected) / F.nullif(F.abs(expected), F.lit(0.0)), 2).alias(
            "variance_from_expected_pct"
        ),
        _rounded(F.max_by("actual_value", "metric_timestamp"), 2).alias("latest_actual_value"),
        _rounded(F.max_by("expected_value", "metric_timestamp"), 2).alias("latest_expected_value"),
        F.max("metric_timestamp").cast("date").alias("latest_metric_date"),
        F.count_if("is_anomaly").alias("anomaly_count"),
        desired_direction(F.col("metric_name")).alias("desired_direction"),
    )


def _fact(fields: dict[str, str]) -> Column:
    """The fields as one object; keys in alphabetical order, which fixes its digest."""
    return F.struct(*[F.col(fields[key]).alias(key) for key in sorted(fields)])


def kpi_facts(rollup: DataFrame) -> DataFrame:
    """One row: an array with one object per series, by channel and metric."""
    pair = F.struct("channel", "metric_name", "series_key", _fact(KPI_FACT_FIELDS).alias("fact"))
    ordered = F.array_sort(F.collect_list(pair))
    return rollup.agg(F.transform(ordered, lambda p: p["fact"]).alias("kpi_facts"))


def _severity() -> list[Column]:
    return [F.abs("distance").desc(), F.col("metric_timestamp").desc(), F.col("series_key").asc()]


def _described(ranked: DataFrame) -> DataFrame:
    actual = F.col("actual_value")
    return ranked.select(
        F.format_string("ANOM-%04d", "severity_rank").alias("evidence_id"),
        "series_key",
        "channel",
        "metric_name",
        F.col("metric_timestamp").cast("date").alias("metric_date"),
        _rounded(actual, 2).alias("actual_value"),
        _rounded(F.col("expected_value"), 2).alias("expected_value"),
        _rounded(F.col("lower_bound"), 2).alias("lower_bound"),
        _rounded(F.col("upper_bound"), 2).alias("upper_bound"),
        _rounded(F.col("distance"), 4).alias("distance"),
        _rounded(F.col("percentile"), 6).alias("percentile"),
        F.when(actual > F.col("upper_bound"), F.lit("ABOVE_EXPECTED_RANGE"))
        .when(actual < F.col("lower_bound"), F.lit("BELOW_EXPECTED_RANGE"))
        .otherwise(F.lit("WITHIN_EXPECTED_RANGE"))
        .alias("anomaly_direction"),
        "severity_rank",
    )


def ranked_anomalies(standardized: DataFrame) -> DataFrame:
    """Every anomaly with its severity rank and evidence id."""
    found = standardized.filter("is_anomaly")
    return _described(with_positions(found, _severity(), "severity_rank"))


def top_anomaly_facts(standardized: DataFrame, top: int = TOP_ANOMALIES) -> DataFrame:
    """One row: the strongest anomalies as an array of objects, empty if none.

    A top-k selection comes first, so the window numbers ``top`` rows only.
    """
    strongest = standardized.filter("is_anomaly").orderBy(*_severity()).limit(top)
    place = F.row_number().over(Window.orderBy(*_severity())).cast("bigint")
    described = _described(strongest.withColumn("severity_rank", place))
    pair = F.struct("severity_rank", _fact(ANOMALY_FACT_FIELDS).alias("fact"))
    ordered = F.array_sort(F.collect_list(pair))
    return described.agg(F.transform(ordered, lambda p: p["fact"]).alias("anomaly_facts"))


def executive_summary_input(results: Stored, generated_at: datetime | None = None) -> DataFrame:
    """The package: one row joined from three one-row frames."""
    rows = anomaly_standardized(results.frame)
    at = F.lit(generated_at.isoformat(sep=" ")).cast("timestamp") if generated_at else F.current_timestamp()
    package = {
        "period_start_date": "period_start_date",
        "period_end_date": "period_end_date",
        "scored_observations": "scored_observations",
        "scored_kpis": "scored_kpis",
        "total_anomalies": "total_anomalies",
        "kpi_facts": "kpi_facts",
        "top_anomaly_facts": "anomaly_facts",
    }
    return (
        reporting_period(rows)
        .crossJoin(F.broadcast(kpi_facts(kpi_rollup(rows))))  # one row
        .crossJoin(F.broadcast(top_anomaly_facts(rows)))  # one row
        .select(
            "period_start_date",
            "period_end_date",
            "scored_observations",
            "scored_kpis",
            "total_anomalies",
            "kpi_facts",
            "anomaly_facts",
            _fact(package).alias("evidence_package"),
            F.lit(INPUT_VERSION).alias("input_version"),
            at.alias("input_generated_at"),
        )
    )


def evidence_json(package: Column) -> Column:
    """The package as JSON: missing top-level keys are left out, inner nulls kept."""
    keep = {"ignoreNullFields": "false"}

    def text(key: str) -> Column:
        value = package[key]
        if key.endswith("facts"):
            return F.to_json(value, keep)
        if key.endswith("date"):
            return F.concat(F.lit('"'), value.cast("string"), F.lit('"'))
        return value.cast("string")

    keys = (
        "kpi_facts",
        "period_end_date",
        "period_start_date",
        "scored_kpis",
        "scored_observations",
        "top_anomaly_facts",
        "total_anomalies",
    )
    # concat gives null for a missing value, and concat_ws passes over nulls.
    parts = [F.concat(F.lit(f'"{key}":'), text(key)) for key in keys]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
