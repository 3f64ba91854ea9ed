"""Questions asked of the detector's results and of the summary history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront_analytics.functions.columns import count_rows

# Fixed values.
REVIEW_STATUSES = ("PENDING_REVIEW", "APPROVED", "REJECTED")
EXCLUDED_REASON = "Series was skipped during ML scoring"

# -- detector results ----------------------------------------------------------


def _scored() -> list[Column]:
    return [
        count_rows().alias("scored_rows"),
        F.count_if("is_anomaly").alias("anomalies_detected"),
        F.min("ts").alias("first_scoring_timestamp"),
        F.max("ts").alias("last_scoring_timestamp"),
    ]


def scoring_summary(results: DataFrame) -> DataFrame:
    return results.agg(*_scored(), F.countDistinct("series").alias("scored_kpis"))


def scoring_by_series(results: DataFrame) -> DataFrame:
    return (
        results.groupBy(F.col("series").alias("series_key"))
        .agg(
            *_scored(),
            F.avg("y").alias("average_actual_value"),
            F.avg("forecast").alias("average_forecast_value"),
        )
        .orderBy("series_key")
    )


def anomalies(results: DataFrame) -> DataFrame:
    return (
        results.filter("is_anomaly")
        .select(
            F.col("series").alias("series_key"),
            F.col("ts").alias("metric_timestamp"),
            F.col("y").alias("actual_value"),
            F.col("forecast").alias("expected_value"),
            "lower_bound",
            "upper_bound",
            "percentile",
            "distance",
        )
        .orderBy(F.col("metric_timestamp").desc(), "series_key")
    )


def _boundary() -> Column:
    later = F.col("first_scoring_timestamp") > F.col("last_training_timestamp")
    return later.alias("valid_timestamp_boundary")


def boundary(train: DataFrame, results: DataFrame) -> DataFrame:
    """Does scoring start after training ended? One row."""
    trained = train.agg(F.max("metric_timestamp").alias("last_training_timestamp"))
    scored = results.agg(F.min("ts").alias("first_scoring_timestamp"))
    return trained.crossJoin(F.broadcast(scored)).select("*", _boundary())  # one row


def boundary_by_series(train: DataFrame, results: DataFrame) -> DataFrame:
    trained = train.groupBy("series_key").agg(F.max("metric_timestamp").alias("last_training_timestamp"))
    scored = results.groupBy(F.col("series").alias("series_key")).agg(F.min("ts").alias("first_scoring_timestamp"))
    return trained.join(scored, "series_key").select("*", _boundary()).orderBy("series_key")


def excluded_series(score: DataFrame, results: DataFrame) -> DataFrame:
    return (
        score.select(F.col("series_key").alias("excluded_series_key"))
        .distinct()
        .join(results, F.col("excluded_series_key") == results["series"], "left_anti")
        .select("excluded_series_key", F.lit(EXCLUDED_REASON).alias("exclusion_reason"))
        .orderBy("excluded_series_key")
    )


def duplicate_results(results: DataFrame) -> DataFrame:
    return (
        results.groupBy(F.col("series").alias("series_key"), F.col("ts").alias("metric_timestamp"))
        .agg(count_rows().alias("duplicate_count"))
        .filter(F.col("duplicate_count") > 1)
        .orderBy("series_key", "metric_timestamp")
    )


def invalid_results(results: DataFrame) -> DataFrame:
    empty = {
        "null_series_keys": "series",
        "null_timestamps": "ts",
        "null_actual_values": "y",
        "null_forecasts": "forecast",
        "null_lower_bounds": "lower_bound",
        "null_upper_bounds": "upper_bound",
    }
    return results.agg(
        *[F.count_if(F.col(c).isNull()).alias(name) for name, c in empty.items()],
        F.count_if(F.col("lower_bound") > F.col("upper_bound")).alias("invalid_bound_ranges"),
    )


# -- summary history -----------------------------------------------------------


def latest_summary(history: DataFrame) -> DataFrame:
    return (
        history.select(
            "summary_id",
            "period_start_date",
            "period_end_date",
            "model_name",
            "prompt_version",
            "input_version",
            "generated_summary",
            "generated_at",
            "review_status",
        )
        .orderBy(F.col("generated_at").desc())
        .limit(1)
    )


def missing_fields(history: DataFrame) -> DataFrame:
    empty = {
        "missing_summary_ids": "summary_id",
        "null_summaries": "generated_summary",
        "missing_prompts": "prompt_text",
        "missing_model_names": "model_name",
        "missing_prompt_versions": "prompt_version",
        "missing_input_versions": "input_version",
        "missing_generation_timestamps": "generated_at",
        "missing_review_statuses": "review_status",
    }
    return history.agg(
        count_rows().alias("total_summaries"),
        F.count_if(F.trim("generated_summary") == "").alias("empty_summaries"),
        *[F.count_if(F.col(c).isNull()).alias(name) for name, c in empty.items()],
    )


def period_dates(history: DataFrame) -> DataFrame:
    first, last = F.col("period_start_date"), F.col("period_end_date")
    return history.agg(
        F.count_if(first.isNull()).alias("missing_start_dates"),
        F.count_if(last.isNull()).alias("missing_end_dates"),
        F.count_if(first > last).alias("invalid_reporting_periods"),
    )


def duplicate_ids(history: DataFrame) -> DataFrame:
    return (
        history.groupBy("summary_id")
        .agg(count_rows().alias("duplicate_count"))
        .filter(F.col("duplicate_count") > 1)
    )


def status_counts(history: DataFrame) -> DataFrame:
    return history.groupBy("review_status").agg(count_rows().alias("summary_count")).orderBy("review_status")


def unexpected_statuses(history: DataFrame) -> DataFrame:
    status = F.col("review_status")
    return history.filter(status.isNull() | ~status.isin(*REVIEW_STATUSES))


def metadata_match(history: DataFrame, package: DataFrame) -> DataFrame:
    """Each stored summary beside the current evidence package."""
    pairs = {
        "start_date": ("period_start_date", "source_start_date"),
        "end_date": ("period_end_date", "source_end_date"),
        "input_version": ("input_version", "source_input_version"),
    }
    current = package.select(*[F.col(own).alias(source) for own, source in pairs.values()])
    return (
        history.crossJoin(F.broadcast(current))  # one row
        .orderBy(F.col("generated_at").desc())
        .select(
            "summary_id",
            "period_start_date",
            "period_end_date",
            "input_version",
            *current.columns,
            *[(F.col(own) == F.col(source)).alias(f"valid_{name}") for name, (own, source) in pairs.items()],
        )
    )


def summary_lengths(history: DataFrame) -> DataFrame:
    return history.select(
        "summary_id", F.length("generated_summary").alias("summary_character_count"), "generated_at"
    ).orderBy(F.col("generated_at").desc())
