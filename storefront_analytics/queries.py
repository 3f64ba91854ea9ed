"""The registered queries: every relation and operator over one data folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storefront_analytics.functions.channels import canonical_channel
from storefront_analytics.plans import evidence, reviews, summaries, validation
from storefront_analytics.plans.detector import DetectorSettings
from storefront_analytics.plans.storefront import RunSettings, Storefront
from storefront_analytics.sources import raw_tables, scratch, supporting_csv
from storefront_analytics.sources.history_versions import HistoryVersions
from storefront_analytics.sources.star_schema import CUTOFF, StarSchema

RUN_AT = datetime(2024, 6, 1)
SETTINGS = RunSettings(as_of=CUTOFF, run_at=RUN_AT)
SOURCE = "star-schema"

# For the questions about left-out series: ask for a year of history, so that the
# shorter series of session ratios are left out.
YEAR_SETTINGS = RunSettings(as_of=CUTOFF, run_at=RUN_AT, detector=DetectorSettings(min_rows=365))

Query = Callable[[SparkSession, str], DataFrame]


def open_storefront(spark: SparkSession, folder: str, settings: RunSettings = SETTINGS) -> Storefront:
    star = StarSchema(spark, folder)
    reviews = _WhenRead({"history": star.summary_history, "decisions": star.review_decisions})
    return Storefront(_raw(star), settings, reviews)


class _WhenRead(dict):
    """Frames by name, each opened when it is first read."""

    def __init__(self, openers: dict[str, Callable[[], DataFrame]]):
        super().__init__()
        self.openers = openers

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.openers[name]()
        return self[name]


def _raw(star: StarSchema) -> _WhenRead:
    return _WhenRead({t: lambda t=t: raw_tables.conform(getattr(star, t)(), t) for t in raw_tables.RAW_SCHEMAS})


# Decimal places at which results are compared. What the detector fits comes from
# sums of doubles, whose last digits depend on the order of adding; on values of
# 100000 and more that is the tenth place.
PLACES = 6
FITTED_PLACES = {
    "intercept": 3,  # at day 0, far outside the data
    **dict.fromkeys(["spread", "scale", *[f"effect_{d}" for d in range(1, 8)]], 4),
    **dict.fromkeys(["forecast", "expected_value", "average_forecast_value", "lower_bound", "upper_bound"], 4),
}


def comparable(frame: DataFrame) -> DataFrame:
    """Plain types for comparing engines: whole numbers as BIGINT, money as
    DOUBLE, other reals rounded."""
    columns = []
    for f in frame.schema:
        value = F.col(f.name)
        if isinstance(f.dataType, T.IntegralType):
            value = value.cast("bigint")
        elif isinstance(f.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(f.dataType, T.DoubleType):
            value = F.round(value, FITTED_PLACES.get(f.name, PLACES)) + F.lit(0.0)  # no negative zero
        elif isinstance(f.dataType, (T.ArrayType, T.StructType)):
            value = F.to_json(value, {"ignoreNullFields": "false"})
        columns.append(value.alias(f.name))
    return frame.select(*columns)


# Names that are attributes of Storefront.
RELATIONS = (
    "stg_users",
    "stg_orders",
    "stg_order_items",
    "stg_order_items_rejected",
    "stg_products",
    "stg_inventory_items",
    "stg_distribution_centers",
    "stg_events",
    "int_customer_orders",
    "int_session_funnel",
    "dim_customer",
    "mart_customer_rfm",
    "mart_customer_360",
    "mart_customer_segment_summary",
    "mart_acquisition_channel_performance",
    "mart_conversion_funnel",
    "mart_customer_cohort_retention",
    "mart_geographic_performance",
    "mart_gtm_channel_summary",
    "mart_product_performance",
    "mart_daily_business_kpis",
    "int_kpi_anomaly_input",
    "kpi_train",
    "kpi_score",
    "kpi_detector_params",
    "kpi_anomaly_results",
    "summary_prompt",
)


def _relation(name: str) -> Query:
    return lambda spark, folder: comparable(getattr(open_storefront(spark, folder), name))


def _over(build: Callable[[Storefront], DataFrame], settings: RunSettings = SETTINGS) -> Query:
    return lambda spark, folder: comparable(build(open_storefront(spark, folder, settings)))


def _snapshot_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per table before the cut-off."""
    raw = _raw(StarSchema(spark, folder))
    frames = {t: raw_tables.before_cutoff(raw[t], t, CUTOFF) for t in raw_tables.RAW_SCHEMAS}
    manifest = raw_tables.manifest_rows(frames, SOURCE, CUTOFF)
    return comparable(manifest.select("table", "rows", F.size("columns").alias("column_count")))


def _extraction_manifest(spark: SparkSession, folder: str) -> DataFrame:
    raw = _raw(StarSchema(spark, folder))
    frames = {t: raw_tables.before_cutoff(raw[t], t, CUTOFF) for t in raw_tables.RAW_SCHEMAS}
    manifest = raw_tables.manifest_rows(frames, SOURCE, CUTOFF, RUN_AT)
    return comparable(
        manifest.select(
            "table",
            "rows",
            F.array_join("columns", ",").alias("columns"),
            "source",
            "cutoff_date",
            "extracted_at_utc",
        )
    )


def _load_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """A snapshot is written and loaded; its manifest against what was loaded."""
    raw = _raw(StarSchema(spark, folder))
    place = scratch.new_folder(spark, "snapshot")
    tables = {t: raw[t] for t in raw_tables.RAW_SCHEMAS}
    manifest = raw_tables.extract_snapshot(tables, f"{place}/extract", SOURCE, CUTOFF, RUN_AT)
    loaded = raw_tables.load_snapshot(spark, f"{place}/extract", f"{place}/raw")
    return comparable(raw_tables.reconcile(manifest, loaded))


def _review_write_back(spark: SparkSession, folder: str) -> DataFrame:
    """The batch of decisions published as a new version of the history, read back."""
    store = open_storefront(spark, folder)
    versions = HistoryVersions(spark, scratch.new_folder(spark, "history"))
    versions.publish(store.history, 0)
    versions.review(store.decisions, RUN_AT)
    return comparable(versions.read())


def _canonical_channel(spark: SparkSession, folder: str) -> DataFrame:
    store = open_storefront(spark, folder)
    return (
        store.raw["users"]
        .select("traffic_source", canonical_channel(F.col("traffic_source")).alias("channel"))
        .groupBy("traffic_source", "channel")
        .agg(F.count(F.lit(1)).alias("users"))
    )


def _kpi_observations(store: Storefront) -> DataFrame:
    return store.int_kpi_anomaly_input.select(
        F.col("acquisition_channel").alias("Channel"), "metric_name", "metric_timestamp", "metric_value"
    )


def _anomaly_observations(store: Storefront) -> DataFrame:
    return (
        evidence.anomaly_standardized(store.kpi_anomaly_results)
        .filter("is_anomaly")
        .select("channel", F.col("metric_name").alias("KPI_Name"), "metric_timestamp", "actual_value", "distance")
    )


def _through_csv(frame: DataFrame) -> DataFrame:
    """What a reader of the exported CSV sees."""
    path = scratch.new_folder(frame.sparkSession, "explore")
    supporting_csv.write_csv(frame, path)
    return supporting_csv.read_csv(frame.sparkSession, path, frame.schema)


def _chosen_kpis(store: Storefront) -> DataFrame:
    return supporting_csv.explore(
        _through_csv(_kpi_observations(store)), {"channel": ["Email", "Search"], "metric_name": ["TOTAL_ORDERS"]}
    )


def _evidence_rows(store: Storefront) -> DataFrame:
    return store.executive_summary_input.drop("evidence_package", "input_generated_at")


def _summary_text(store: Storefront) -> DataFrame:
    return store.executive_summary_input.select(
        "total_anomalies", summaries.summary_text(F.col("evidence_package")).alias("generated_summary")
    )


def _standard(store: Storefront) -> DataFrame:
    return evidence.anomaly_standardized(store.kpi_anomaly_results)


def _all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {name: _relation(name) for name in RELATIONS}
    out |= {
        "snapshot_extract": _snapshot_extract,
        "extraction_manifest": _extraction_manifest,
        "load_reconciliation": _load_reconciliation,
        "preview_users": _over(lambda s: raw_tables.preview_users(s.raw["users"])),
        "canonical_channel": _canonical_channel,
        "kpi_anomaly_exclusions": _over(lambda s: s.kpi_anomaly_exclusions.drop("recorded_at"), YEAR_SETTINGS),
        "anomaly_standardized": _over(_standard),
        "reporting_period": _over(lambda s: evidence.reporting_period(_standard(s))),
        "kpi_rollup": _over(lambda s: evidence.kpi_rollup(_standard(s))),
        "kpi_facts": _over(lambda s: evidence.kpi_facts(evidence.kpi_rollup(_standard(s)))),
        "ranked_anomalies": _over(lambda s: evidence.ranked_anomalies(_standard(s))),
        "top_anomaly_facts": _over(lambda s: evidence.top_anomaly_facts(_standard(s))),
        "executive_summary_input": _over(_evidence_rows),
        "summary_text": _over(_summary_text),
        "summary_append": _over(lambda s: s.executive_summaries),
        "review_queue": _over(lambda s: reviews.review_queue(s.history)),
        "review_queue_by_status": _over(lambda s: reviews.review_queue(s.history, "PENDING_REVIEW")),
        "apply_reviews": _over(lambda s: reviews.apply_reviews(s.history, s.judged_decisions, RUN_AT)),
        "review_write_back": _review_write_back,
        "history_migration": _over(
            lambda s: summaries.with_review_columns(s.history.drop("reviewed_by", "reviewed_at", "review_notes"))
        ),
        "review_conflicts": _over(lambda s: reviews.review_conflicts(s.judged_decisions)),
        "approved_summaries": _over(lambda s: s.approved_executive_summaries),
        "explore_kpis": _over(_chosen_kpis),
        "explore_kpi_rows": _over(lambda s: _chosen_kpis(s).agg(F.count("*").alias("row_count"))),
        "explore_kpi_choices": _over(lambda s: supporting_csv.filter_choices(_through_csv(_kpi_observations(s)))),
        "explore_anomalies": _over(
            lambda s: supporting_csv.explore(_through_csv(_anomaly_observations(s)), {"kpi_name": ["TOTAL_ORDERS"]})
        ),
        "val_scoring_summary": _over(lambda s: validation.scoring_summary(s.kpi_anomaly_results)),
        "val_by_series": _over(lambda s: validation.scoring_by_series(s.kpi_anomaly_results)),
        "val_anomalies": _over(lambda s: validation.anomalies(s.kpi_anomaly_results)),
        "val_boundary": _over(lambda s: validation.boundary(s.kpi_train, s.kpi_anomaly_results)),
        "val_boundary_by_series": _over(lambda s: validation.boundary_by_series(s.kpi_train, s.kpi_anomaly_results)),
        "val_excluded": _over(
            lambda s: validation.excluded_series(s.kpi_score, s.kpi_anomaly_results), YEAR_SETTINGS
        ),
        # As after a scoring run that was repeated for the anomalies.
        "val_duplicates": _over(
            lambda s: validation.duplicate_results(
                s.kpi_anomaly_results.unionByName(s.kpi_anomaly_results.filter("is_anomaly"))
            )
        ),
        "val_invalid_results": _over(lambda s: validation.invalid_results(s.kpi_anomaly_results)),
        "val_latest_summary": _over(lambda s: validation.latest_summary(s.history)),
        "val_summary_missing": _over(lambda s: validation.missing_fields(s.history)),
        "val_summary_periods": _over(lambda s: validation.period_dates(s.history)),
        "val_summary_duplicates": _over(lambda s: validation.duplicate_ids(s.history)),
        "val_status_counts": _over(lambda s: validation.status_counts(s.history)),
        "val_bad_status": _over(lambda s: validation.unexpected_statuses(s.history)),
        "val_metadata_match": _over(lambda s: validation.metadata_match(s.history, s.executive_summary_input)),
        "val_summary_length": _over(lambda s: validation.summary_lengths(s.history)),
    }
    kinds = {
        "check_unique": "unique",
        "check_not_null": "not_null",
        "check_accepted_values": "accepted_values",
        "check_relationships": "relationships",
        "check_accepted_range": "accepted_range",
        "check_expression": "expression_is_true",
        "check_unique_combination": "unique_combination",
    }
    out |= {key: _over(lambda s, kind=kind: s.quality(kind)) for key, kind in kinds.items()}
    return out


QUERIES = _all_queries()
