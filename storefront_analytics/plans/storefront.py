"""All relations of one run, each built from the ones it reads."""

from __future__ import annotations

from collections.abc import Mapping
from copy import copy
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame

from storefront_analytics.plans import (
    customers,
    detector,
    evidence,
    gtm,
    intermediate,
    monitoring,
    quality_rules,
    reviews,
    staging,
    summaries,
)
from storefront_analytics.operators.quality import check_counts
from storefront_analytics.session import check_session
from storefront_analytics.sources.scratch import Stored, store


@dataclass(frozen=True)
class RunSettings:
    """What the clock or the operator would otherwise decide."""

    as_of: date | None = None  # today
    run_at: datetime | None = None  # now
    detector: detector.DetectorSettings = field(default_factory=detector.DetectorSettings)
    score_days: int = monitoring.SCORE_DAYS
    train_until: date | None = None  # first day not trained on
    score_since: date | None = None  # first day scored


class Storefront:
    """Lazy relations over the seven raw tables.

    Attributes are frames; nothing is computed before it is asked for. The
    private ``_stored`` ones are written once to the shared folder because more
    than one step reads them.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        settings: RunSettings = RunSettings(),
        reviews: Mapping[str, DataFrame] | None = None,
        detector_params: DataFrame | None = None,
    ):
        """``detector_params``: what an earlier run trained, instead of training anew."""
        self.raw = raw
        self.settings = settings
        self.reviews = {} if reviews is None else reviews
        if detector_params is not None:
            self.__dict__["kpi_detector_params"] = detector_params

    @cached_property
    def history(self) -> DataFrame:
        """Stored summaries."""
        return self.reviews["history"]

    @cached_property
    def decisions(self) -> DataFrame:
        """Submitted review decisions."""
        return self.reviews["decisions"]

    # -- staging ---------------------------------------------------------------

    @cached_property
    def stg_users(self) -> DataFrame:
        return staging.stg_users(self.raw["users"])

    @cached_property
    def stg_orders(self) -> DataFrame:
        return staging.stg_orders(self.raw["orders"])

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw["products"])

    @cached_property
    def stg_inventory_items(self) -> DataFrame:
        return staging.stg_inventory_items(self.raw["inventory_items"])

    @cached_property
    def stg_distribution_centers(self) -> DataFrame:
        return staging.stg_distribution_centers(self.raw["distribution_centers"])

    @cached_property
    def stg_events(self) -> DataFrame:
        return staging.stg_events(self.raw["events"])

    @cached_property
    def _orphans(self) -> DataFrame:
        return store(staging.orphan_order_ids(self.raw["order_items"], self.stg_orders), "orphans").frame

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return staging.stg_order_items(self.raw["order_items"], self._orphans)

    @cached_property
    def stg_order_items_rejected(self) -> DataFrame:
        return staging.stg_order_items_rejected(
            self.raw["order_items"], self._orphans, self.settings.run_at
        )

    # -- intermediate ----------------------------------------------------------

    @cached_property
    def int_customer_orders(self) -> DataFrame:
        items = staging.clean_order_items(self.raw["order_items"])
        return intermediate.int_customer_orders(self.stg_orders, items)

    @cached_property
    def int_session_funnel(self) -> DataFrame:
        return intermediate.int_session_funnel(self.stg_events)

    # -- customers -------------------------------------------------------------

    @cached_property
    def _stored_customer_metrics(self) -> Stored:
        return store(customers.customer_order_metrics(self.int_customer_orders), "customer-metrics")

    @cached_property
    def dim_customer(self) -> DataFrame:
        as_of = self.settings.as_of or date.today()
        return customers.dim_customer(self.stg_users, self._stored_customer_metrics.frame, as_of)

    @cached_property
    def mart_customer_rfm(self) -> DataFrame:
        return customers.mart_customer_rfm(self._stored_customer_metrics)

    @cached_property
    def mart_customer_360(self) -> DataFrame:
        return customers.mart_customer_360(self.dim_customer, self.mart_customer_rfm)

    @cached_property
    def mart_customer_segment_summary(self) -> DataFrame:
        return customers.mart_customer_segment_summary(
            store(customers.segment_metrics(self.mart_customer_360), "segments")
        )

    # -- go-to-market ----------------------------------------------------------

    @cached_property
    def _stored_channels(self) -> Stored:
        return store(gtm.channel_metrics(self.mart_customer_360), "channels")

    @cached_property
    def mart_acquisition_channel_performance(self) -> DataFrame:
        return gtm.mart_acquisition_channel_performance(self._stored_channels)

    @cached_property
    def mart_geographic_performance(self) -> DataFrame:
        return gtm.mart_geographic_performance(store(gtm.region_metrics(self.mart_customer_360), "regions"))

    @cached_property
    def mart_conversion_funnel(self) -> DataFrame:
        return gtm.mart_conversion_funnel(self.int_session_funnel)

    @cached_property
    def mart_gtm_channel_summary(self) -> DataFrame:
        combined = gtm.channel_sessions(gtm.channel_rates(self._stored_channels), self.int_session_funnel)
        return gtm.mart_gtm_channel_summary(store(combined, "channel-sessions"))

    @cached_property
    def mart_customer_cohort_retention(self) -> DataFrame:
        return gtm.mart_customer_cohort_retention(self.int_customer_orders)

    @cached_property
    def mart_product_performance(self) -> DataFrame:
        per_order = Stored(gtm.product_orders(self.stg_order_items))  # read once
        products = gtm.product_metrics(per_order, self.stg_order_items, self.stg_products)
        return gtm.mart_product_performance(store(products, "products"))

    # -- monitoring and detector -----------------------------------------------

    @cached_property
    def _stored_daily_kpis(self) -> Stored:
        return store(
            monitoring.mart_daily_business_kpis(
                self.int_customer_orders, self.stg_users, self.mart_conversion_funnel
            ),
            "daily-kpis",
        )

    @cached_property
    def mart_daily_business_kpis(self) -> DataFrame:
        return monitoring.mart_daily_business_kpis(
            self.int_customer_orders, self.stg_users, self.mart_conversion_funnel
        )

    @cached_property
    def int_kpi_anomaly_input(self) -> DataFrame:
        return monitoring.int_kpi_anomaly_input(self._stored_daily_kpis, self.settings.score_days)

    @cached_property
    def kpi_train(self) -> DataFrame:
        return detector.kpi_train(self.int_kpi_anomaly_input, self.settings.train_until)

    @cached_property
    def kpi_score(self) -> DataFrame:
        return detector.kpi_score(self.int_kpi_anomaly_input, self.settings.score_since)

    @cached_property
    def kpi_detector_params(self) -> DataFrame:
        return detector.kpi_detector_params(self.kpi_train)

    @cached_property
    def _stored_results(self) -> Stored:
        return store(
            detector.kpi_anomaly_results(self.kpi_score, self.kpi_detector_params, self.settings.detector),
            "anomaly-results",
        )

    @cached_property
    def kpi_anomaly_results(self) -> DataFrame:
        return self._stored_results.frame

    @cached_property
    def kpi_anomaly_exclusions(self) -> DataFrame:
        return detector.kpi_anomaly_exclusions(self.kpi_score, self.kpi_anomaly_results, self.settings.run_at)

    # -- governance --------------------------------------------------------------

    @cached_property
    def executive_summary_input(self) -> DataFrame:
        return evidence.executive_summary_input(self._stored_results, self.settings.run_at)

    @cached_property
    def summary_prompt(self) -> DataFrame:
        return summaries.summary_prompt(self.executive_summary_input)

    @cached_property
    def _stored_candidates(self) -> Stored:
        return store(
            summaries.summary_candidates(self.executive_summary_input, self.settings.run_at), "summary-candidates"
        )

    @cached_property
    def executive_summaries(self) -> DataFrame:
        """The history with the current summary, if it is new."""
        new = summaries.new_summaries(self._stored_candidates, self.history)
        return self.history.unionByName(new)

    @cached_property
    def judged_decisions(self) -> DataFrame:
        return reviews.judged_decisions(self.history, self.decisions)

    @cached_property
    def approved_executive_summaries(self) -> DataFrame:
        return summaries.approved_summaries(self.history)

    # -- checks and storage --------------------------------------------------------

    def quality(self, kind: str | None = None) -> DataFrame:
        """Violations per declared check, of one kind or of all."""
        checks = quality_rules.checks_of(kind) if kind else quality_rules.all_checks()
        names = {c.relation for c in checks} | {c.parent[0] for c in checks if c.parent}
        read = copy(self)  # it keeps relations with the columns that rules and readers look at
        for source, readers in READ_BY.items():
            if len(names & readers) > 1:
                read.__dict__[source] = getattr(read, source).drop(*UNREAD.get(source, ()))
                read.keep(source)
        return check_counts({name: getattr(read, name) for name in names}, checks)

    def keep(self, *names: str) -> None:
        """Store relations now; what is built on them afterwards reads the stored rows."""
        for name in names:
            self.__dict__[name] = store(getattr(self, name), name).frame

    def require_unique_keys(self) -> None:
        """Orders, users and products are counted as rows: fail if one has two."""
        for name, key in (("stg_orders", "order_id"), ("stg_users", "user_id"), ("stg_products", "product_id")):
            repeated = getattr(self, name).groupBy(key).count().filter("count > 1")
            if not repeated.isEmpty():
                raise ValueError(f"{name}.{key} is not unique")

    def build(
        self, target: str, relations: tuple[str, ...] | None = None, history: str | None = None
    ) -> dict[str, DataFrame]:
        """Write relations in order, in place of an earlier build; later ones read what was written.

        With ``history``, the folder of stored summaries, the current summary
        is appended there, if it is new, and the approved ones are written.
        """
        spark = next(iter(self.raw.values())).sparkSession if self.raw else None
        if spark is not None:
            check_session(spark)
        self.require_unique_keys()
        out = {}
        for name in relations or BUILD_ORDER:
            frame: DataFrame = getattr(self, name)
            frame.write.mode("overwrite").parquet(f"{target}/{name}")
            out[name] = frame.sparkSession.read.schema(frame.schema).parquet(f"{target}/{name}")
            self.__dict__[name] = out[name]
            if name in STORED_AS:
                self.__dict__[STORED_AS[name]] = Stored(out[name])
        if history:
            summaries.append_summaries(self._stored_candidates, history)
            spark = self._stored_candidates.frame.sparkSession
            stored = spark.read.schema(summaries.HISTORY_SCHEMA).parquet(history)
            name = "approved_executive_summaries"
            summaries.approved_summaries(stored).write.mode("overwrite").parquet(f"{target}/{name}")
            out[name] = spark.read.parquet(f"{target}/{name}")
        return out


# Costly relations and who reads them.
READ_BY = {
    "int_customer_orders": {
        "int_customer_orders",
        "dim_customer",
        "mart_customer_360",
        "mart_customer_cohort_retention",
        "kpi_anomaly_results",
    },
    "mart_customer_rfm": {"mart_customer_rfm", "mart_customer_360"},
    "mart_customer_360": {"mart_customer_360", "mart_customer_segment_summary", "mart_geographic_performance"},
}

# Columns that neither a rule nor another relation reads.
UNREAD = {
    "int_customer_orders": (
        "distinct_product_count",
        "average_item_price",
        "shipped_at",
        "delivered_at",
        "returned_at",
        "is_returned",
        "is_cancelled",
    )
}

# Relations that later steps read in stored form.
STORED_AS = {"mart_daily_business_kpis": "_stored_daily_kpis", "kpi_anomaly_results": "_stored_results"}


BUILD_ORDER = (
    "stg_order_items_rejected",
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
    "kpi_anomaly_exclusions",
    "executive_summary_input",
)
