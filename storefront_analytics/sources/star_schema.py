"""The seven raw storefront tables, derived from a star-schema data set.

Every rule is a row-wise projection of one given table (users and
inventory_items add a join to a dimension), so deriving the raw tables adds no
shuffle of its own. ``FIXTURES.md`` lists the same rules in prose.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Order dates end in 2001, web events are from January 2024: shift the orders
# so that both meet in the daily KPIs.
SHIFT_DAYS = 8217
CUTOFF = date(2024, 1, 25)

# Columns read from the given tables, with their types.
GIVEN_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "documents": "doc_id bigint, text string, lang string, source string",
}


def _nth(key: str, values: list[str | None]) -> str:
    """``values[key]`` for key = 0, 1, ...; None stands for a missing value."""
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {key} {arms} END"


def _days(n: object) -> str:
    return f"make_dt_interval(cast({n} AS int))"


def _seconds(n: object) -> str:
    return f"make_dt_interval(0, 0, 0, cast({n} AS decimal(18,6)))"


def _moment(at: datetime) -> str:
    return f"TIMESTAMP_NTZ '{at.isoformat(sep=' ')}'"


def _shifted(day: str, key: str) -> str:
    """The day moved to the events' time, at a time of day that depends on the key."""
    return f"{day} + {_days(SHIFT_DAYS)} + {_seconds(f'({key} * 7919) % 86400')}"


def _with_deliveries(frame: DataFrame, delivery_days: str) -> DataFrame:
    """Add the later timestamps that the status implies."""
    plain = "upper(trim(status))"
    return frame.selectExpr(
        "*",
        f"CASE WHEN {plain} IN ('SHIPPED', 'COMPLETE', 'RETURNED') THEN created_at + {_days(1)} END AS shipped_at",
        f"CASE WHEN {plain} IN ('COMPLETE', 'RETURNED') THEN created_at + {_days(delivery_days)} END AS delivered_at",
        f"CASE WHEN {plain} = 'RETURNED' THEN created_at + {_days(12)} END AS returned_at",
    )


_SUMMARY_ID = "concat('summary-', doc_id - if(doc_id % 50 = 49, 1, 0))"
_REVIEW_STATE = _nth(
    "doc_id % 7",
    ["PENDING_REVIEW", "PENDING_REVIEW", "PENDING_REVIEW", "APPROVED", "APPROVED", "REJECTED", "NEEDS_REVISION"],
)
_REVIEWED = "doc_id % 7 IN (3, 4, 5)"
_REVIEWED_AT = f"{_moment(datetime(2024, 3, 1))} + {_seconds('doc_id')}"


class StarSchema:
    """Raw tables on top of one folder of the given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(GIVEN_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    # -- raw tables ---------------------------------------------------------

    def users(self) -> DataFrame:
        sources = ["Search", " adwords ", "Display", "YouTube", "Facebook", "Email", "Organic", "referral-site", None]
        return (
            self.table("customer")
            .join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr(
                "c_custkey AS id",
                "c_name AS first_name",
                "concat(' Family ', c_custkey % 100) AS last_name",
                "if(c_custkey % 103 = 102, NULL, concat(lower(c_name), '@Example.com ')) AS email",
                "CASE WHEN c_custkey % 50 = 49 THEN NULL WHEN c_custkey % 101 = 100 THEN 130 "
                "ELSE 15 + c_custkey % 60 END AS age",
                "if(c_custkey % 2 = 0, ' f', 'M') AS gender",
                "if(c_custkey % 40 = 39, NULL, n_name) AS state",
                "concat(c_custkey, ' Main Street ') AS street_address",
                "string(10000 + c_custkey % 90000) AS postal_code",
                "concat('City ', c_custkey % 70) AS city",
                "r_name AS country",
                "double(c_custkey % 181 - 90) AS latitude",
                "double(c_custkey % 361 - 180) AS longitude",
                f"{_nth('c_custkey % 9', sources)} AS traffic_source",
                f"{_moment(datetime(2016, 1, 1))} + {_days('c_custkey % 365')} AS created_at",
            )
        )

    def orders(self) -> DataFrame:
        open_status = _nth("o_orderkey % 3", ["Cancelled", "Returned", "Processing"])
        orders = self.table("orders").selectExpr(
            "o_orderkey AS order_id",
            # Some orders belong to no user.
            "if(o_orderkey % 199 = 198, -o_custkey - 1, o_custkey - if(o_custkey % 20 = 19, 1, 0)) AS user_id",
            "CASE if(o_orderkey % 307 = 306, 'H', o_orderstatus) WHEN 'H' THEN 'On hold ' WHEN 'F' THEN ' Complete' "
            f"WHEN 'O' THEN if(o_orderkey % 2 = 0, 'Shipped', 'complete') ELSE {open_status} END AS status",
            "if(o_custkey % 2 = 0, 'f ', 'm') AS gender",
            f"{_shifted('o_orderdate', 'o_orderkey')} AS created_at",
            "1 + o_orderkey % 4 AS num_of_item",
        )
        return _with_deliveries(orders, "2 + order_id % 7")

    def order_items(self) -> DataFrame:
        # Line numbers repeat within an order, so the id is taken from a digest
        # of the whole row (63 bits): no window over an order of any size.
        key = (
            "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, date(l_shipdate), l_returnflag, "
            "l_linestatus, bigint(round(l_extendedprice * 100)))"
        )
        # The first digit gives its lower three bits, the next 15 fit into a long: no decimals per row.
        top = "bigint((ascii(_digest) & 15) + shiftright(ascii(_digest), 6) * 9) & 7"
        item_id = f"bigint(conv(substr(_digest, 2, 15), 16, 10)) + shiftleft({top}, 60)"
        items = self.table("lineitem").selectExpr("*", f"md5({key}) AS _digest").selectExpr(
            f"{item_id} AS id",
            "if(l_orderkey % 311 = 310, -l_orderkey, l_orderkey) AS order_id",  # some without an order
            "l_suppkey AS user_id",
            "l_partkey AS product_id",
            "CASE concat(l_returnflag, l_linestatus) WHEN 'RF' THEN 'Returned' WHEN 'RO' THEN 'Cancelled' "
            "WHEN 'AO' THEN ' shipped ' WHEN 'NO' THEN 'Processing' ELSE 'Complete' END AS status",
            f"{_shifted('l_shipdate', 'l_orderkey')} AS created_at",
            "l_extendedprice AS sale_price",
        )
        return _with_deliveries(items.withColumn("inventory_item_id", F.col("id")), "3")

    def products(self) -> DataFrame:
        suppliers = self.table("supplier").agg(F.count(F.lit(1)).alias("suppliers"))
        return (
            self.table("part")
            .crossJoin(F.broadcast(suppliers))  # one row
            .selectExpr(
                "p_partkey AS id",
                "p_retailprice * if(p_partkey % 89 = 88, 36, 18) AS cost",
                "p_type AS category",
                "CASE p_partkey % 100 WHEN 99 THEN '  ' WHEN 98 THEN NULL ELSE p_name END AS name",
                "p_brand AS brand",
                "p_retailprice * if(p_partkey % 83 = 82, 0, 30) AS retail_price",
                "if(p_partkey % 2 = 0, 'Men', 'women ') AS department",
                "concat('SKU-', p_partkey - if(p_partkey % 97 = 96, 1, 0)) AS sku",
                "p_partkey % suppliers AS distribution_center_id",
            )
        )

    def inventory_items(self) -> DataFrame:
        items = self.order_items().select("inventory_item_id", "product_id", "status", "created_at")
        products = self.products().withColumnRenamed("id", "product_id")
        return items.join(products, "product_id").selectExpr(
            "inventory_item_id AS id",
            "product_id",
            f"created_at - {_days(30)} AS created_at",
            "if(status = 'Cancelled', NULL, created_at) AS sold_at",
            "cost",
            "category AS product_category",
            "name AS product_name",
            "brand AS product_brand",
            "retail_price AS product_retail_price",
            "department AS product_department",
            "sku AS product_sku",
            "distribution_center_id AS product_distribution_center_id",
        )

    def distribution_centers(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_suppkey AS id",
            "concat(' ', s_name) AS name",
            "double(s_suppkey % 181 - 90) AS latitude",
            "double(s_suppkey % 361 - 180) AS longitude",
        )

    def events(self) -> DataFrame:
        browsers = ["Chrome", "Firefox", "Safari", " Edge", None]
        sources = ["Adwords", "YouTube", "Facebook", "Email", "Organic", None]
        return self.table("events").selectExpr(
            "event_id AS id",
            "if(user_id % 10 = 9, NULL, user_id) AS user_id",
            "if(user_id % 29 = 28, 1, event_id + 1) AS sequence_number",
            "concat_ws('-', user_id, date(ts), hour(ts) div 12) AS session_id",
            f"ts - {_days('30 * ((user_id div 6) % 12)')} AS created_at",
            "concat('10.0.', user_id div 256, '.', user_id % 256) AS ip_address",
            "concat('City ', user_id % 70, ' ') AS city",
            "concat('State ', user_id % 25) AS state",
            "string(10000 + user_id % 90000) AS postal_code",
            f"{_nth('user_id % 5', browsers)} AS browser",
            f"{_nth('user_id % 6', sources)} AS traffic_source",
            "concat('/', event_type, '/', event_id % 1000) AS uri",
            "CASE event_type WHEN 'signup' THEN ' Home ' "
            "WHEN 'view' THEN if(event_id % 2 = 0, 'product', 'department') "
            "WHEN 'click' THEN if(event_id % 2 = 0, 'product', 'cart') "
            "WHEN 'purchase' THEN 'Purchase' "
            "ELSE if(event_id % 4 = 0, 'cancel', 'cart') END AS event_type",
        )

    # -- summary history and review decisions -------------------------------

    def summary_history(self) -> DataFrame:
        """One stored summary per document, in every review state."""
        return self.table("documents").selectExpr(
            f"{_SUMMARY_ID} AS summary_id",
            "if(doc_id % 59 = 58, NULL, date_add(DATE '2023-12-31', int(doc_id % 3))) AS period_start_date",
            "date_sub(DATE '2024-01-30', if(doc_id % 40 = 39, 60, 0)) AS period_end_date",
            "if(doc_id % 61 = 60, NULL, 'evidence-template-1') AS model_name",
            "if(doc_id % 2 = 0, 'v2.0', 'v1.0') AS prompt_version",
            "if(doc_id % 71 = 70, NULL, 'v2.0') AS input_version",
            "sha2(text, 256) AS input_hash",
            "if(doc_id % 53 = 52, NULL, concat('Evidence: ', text)) AS prompt_text",
            "CASE doc_id % 47 WHEN 45 THEN '   ' WHEN 46 THEN NULL ELSE text END AS generated_summary",
            f"{_moment(datetime(2024, 2, 1))} + {_seconds('doc_id')} AS generated_at",
            f"if(doc_id % 14 = 13, NULL, {_REVIEW_STATE}) AS review_status",
            f"if({_REVIEWED}, concat('Reviewer ', doc_id % 5), NULL) AS reviewed_by",
            f"if({_REVIEWED}, {_REVIEWED_AT}, NULL) AS reviewed_at",
            f"if({_REVIEWED}, 'checked against the evidence', NULL) AS review_notes",
        )

    def review_decisions(self) -> DataFrame:
        """One submitted decision per document: some stale, invalid or repeated."""
        decisions = ["APPROVED", "APPROVED", "REJECTED", "REJECTED", "MAYBE"]
        return self.table("documents").selectExpr(
            "doc_id AS decision_id",
            f"{_SUMMARY_ID} AS summary_id",
            f"{_nth('doc_id % 5', decisions)} AS decision",
            "if(doc_id % 17 = 16, '  ', concat(' Reviewer ', lang)) AS reviewer",
            "if(doc_id % 19 = 18, NULL, concat('batch note ', source)) AS notes",
            "doc_id % 23 <> 22 AS evidence_checked",
            f"if(doc_id % 11 = 10, 'PENDING_REVIEW', {_REVIEW_STATE}) AS seen_status",
            f"if({_REVIEWED} AND doc_id % 13 <> 12, {_REVIEWED_AT}, NULL) AS seen_reviewed_at",
            f"{_moment(datetime(2024, 4, 1))} + {_seconds('doc_id')} AS submitted_at",
        )
