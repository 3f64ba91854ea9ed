"""The seven raw tables: declared schemas, snapshot, load and reconciliation."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names and types of the raw tables.
RAW_SCHEMAS = {
    "distribution_centers": "id bigint, name string, latitude double, longitude double",
    "products": (
        "id bigint, cost double, category string, name string, brand string, retail_price double, "
        "department string, sku string, distribution_center_id bigint"
    ),
    "users": (
        "id bigint, first_name string, last_name string, email string, age bigint, gender string, "
        "state string, street_address string, postal_code string, city string, country string, "
        "latitude double, longitude double, traffic_source string, created_at timestamp_ntz"
    ),
    "orders": (
        "order_id bigint, user_id bigint, status string, gender string, created_at timestamp_ntz, "
        "shipped_at timestamp_ntz, delivered_at timestamp_ntz, returned_at timestamp_ntz, num_of_item bigint"
    ),
    "order_items": (
        "id bigint, order_id bigint, user_id bigint, product_id bigint, inventory_item_id bigint, "
        "status string, created_at timestamp_ntz, shipped_at timestamp_ntz, delivered_at timestamp_ntz, "
        "returned_at timestamp_ntz, sale_price double"
    ),
    "inventory_items": (
        "id bigint, product_id bigint, created_at timestamp_ntz, sold_at timestamp_ntz, cost double, "
        "product_category string, product_name string, product_brand string, product_retail_price double, "
        "product_department string, product_sku string, product_distribution_center_id bigint"
    ),
    "events": (
        "id bigint, user_id bigint, sequence_number bigint, session_id string, created_at timestamp_ntz, "
        "ip_address string, city string, state string, postal_code string, browser string, "
        "traffic_source string, uri string, event_type string"
    ),
}

# Tables frozen at the cut-off date; the others are taken whole.
DATED_TABLES = ("users", "orders", "order_items", "events")
DEFAULT_CUTOFF = date(2026, 1, 1)

MANIFEST_FILE = "extraction_manifest"


def raw_columns(table: str) -> list[str]:
    return [part.split()[0] for part in RAW_SCHEMAS[table].split(", ")]


def raw_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(RAW_SCHEMAS[table])


def conform(frame: DataFrame, table: str) -> DataFrame:
    """Match columns by name, whatever their case, and cast to the declared types."""
    present = {name.lower(): name for name in frame.columns}
    missing = [f.name for f in raw_schema(table) if f.name not in present]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    return frame.select(
        *[F.col(present[f.name]).cast(f.dataType).alias(f.name) for f in raw_schema(table)]
    )


def read_raw(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One raw table from ``folder/table``; a missing path fails at once."""
    return conform(spark.read.parquet(f"{folder}/{table}"), table)


def before_cutoff(frame: DataFrame, table: str, cutoff: date) -> DataFrame:
    """Rows created on a day before ``cutoff``.

    The bare column is compared with midnight, which keeps the same rows as
    comparing dates and can be pushed into the scan.
    """
    if table not in DATED_TABLES:
        return frame
    midnight = F.lit(f"{cutoff.isoformat()} 00:00:00").cast("timestamp_ntz")
    return frame.filter(F.col("created_at") < midnight)


def extract_snapshot(
    tables: Mapping[str, DataFrame],
    folder: str,
    source: str,
    cutoff: date = DEFAULT_CUTOFF,
    extracted_at: datetime | None = None,
) -> DataFrame:
    """Write every table up to the cut-off and a manifest beside them.

    Rows are counted as they are written, so nothing is scanned a second time.
    """
    spark = next(iter(tables.values())).sparkSession
    counts = {}
    for name, frame in tables.items():
        seen = Observation(f"extract {name}")
        rows = before_cutoff(conform(frame, name), name, cutoff).observe(seen, F.count(F.lit(1)).alias("rows"))
        rows.write.mode("overwrite").option("compression", "snappy").parquet(f"{folder}/{name}")
        counts[name] = seen.get["rows"]
    written = {name: read_raw(spark, folder, name) for name in tables}
    sizes = {name: folder_bytes(spark, f"{folder}/{name}") for name in tables}
    manifest = manifest_rows(written, source, cutoff, extracted_at, folder, sizes, counts)
    manifest.coalesce(1).write.mode("overwrite").json(f"{folder}/{MANIFEST_FILE}")
    return spark.read.schema(manifest.schema).json(f"{folder}/{MANIFEST_FILE}")


def folder_bytes(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(files.getContentSummary(location).getLength())


def manifest_rows(
    tables: Mapping[str, DataFrame],
    source: str,
    cutoff: date,
    extracted_at: datetime | None = None,
    folder: str | None = None,
    sizes: Mapping[str, int] | None = None,
    counts: Mapping[str, int] | None = None,
) -> DataFrame:
    """One row per table: row count, columns, file, bytes, source, cut-off, time. Tables without a count are counted."""
    out = None
    for name, frame in tables.items():
        if counts and name in counts:
            counted = frame.sparkSession.range(1).select(F.lit(counts[name]).cast("bigint").alias("rows"))
        else:
            counted = frame.agg(F.count(F.lit(1)).alias("rows"))
        row = counted.select(
            F.lit(name).alias("table"),
            "rows",
            F.array(*[F.lit(c) for c in frame.columns]).alias("columns"),
            F.lit(f"{folder}/{name}" if folder else None).cast("string").alias("file"),
            F.lit((sizes or {}).get(name)).cast("bigint").alias("file_size_bytes"),
            F.lit(source).alias("source"),
            F.lit(cutoff).alias("cutoff_date"),
            F.lit(extracted_at.isoformat() if extracted_at else None).cast("string").alias("extracted_at_utc"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def reconcile(manifest: DataFrame, loaded: Mapping[str, DataFrame]) -> DataFrame:
    """Expected rows from the manifest beside the rows found after loading."""
    found = None
    for name, frame in loaded.items():
        row = frame.agg(F.count(F.lit(1)).alias("actual")).select(F.lit(name).alias("table"), "actual")
        found = row if found is None else found.unionByName(row)
    expected = manifest.select("table", F.col("rows").alias("expected"))
    return expected.join(found, "table", "full").select(
        "table", "expected", "actual", F.coalesce(F.col("expected") == F.col("actual"), F.lit(False)).alias("matches")
    )


def load_snapshot(spark: SparkSession, folder: str, target: str) -> dict[str, DataFrame]:
    """Load every raw table from a snapshot into ``target``, replacing what is there.

    Fails when the manifest or a table is missing, when a file cannot be read
    and when a row count differs from the manifest.
    """
    manifest = spark.read.json(f"{folder}/{MANIFEST_FILE}")
    sources = {name: read_raw(spark, folder, name) for name in RAW_SCHEMAS}
    for name, frame in sources.items():
        frame.write.mode("overwrite").parquet(f"{target}/{name}")
    loaded = {name: read_raw(spark, target, name) for name in RAW_SCHEMAS}
    wrong = reconcile(manifest, loaded).filter(~F.col("matches")).collect()  # seven rows at most
    if wrong:
        raise RuntimeError(f"row counts differ from the manifest: {[r.asDict() for r in wrong]}")
    return loaded


def preview_users(users: DataFrame, rows: int = 10) -> DataFrame:
    """The first users by id, as a look at the source."""
    return (
        users.select("id", "first_name", "last_name", "country", "traffic_source", "created_at")
        .orderBy("id")
        .limit(rows)
    )
