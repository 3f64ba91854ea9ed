"""Session settings for tests and the bench; a cluster brings its own session."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What the jobs expect of any session. AQE splits skewed join partitions, so a
# hot user or order does not end up in one task.
EXPECTED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.ignoreCorruptFiles": "false",
}


def check_session(spark: SparkSession) -> None:
    """Fail on a session that would give other results or leave hot keys unsplit."""
    found = {k: str(spark.conf.get(k, None)) for k in EXPECTED}
    other = {k: v for k, v in found.items() if v.lower() != EXPECTED[k].lower()}
    if other:
        raise ValueError(f"session settings differ from {EXPECTED}: {other}")


def local_session(cpus: int | str = "*", app: str = "storefront", **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **EXPECTED,
        "spark.sql.shuffle.partitions": "8",
        # Small data on few cores: keep some parallelism when merging partitions.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # Recording the Python call site of every column costs more than the column.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
