"""Supporting data as CSV: read, list the choices, filter, count, export."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Columns that can be filtered, whatever their case.
FILTER_FIELDS = ("channel", "metric_name", "kpi_name")


def read_csv(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """A CSV with a header. Without a schema the types cost an extra pass."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def filter_columns(frame: DataFrame) -> dict[str, str]:
    """Filter field -> the first column of that name, ignoring case."""
    found: dict[str, str] = {}
    for name in frame.columns:
        if name.lower() in FILTER_FIELDS:
            found.setdefault(name.lower(), name)
    return {f: found[f] for f in FILTER_FIELDS if f in found}


def filter_choices(frame: DataFrame) -> DataFrame:
    """Distinct filled values of each filter column as text, in order."""
    pairs = [
        F.struct(F.lit(f).alias("field"), F.col(c).cast("string").alias("choice"))
        for f, c in filter_columns(frame).items()
    ]
    if not pairs:
        return frame.sparkSession.createDataFrame([], "field string, choice string")
    return (
        frame.select(F.inline(F.array(*pairs)))
        .filter(F.col("choice").isNotNull())
        .distinct()
        .orderBy("field", "choice")
    )


def explore(frame: DataFrame, chosen: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows with one of the chosen values per field; no choice means no filter."""
    for f, c in filter_columns(frame).items():
        if chosen.get(f):
            frame = frame.filter(F.col(c).cast("string").isin(*chosen[f]))
    return frame


def write_csv(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").option("header", True).csv(path)
