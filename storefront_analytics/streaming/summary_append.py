"""The incremental append as a stream over stored evidence packages.

Every run writes its package to a folder; the stream takes the packages it has
not seen, turns them into summaries and appends the new ones. A batch that is
repeated after a failure appends nothing, because its keys are in the history.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from storefront_analytics.plans.summaries import append_summaries, summary_candidates
from storefront_analytics.sources.scratch import store


def read_packages(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def append_new_packages(
    packages: DataFrame,
    history_path: str,
    checkpoint: str,
    text: Callable[[Column], Column] | None = None,
    generated_at: datetime | None = None,
) -> StreamingQuery:
    """Process what has arrived, then stop."""

    def append(batch: DataFrame, _: int) -> None:
        candidates = summary_candidates(batch, generated_at, text)
        append_summaries(store(candidates.dropDuplicates(["summary_id"]), "stream-candidates"), history_path)

    return (
        packages.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
