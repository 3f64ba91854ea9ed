"""Versions of the summary history: a new folder each, then a pointer to it.

A version is written in full beside the others and becomes the current one by
the pointer of its number (``pointers``), which only one writer gets and which
is there complete or not at all. Whoever comes second fails and leaves nothing
but an unreferenced folder. A reader takes the highest complete pointer, so a
failure at any moment leaves the old version; a number whose file is not
complete is passed over.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from storefront_analytics.plans.reviews import apply_reviews, judged_decisions, review_conflicts
from storefront_analytics.plans.summaries import HISTORY_SCHEMA
from storefront_analytics.sources.pointers import Pointers


class VersionTaken(RuntimeError):
    """Another writer has published a version meanwhile."""


class HistoryVersions:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._pointers = Pointers(spark, f"{folder}/pointers")

    def current(self) -> tuple[int, str] | None:
        """Number and folder of the version that readers see."""
        complete = {n: lines[0] for n, lines in self._pointers.found().items() if lines}
        return max(complete.items(), default=None)

    def read(self) -> DataFrame:
        found = self.current()
        if not found:
            return self.spark.createDataFrame([], HISTORY_SCHEMA)
        return self.spark.read.schema(HISTORY_SCHEMA).parquet(f"{self.folder}/{found[1]}")

    def publish(self, history: DataFrame, follows: int) -> int:
        """Write ``history`` as the version after ``follows`` and point to it."""
        name = f"versions/{follows + 1}-{uuid.uuid4().hex}"
        history.write.parquet(f"{self.folder}/{name}")
        # One listing for both questions: what is current, and which number is free.
        found = self._pointers.found()
        current = max((n for n, lines in found.items() if lines), default=0)
        number = max(found, default=0) + 1
        if current != follows or not self._pointers.claim(number, [name]):
            raise VersionTaken(f"a version after {follows} of {self.folder}")
        return number

    def review(self, decisions: DataFrame, reviewed_at: datetime) -> tuple[int, int]:
        """Apply a batch of decisions; the new version's number and the conflicts written beside it."""
        found = self.current()
        if not found:
            raise RuntimeError(f"no history in {self.folder}")
        history = self.read()
        judged = judged_decisions(history, decisions)
        conflicts = f"{self.folder}/conflicts/{found[0] + 1}-{uuid.uuid4().hex}"
        review_conflicts(judged).write.parquet(conflicts)
        number = self.publish(apply_reviews(history, judged, reviewed_at), found[0])
        return number, self.spark.read.parquet(conflicts).count()
