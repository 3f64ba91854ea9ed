"""Connected components by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import store


def components(links: DataFrame) -> DataFrame:
    """doc_id, component_id (the smallest id reachable) of every end of a link.

    ``links`` has the columns a and b. Each round links every node's larger
    neighbours, then all its smaller ones, to the least node near it, until
    every node hangs on the least of its component.
    """
    ordered = F.when(F.col("a") < F.col("b"), F.struct("a", "b")).otherwise(
        F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    edges = links.filter("a <> b").select(ordered.alias("e")).select("e.*").distinct()
    stored = store(edges, "links")
    while True:
        edges = stored.frame
        both = edges.select("a", "b").union(edges.select("b", "a")).toDF("node", "other")
        least = store(both.groupBy("node").agg(F.min("other").alias("m")), "links-least").frame
        # Larger neighbours of a node go to the least node around it.
        large = (
            both.filter("other > node")
            .join(least, "node")
            .select(F.least("m", "node").alias("a"), F.col("other").alias("b"))
            .filter("a <> b")
            .distinct()
        )
        large = store(large, "links-large").frame
        down = store(large.groupBy("b").agg(F.min("a").alias("m")), "links-down").frame
        small = (
            large.join(down, "b")
            .select(F.col("m").alias("x"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("y"))
            .union(down.select("m", "b"))
            .toDF("a", "b")
            .filter("a <> b")
            .distinct()
        )
        following = store(small, "links")
        same = edges.join(following.frame, ["a", "b"], "left_anti")
        if following.rows == stored.rows and same.isEmpty():
            break
        stored = following
    stars = following.frame.select(F.col("b").alias("doc_id"), F.col("a").alias("component_id"))
    roots = following.frame.select(F.col("a").alias("doc_id"), F.col("a").alias("component_id")).distinct()
    return store(stars.union(roots), "components").frame
