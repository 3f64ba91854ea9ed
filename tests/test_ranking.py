from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from storefront_analytics.operators import ranking
from storefront_analytics.operators.ranking import (
    with_dense_ranks,
    with_positions,
    with_ranks,
    with_tiles,
)
from storefront_analytics.sources.scratch import Stored, store


@pytest.fixture
def values(spark):
    def build(n, seed=7):
        rng = random.Random(seed)
        # A third of all rows share one value.
        data = [
            (i, rng.choice([5, rng.randint(0, 9), rng.randint(0, 1000)]), rng.choice([None, 0.1, rng.random()]))
            for i in range(n)
        ]
        return store(spark.createDataFrame(data, "id bigint, a bigint, b double").repartition(6), "values")

    return build


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 503])
def test_tiles_equal_the_window(values, n):
    frame = values(n).frame
    got = with_tiles(frame, "id", {"up": F.col("a"), "down": -F.col("a")}, 5)
    want = frame.select(
        "*",
        F.ntile(5).over(Window.orderBy("a", "id")).cast("bigint").alias("up"),
        F.ntile(5).over(Window.orderBy(F.col("a").desc(), "id")).cast("bigint").alias("down"),
    )
    assert sorted(got.select(*want.columns).collect(), key=lambda r: r.id) == sorted(
        want.collect(), key=lambda r: r.id
    )


def test_seven_rows_in_five_tiles(values):
    tiles = with_tiles(values(7).frame, "id", {"t": F.col("a")}, 5).groupBy("t").count().orderBy("t").collect()
    assert [r["count"] for r in tiles] == [2, 2, 1, 1, 1]


def test_positions_count_up(values):
    frame = values(400).frame
    got = with_positions(frame, [F.col("a").desc(), F.col("id")]).orderBy("position").collect()
    assert [r["position"] for r in got] == list(range(1, 401))
    assert [r["id"] for r in got] == [r["id"] for r in frame.orderBy(F.col("a").desc(), "id").collect()]


@pytest.mark.parametrize("function", ["dense_rank", "rank"])
def test_ranks_equal_the_window(values, function):
    frame = values(300).frame
    measures = {"ra": F.col("a"), "rb": F.col("b")}
    got = with_dense_ranks(frame, measures) if function == "dense_rank" else with_ranks(frame, "id", measures)
    ranking = getattr(F, function)
    want = frame.select(
        "*",
        *[ranking().over(Window.orderBy(v.desc_nulls_first())).cast("bigint").alias(n) for n, v in measures.items()],
    )
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(want.collect(), key=lambda r: r.id)
    assert got.filter("b is null").select("rb").distinct().collect()[0][0] == 1  # missing first


def test_distributed_ways_need_no_single_task_over_the_rows(values):
    frame = values(300).frame
    tiles = with_tiles(frame, "id", {"t": F.col("a")}, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in tiles
    plan = with_positions(frame, [F.col("a"), F.col("id")])._jdf.queryExecution().executedPlan().toString()
    # The only single-partition windows run over the row counts of the partitions.
    windows = re.findall(r"Window \[(.*?)windowspecdefinition", plan)
    assert windows and all("sum(_rows" in w for w in windows)


def test_stored_rows(spark):
    assert Stored(spark.range(3).toDF("x")).rows == 3


@pytest.mark.parametrize("few", [50_000, 10])
def test_tiles_that_end_among_equal_values(spark, monkeypatch, few):
    # Half of the rows share one value, and others are missing; the ends of several tiles lie among them.
    monkeypatch.setattr(ranking, "_FEW_KEYS", few)
    rng = random.Random(3)
    data = [(i, rng.choice([7, 7, None, rng.randint(0, 20)])) for i in rng.sample(range(10_000), 3000)]
    frame = store(spark.createDataFrame(data, "id bigint, a bigint").repartition(5), "equal").frame
    got = with_tiles(frame, "id", {"t": F.col("a"), "one": F.lit(1)}, 5)
    want = frame.select("*", F.ntile(5).over(Window.orderBy("a", "id")).alias("t"), F.ntile(5).over(Window.orderBy("id")).alias("one"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_rows_are_not_moved_for_tiles(values):
    frame = values(900).frame
    plan = with_tiles(frame, "id", {"t": F.col("a"), "u": -F.col("a")}, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_missed_brackets_take_all_values(values, monkeypatch):
    monkeypatch.setattr(ranking, "_ACCURACY", 2)
    frame = values(700).frame
    got = with_tiles(frame, "id", {"t": F.col("a")}, 5)
    want = frame.withColumn("t", F.ntile(5).over(Window.orderBy("a", "id")))
    assert sorted((r.id, r.t) for r in got.collect()) == sorted((r.id, r.t) for r in want.collect())
