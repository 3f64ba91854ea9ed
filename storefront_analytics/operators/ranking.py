"""Global positions, tiles and dense ranks without a one-task sort.

A window without PARTITION BY sends every row to one task. Here the rows are
range-partitioned and sorted instead, each row is numbered inside its
partition, and the row counts of the partitions before it (one small row per
partition) are added. The numbered rows are stored first, because the bounds of
a range partitioning come from a sample and may differ between two evaluations.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storefront_analytics.sources.scratch import store

# monotonically_increasing_id(): partition number above, row number below.
_ROW_BITS = 33


def with_positions(
    frame: DataFrame, order: Sequence[Column], position: str = "position", group: str | None = None
) -> DataFrame:
    """Number the rows 1, 2, ... in ``order``, which must be a total order.

    With ``group``, which then must be the first column of the order, the
    numbers start again in each group and ``_total`` holds its number of rows.
    """
    numbered = (
        store(
            frame.repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .withColumn("_at", F.monotonically_increasing_id()),
            "positions",
        )
        .frame.withColumn("_part", F.shiftright("_at", _ROW_BITS))
    )
    groups = [group] if group else []
    whole = Window.partitionBy(*groups)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition and group in it: groups are contiguous, so
    # there are at most as many rows as partitions and groups together.
    starts = (
        numbered.groupBy("_part", *groups)
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
        .select(
            "_part",
            *groups,
            (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
            *([F.sum("_rows").over(whole).alias("_total")] if group else []),
        )
    )
    return (
        numbered.join(F.broadcast(starts), ["_part", *groups])
        .withColumn(position, F.col("_at") + F.col("_shift"))
        .drop("_at", "_part", "_shift")
    )


# Stands for a missing value: before every other one.
_NONE = Decimal("-9" + "0" * 31)
#: Digits of the approximate quantiles that bracket a cut.
_ACCURACY = 100_000
#: Rows at cut values whose keys are ordered on the driver; more are ordered by range.
_FEW_KEYS = 50_000


def _ordered(value: Column) -> Column:
    """A measure as one type; whole numbers and money are exact in it."""
    return F.coalesce(value.cast("decimal(38,6)"), F.lit(_NONE))


def _cut_values(frame: DataFrame, values: Mapping[str, Column], ends: Sequence[int], rows: int, brackets) -> list[tuple]:
    """(measure, end, value, rows below the value, rows with it) for the row at each end of a tile."""

    def inside(name: str, at: int) -> Column:
        low, high = brackets[name][at]
        return (F.lit(True) if low is None else values[name] >= low) & (F.lit(True) if high is None else values[name] <= high)

    pairs = [(name, at) for name in values for at in range(len(ends))]
    below = frame.agg(
        *[
            F.count_if(F.lit(False) if brackets[name][at][0] is None else values[name] < brackets[name][at][0]).alias(f"b{i}")
            for i, (name, at) in enumerate(pairs)
        ]
    ).first()
    held = [F.when(inside(n, at), F.struct(F.lit(i).alias("cut"), values[n].alias("value"))) for i, (n, at) in enumerate(pairs)]
    counted = (
        frame.select(F.explode(F.array_compact(F.array(*held))).alias("h")).groupBy("h.cut", "h.value").agg(F.count(F.lit(1)).alias("held"))
    )
    # A bracket holds a ten-thousandth of the rows and the values equal to its ends, each of them once.
    upto = F.sum("held").over(Window.partitionBy("cut").orderBy("value"))
    wanted = F.element_at(F.array(*[F.lit(ends[at] - below[i]) for i, (_, at) in enumerate(pairs)]), F.col("cut") + 1)
    at_cut = counted.withColumn("upto", upto).filter((F.col("upto") >= wanted) & (F.col("upto") - F.col("held") < wanted))
    found = {r["cut"]: r for r in at_cut.collect()}  # one row per cut at most
    out = []
    for i, (name, at) in enumerate(pairs):
        row = found.get(i)
        out.append((name, at, row and row["value"], row and below[i] + row["upto"] - row["held"], row and row["held"]))
    return out


def tile_cuts(frame: DataFrame, key: str, measures: Mapping[str, Column], tiles: int) -> dict[str, list[tuple]]:
    """The last row of each tile but the last: (value, key) per measure; a key of None stands for all with the value.

    Approximate quantiles bracket the values; counts below the brackets and of
    the values inside them give the exact ones. Only where a tile ends among
    rows of one value, the keys of these rows are ordered.
    """
    values = {name: _ordered(value) for name, value in measures.items()}
    shares = [t / tiles for t in range(1, tiles)]
    near = [min(1.0, max(0.0, s + d)) for s in shares for d in (-5 / _ACCURACY, 5 / _ACCURACY)]
    first = frame.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.percentile_approx(v, near, _ACCURACY).alias(name) for name, v in values.items()],
    ).first()
    rows = first["_rows"]
    if not rows:
        return {name: [] for name in measures}
    ends = [t * (rows // tiles) + min(t, rows % tiles) for t in range(1, tiles)]
    brackets = {name: [(first[name][2 * i], first[name][2 * i + 1]) for i in range(tiles - 1)] for name in measures}
    cuts = _cut_values(frame, values, ends, rows, brackets)
    if any(value is None for _, _, value, _, _ in cuts):
        # A quantile was too far off, as among few rows: take all values of that measure.
        missed = {name for name, _, value, _, _ in cuts if value is None}
        open_ = {name: [(None, None)] * (tiles - 1) if name in missed else b for name, b in brackets.items()}
        cuts = _cut_values(frame, values, ends, rows, open_)
    inside = [(name, at, value, ends[at] - under, held) for name, at, value, under, held in cuts if ends[at] - under < held]
    keys = _keys_at(frame, key, values, inside)
    return {
        name: [(value, keys.get((name, at))) for other, at, value, _, _ in cuts if other == name] for name in measures
    }


def _keys_at(frame: DataFrame, key: str, values: Mapping[str, Column], inside: list[tuple]) -> dict:
    """The key at a place among the rows of one value, per (measure, cut)."""
    if not inside:
        return {}
    groups = {(name, value): held for name, _, value, _, held in inside}
    number = {g: i for i, g in enumerate(groups)}
    tagged = [F.when(values[n] == v, F.lit(i)) for (n, v), i in number.items()]
    rows = frame.select(F.explode(F.array_compact(F.array(*tagged))).alias("_group"), F.col(key).alias("_key"))
    if sum(groups.values()) <= _FEW_KEYS:
        ordered: dict[int, list] = {}
        for r in sorted(rows.collect()):
            ordered.setdefault(r["_group"], []).append(r["_key"])
        return {(n, at): ordered[number[n, v]][place - 1] for n, at, v, place, _ in inside}
    placed = with_positions(rows, [F.col("_group"), F.col("_key")], group="_group")
    wanted = [F.struct(F.lit(number[n, v]), F.lit(place).cast("long")) for n, _, v, place, _ in inside]
    found = placed.filter(F.struct("_group", F.col("position").cast("long")).isin(*wanted)).collect()
    at_place = {(r["_group"], r["position"]): r["_key"] for r in found}
    return {(n, at): at_place[number[n, v], place] for n, at, v, place, _ in inside}


def with_tiles(frame: DataFrame, key: str, measures: Mapping[str, Column], tiles: int) -> DataFrame:
    """Add ``ntile(tiles)`` over each measure ascending, missing values first, ties by ``key``.

    Rows stay where they are: each compares itself with the cuts between the
    tiles. ``key`` identifies a row and is never null; ``frame`` should be a
    stored one, since it is read several times.
    """
    out = {}
    for name, cuts in tile_cuts(frame, key, measures, tiles).items():
        value = _ordered(measures[name])
        beyond = [
            (value > F.lit(v)) if k is None else (value > F.lit(v)) | ((value == F.lit(v)) & (F.col(key) > F.lit(k)))
            for v, k in cuts
        ]
        out[name] = sum((b.cast("bigint") for b in beyond), F.lit(1).cast("bigint"))
    return frame.withColumns(out)


def with_dense_ranks(frame: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """Add ``dense_rank`` over each measure descending, missing values first.

    The values are combined before they are sorted, and joined back to the rows,
    where a value that many rows share is a join partition that adaptive
    execution splits. ``frame`` should be a stored one, since it is read twice.
    """

    def add(out: DataFrame, item: tuple[str, Column]) -> DataFrame:
        name, value = item
        values = frame.select(value.alias("_value")).distinct()
        ranks = with_positions(values, [F.col("_value").desc_nulls_first()], name)
        return out.join(ranks, value.eqNullSafe(F.col("_value")), "left").drop("_value")

    return reduce(add, measures.items(), frame)


def with_ranks(frame: DataFrame, key: str, measures: Mapping[str, Column]) -> DataFrame:
    """Add ``rank`` over each measure descending, missing values first.

    The rank of a value is the first position any row with it has; ``key``
    identifies a row and makes the order total.
    """

    def add(out: DataFrame, item: tuple[str, Column]) -> DataFrame:
        name, value = item
        placed = with_positions(
            frame.select(key, value.alias("_value")), [F.col("_value").desc_nulls_first(), F.col(key)]
        )
        ranks = placed.groupBy("_value").agg(F.min("position").alias(name))
        return out.join(ranks, value.eqNullSafe(F.col("_value")), "left").drop("_value")

    return reduce(add, measures.items(), frame)


