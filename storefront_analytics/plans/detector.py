"""Unusual KPI values: one linear trend with weekday effects per series.

Training is one aggregation to moments per series and weekday, which later days
extend; one row of parameters per series follows from them. Scoring joins the
recent rows to it.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storefront_analytics.functions.columns import normal_cdf

# Fixed values.
EPOCH = date(2020, 1, 1)  # day 0 of the trend
SPREAD_FLOOR = 1e-7  # of the scale of a series; a smaller spread is rounding noise of a straight line
SKIP_REASON = "Skipped during anomaly scoring due to a series-specific ML error"


@dataclass(frozen=True)
class DetectorSettings:
    z: float = 2.575829  # two-sided 0.99 prediction interval
    min_rows: int = 14  # a shorter series is skipped


def _points(long: DataFrame, split: str, since: date | None, until: date | None) -> DataFrame:
    rows = long.filter(F.col("dataset_split") == split)
    if since:
        rows = rows.filter(F.col("metric_timestamp") >= F.lit(since.isoformat()).cast("timestamp_ntz"))
    if until:
        rows = rows.filter(F.col("metric_timestamp") < F.lit(until.isoformat()).cast("timestamp_ntz"))
    return rows.select("series_key", "metric_timestamp", "metric_value")


def kpi_train(long: DataFrame, until: date | None = None) -> DataFrame:
    return _points(long, "TRAIN", None, until)


def kpi_score(long: DataFrame, since: date | None = None) -> DataFrame:
    return _points(long, "SCORE", since, None)


def _day(ts: Column) -> Column:
    return F.datediff(ts.cast("date"), F.lit(EPOCH)).cast("double")


def _weekday(ts: Column) -> Column:
    return F.dayofweek(ts)  # 1 = Sunday


#: Rows, means, and sums of squares and products around the means.
MOMENTS = ("n", "mean_t", "mean_y", "tt", "ty", "yy")
_GROUP = ("series_key", "weekday")


def kpi_moments(train: DataFrame) -> DataFrame:
    """Moments of days (t) and values (y) per series and weekday: all that training needs, from one aggregation."""
    y = F.col("metric_value")
    t = F.when(y.isNotNull(), _day(F.col("metric_timestamp")))
    n = F.count(y)
    return train.groupBy("series_key", _weekday(F.col("metric_timestamp")).alias("weekday")).agg(
        n.alias("n"),
        F.avg(t).alias("mean_t"),
        F.avg(y).alias("mean_y"),
        *[F.coalesce(c * n, F.lit(0.0)).alias(k) for k, c in (("tt", F.var_pop(t)), ("ty", F.covar_pop(t, y)), ("yy", F.var_pop(y)))],
    )


def _pooled(moments: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Each row with the moments of all rows of its ``keys`` together, as all_n and so on."""
    together = W.partitionBy(*keys)
    rows = F.sum("n").over(together)
    means = {f"all_{m}": F.sum(F.col("n") * F.col(m)).over(together) / F.nullif(rows, F.lit(0)) for m in ("mean_t", "mean_y")}
    apart_t, apart_y = F.col("mean_t") - F.col("all_mean_t"), F.col("mean_y") - F.col("all_mean_y")

    def around(inner: str, apart: Column) -> Column:
        return F.sum(F.col(inner) + F.coalesce(F.col("n") * apart, F.lit(0.0))).over(together)

    return moments.withColumns({"all_n": rows, **means}).withColumns(
        {
            "all_tt": around("tt", apart_t * apart_t),
            "all_ty": around("ty", apart_t * apart_y),
            "all_yy": around("yy", apart_y * apart_y),
        }
    )


def merged_moments(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Moments of several spans of days as one: training goes on from stored moments and those of new days."""
    rows = first
    for part in more:
        rows = rows.unionByName(part)
    pooled = _pooled(rows.select(*_GROUP, *MOMENTS), _GROUP)
    return pooled.groupBy(*_GROUP).agg(*[F.max(f"all_{m}").alias(m) for m in MOMENTS])


def params_of_moments(moments: DataFrame) -> DataFrame:
    """One row per series: rows, trend, scale (root mean square), spread and seven weekday effects."""
    pooled = _pooled(moments, ("series_key",)).withColumn("slope", F.col("all_ty") / F.nullif(F.col("all_tt"), F.lit(0.0)))
    pooled = pooled.withColumn("intercept", F.col("all_mean_y") - F.col("slope") * F.col("all_mean_t"))
    slope = F.col("slope")
    # Of a weekday: the mean residual, and the squared distances of the residuals from it.
    effect = F.col("mean_y") - (F.col("intercept") + slope * F.col("mean_t"))
    squares = F.greatest(F.col("yy") - 2 * slope * F.col("ty") + slope * slope * F.col("tt"), F.lit(0.0))
    found = pooled.withColumns({"effect": effect, "squares": squares}).groupBy("series_key").agg(
        F.max("all_n").alias("train_rows"),
        F.max("slope").alias("slope"),
        F.max("intercept").alias("intercept"),
        F.sqrt(F.max(F.col("all_yy") / F.nullif(F.col("all_n"), F.lit(0)) + F.col("all_mean_y") * F.col("all_mean_y"))).alias("scale"),
        F.sqrt(F.sum("squares") / F.nullif(F.max("all_n") - 1, F.lit(0))).alias("spread"),
        *[F.max(F.when(F.col("weekday") == d, F.col("effect"))).alias(f"effect_{d}") for d in range(1, 8)],
    )
    kept = ("series_key", "train_rows", "slope", "intercept", "scale", "spread")
    return found.select(*kept, *[F.coalesce(f"effect_{d}", F.lit(0.0)).alias(f"effect_{d}") for d in range(1, 8)])


def kpi_detector_params(train: DataFrame) -> DataFrame:
    """Trend, spread and weekday effects of each series."""
    return params_of_moments(kpi_moments(train))


def kpi_anomaly_results(
    score: DataFrame, params: DataFrame, settings: DetectorSettings = DetectorSettings()
) -> DataFrame:
    """Expected range and verdict per recent row; unusable series give none."""
    usable = params.filter((F.col("train_rows") >= settings.min_rows) & (F.col("spread") > SPREAD_FLOOR * F.col("scale")))
    ts, y = F.col("metric_timestamp"), F.col("metric_value")
    effects = F.array(*[f"effect_{d}" for d in range(1, 8)])
    forecast = F.col("intercept") + F.col("slope") * _day(ts) + F.get(effects, _weekday(ts) - 1)
    reach = F.col("spread") * F.lit(settings.z)
    scored = score.join(usable, "series_key").select(
        F.col("series_key").alias("series"),
        ts.alias("ts"),
        y.alias("y"),
        forecast.alias("forecast"),
        (forecast - reach).alias("lower_bound"),
        (forecast + reach).alias("upper_bound"),
        ((y - forecast) / F.col("spread")).alias("distance"),
    )
    outside = (F.col("y") < F.col("lower_bound")) | (F.col("y") > F.col("upper_bound"))
    return scored.select(
        "series",
        "ts",
        "y",
        "forecast",
        "lower_bound",
        "upper_bound",
        outside.alias("is_anomaly"),
        normal_cdf(F.col("distance")).alias("percentile"),
        "distance",
    )


def kpi_anomaly_exclusions(score: DataFrame, results: DataFrame, recorded_at: datetime | None = None) -> DataFrame:
    """Series with recent rows but no result."""
    at = F.lit(recorded_at.isoformat(sep=" ")).cast("timestamp") if recorded_at else F.current_timestamp()
    scored = results.select(F.col("series").alias("series_key"))
    return (
        score.select("series_key")
        .distinct()
        .join(scored, "series_key", "left_anti")
        .select("series_key", F.lit(SKIP_REASON).alias("exclusion_reason"), at.alias("recorded_at"))
    )
