"""Small column helpers: safe ratios, exact means, calendar differences."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(12,2)"


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as DOUBLE, null where the base is zero or missing."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def rate_or_zero(part: Column, whole: Column) -> Column:
    """Like :func:`ratio`, but 0 where there is no positive base."""
    return F.when(whole > 0, ratio(part, whole)).otherwise(F.lit(0.0))


def exact_mean(value: Column) -> Column:
    """Mean of a decimal or integer column as DOUBLE.

    The sum stays exact, so the result does not depend on the order in which
    tasks are merged.
    """
    return F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0))


def count_rows() -> Column:
    return F.count(F.lit(1))


def sum_when(condition: Column, value: Column) -> Column:
    """Sum over the matching rows, 0 (not null) when none match."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0).cast("decimal(12,2)")))


def days_between(start: Column, end: Column) -> Column:
    """Midnights crossed from ``start`` to ``end``."""
    return F.datediff(end.cast("date"), start.cast("date")).cast("bigint")


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed; free of the session time zone."""

    def second_of_day(ts: Column) -> Column:
        return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)

    return days_between(start, end) * 86400 + second_of_day(end) - second_of_day(start)


def months_between_firsts(start: Column, end: Column) -> Column:
    """Calendar months from ``start`` to ``end``."""
    return ((F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)).cast("bigint")


# The rational approximation 7.1.26 of erf (Abramowitz & Stegun).
ERF_P = 0.3275911
ERF_COEFFICIENTS = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, absolute error below 1e-7."""
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERF_P) * x)
    poly = F.lit(0.0)
    for a in reversed(ERF_COEFFICIENTS):
        poly = (poly + F.lit(a)) * t
    erf = F.lit(1.0) - poly * F.exp(-x * x)
    return F.when(z >= 0, (1 + erf) / 2).otherwise((1 - erf) / 2)
